"""Structure entries: fetching their files into a shared folder, and a data source that reads atoms from such a folder.

fetch() is the ingest step: distinct entries are dealt over tasks, files that are there already are not fetched again, and
an entry that can't be had is a row with its error. AtomSource parses files inside the scan, so that filters on structure,
chain and model are applied while reading: files of other structures are not opened, other atoms are not handed over.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from foldlake.sources import structures

KINDS = ("cif", "pdb")
FETCHED = "structure_id string, kind string, path string, error string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def download(url: str, timeout: float, tries: int, wait: float) -> bytes:
    """The body at url; failures that may pass are tried again after growing waits."""
    for left in range(tries - 1, -1, -1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as got:
                return got.read()
        except urllib.error.HTTPError as e:
            if e.code < 500 and e.code != 429 or not left:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if not left:
                raise
        time.sleep(wait * 2 ** (tries - 1 - left))
    raise AssertionError


def fetch(entries: DataFrame, folder: str, url: str, timeout: float = 60.0, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """structure_id (in upper case), kind, path, error: the files of the distinct entries of the column structure_id, fetched
    into folder, a URI that all executors share, under <ENTRY>.<kind>.

    url is a template with {id} and {kind}. A file that is in the folder is not fetched again. It gets its name when it is
    whole. A file that can't be had has a null path and its error. Null and empty entries are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from uuid import uuid4

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            out = []
            for name in batch["structure_id"]:
                for kind in KINDS:
                    path, error = f"{base}/{name}.{kind}", None
                    try:
                        if system.get_file_info(path).type == fs.FileType.NotFound:
                            body, part = download(url.format(id=name, kind=kind), timeout, tries, wait), f"{path}.{uuid4().hex}.part"
                            with system.open_output_stream(part) as stream:
                                stream.write(body)
                            system.move(part, path)
                    except (OSError, ValueError) as e:
                        path, error = None, f"{type(e).__name__}: {e}"
                    out.append((name, kind, path, error))
            yield pd.DataFrame(out, columns=["structure_id", "kind", "path", "error"])

    names = entries.select(F.upper(F.trim("structure_id")).alias("structure_id")).where("structure_id <> ''").distinct()
    return names.mapInPandas(run, FETCHED)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class FolderReader(DataSourceReader):
    """Reads groups of files; keeps what is wanted of structures, chains and models, all where nothing is said."""

    def __init__(self, folder: str, files_a_task: int):
        self.folder, self.files_a_task = folder, files_a_task
        self.wanted: dict[str, set] = {}

    @staticmethod
    def _stem(path: str) -> str:
        return path.rpartition("/")[2].rpartition(".")[0]

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.folder)
        found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        paths = sorted(f.path for f in found if f.is_file and f.path.lower().endswith((".cif", ".mmcif", ".pdb", ".ent")))
        if "structure_id" in self.wanted:
            paths = [p for p in paths if self._stem(p) in self.wanted["structure_id"]]
        return [Files(paths[i : i + self.files_a_task]) for i in range(0, len(paths), self.files_a_task)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.folder)[0]
        chains, models = self.wanted.get("auth_asym_id"), self.wanted.get("model_num")
        for path in partition.paths:
            with system.open_input_stream(path) as stream:
                text = stream.read().decode("utf-8", "replace")
            for row in structures.parsed_rows(path, self._stem(path), text):
                if (chains is None or row[5] in chains) and (models is None or row[1] in models):
                    yield row


class AtomReader(FolderReader):
    """A reader that Spark may push filters to; it asks for that to be switched on."""

    COLUMNS = ("structure_id", "auth_asym_id", "model_num")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality and membership of structure, chain and model; gives back all others."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column not in self.COLUMNS:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[column] = self.wanted[column] & values if column in self.wanted else values


class AtomSource(DataSource):
    """The atoms of all structure files below the folder in option `path`, with columns as structures.parsed() has them; option
    `files` says how many files a task takes (16), `pushdown` whether filters reach the reader."""

    @classmethod
    def name(cls) -> str:
        return "foldlake_atoms"

    def schema(self) -> str:
        return structures.PARSED

    def reader(self, schema) -> FolderReader:
        kind = AtomReader if self.options.get("pushdown") == "true" else FolderReader
        return kind(self.options["path"], int(self.options.get("files", 16)))


def read_atoms(spark: SparkSession, folder: str) -> DataFrame:
    """The atoms of the files below folder (a URI), through AtomSource. Filters reach it where the session's setting
    spark.sql.python.filterPushdown.enabled is on; else Spark applies them afterwards."""
    spark.dataSource.register(AtomSource)
    return spark.read.format(AtomSource.name()).option("path", folder).option("pushdown", spark.conf.get(PUSHDOWN, "false")).load()

"""Shared folders, table access and byte input/output for the corpus operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import lru_cache, wraps
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT = "spark.checkpoint.dir"
_PLAN_TEXT = "spark.sql.maxPlanStringLength"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ADAPTIVE = "spark.sql.adaptive.enabled"

#: The ASCII white space that separates words: space and \x09-\x0D.
WORD_BREAKS = " \t\n\x0b\x0c\r"


@lru_cache(1)
def _own_folder() -> str:
    at = tempfile.mkdtemp(prefix="foldlake-")
    atexit.register(shutil.rmtree, at, True)
    return "file://" + at


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Where the session leaves it unset, a local master, whose executors are the driver, gets a temporary folder, one for
    each process; on a cluster that is an error, as executors would not share such a folder.
    """
    at = spark.conf.get(_CHECKPOINT, None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or "local"):
            raise ValueError(f"{_CHECKPOINT} must name a folder that the driver and all executors share")
        at = _own_folder()
    return at.rstrip("/") if urlsplit(at).scheme else "file://" + at.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds within a block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spare_driver(spark: SparkSession) -> None:
    """Lets the driver's JVM collect garbage once it has taken half of the heap that it may: plans, broadcasts and generated
    classes of queries that are over go, and what the heap does not need goes back to the system."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if 2 * runtime.totalMemory() > runtime.maxMemory():
        runtime.gc()


@contextmanager
def short_plans(spark: SparkSession) -> Iterator[None]:
    """Within it the driver, which keeps a text of each plan and of each change that adaptive execution makes to it, keeps
    only its beginning."""
    with setting(spark, _PLAN_TEXT, "8192"):
        yield


def small_sums(df: DataFrame, columns: list[Column]) -> list:
    """The values of aggregates over all of a small table, for steps that ask often: in one plan that adaptive execution, which
    has nothing to choose there, does not change, and of which the driver keeps little."""
    with short_plans(df.sparkSession), setting(df.sparkSession, _ADAPTIVE, "false"):
        return list(df.agg(*columns).first())


def materialize(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends here and survives lost executors.

    The shuffle files behind it are of no more use once it is written, and go. The table goes with drop().
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    spare_driver(spark)
    with setting(spark, _CLEANUP, "true"), short_plans(spark):
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables that materialize() wrote and nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Keeps Arrow batches small, as executors hold one or two for each task outside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


_REMEMBERED: dict[tuple, object] = {}


def remembered(make):
    """make, whose last result this Python worker keeps, and no other that is remembered so.

    Workers run tasks of many stages, and each stage's table of words is large: that of the stage before goes, and what it
    took goes back to the system, so that tables do not add up over the stages of a pipeline.
    """

    @wraps(make)
    def get(*args):
        key = (make.__module__, make.__qualname__, args)
        if key not in _REMEMBERED:
            _REMEMBERED.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # a C library without it keeps what is free for itself
                ctypes.CDLL(None).malloc_trim(0)
            _REMEMBERED[key] = make(*args)
        return _REMEMBERED[key]

    return get


#: Most rows of ids that are sent whole to every task; more are joined.
BROADCAST_IDS = 500_000


def small_side(ids: DataFrame, rows: int) -> DataFrame:
    """ids, to be broadcast if there are few: a table of texts that meets them is then not shuffled."""
    return F.broadcast(ids) if rows <= BROADCAST_IDS else ids


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@contextmanager
def writing(uri: str) -> Iterator:
    """A binary output stream at uri. The file gets its name when it is whole, so a lost task leaves no part under it."""
    system, path = _filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{path}.part") as out:
        yield out
    system.move(f"{path}.part", path)


@contextmanager
def reading(uri: str) -> Iterator:
    """A seekable binary input stream at uri."""
    system, path = _filesystem(uri)
    with system.open_input_file(path) as file:
        yield file

"""Sinks: result tables as CSV, JSON and Parquet, and structure files written by the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlake.functions.text import fixed


def flat(df: DataFrame) -> DataFrame:
    """df with arrays, maps and structs as JSON text, for CSV."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(c).alias(c) if isinstance(t.dataType, nested) else F.col(c) for c, t in zip(df.columns, df.schema, strict=True)])


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).json(path) if partition_by else df.write.mode("overwrite").json(path)


def pdb_lines(atoms: DataFrame) -> DataFrame:
    """Atoms with line, their record of the PDB format."""
    name = F.when(F.length("atom_name") < 4, F.concat(F.lit(" "), F.rpad("atom_name", 3, " "))).otherwise(F.substring("atom_name", 1, 4))
    parts = [
        F.rpad(F.coalesce("group_pdb", F.lit("ATOM")), 6, " "),
        F.lpad((F.col("atom_serial") + 1).cast("string"), 5, " "),
        F.lit(" "),
        name,
        F.rpad(F.coalesce("altloc", F.lit(" ")), 1, " "),
        F.lpad(F.coalesce("label_comp_id", F.lit("")), 3, " "),
        F.lit(" "),
        F.rpad(F.coalesce("auth_asym_id", F.lit(" ")), 1, " "),
        F.lpad(F.coalesce("auth_seq_id", F.lit("")), 4, " "),
        F.rpad(F.coalesce("ins_code", F.lit(" ")), 1, " "),
        F.lit("   "),
        *[F.lpad(fixed(c, 3), 8, " ") for c in "xyz"],
        F.lpad(fixed(F.coalesce("occupancy", F.lit(1.0)), 2), 6, " "),
        F.lpad(fixed(F.coalesce("b_factor", F.lit(0.0)), 2), 6, " "),
        F.lit("          "),
        F.lpad(F.coalesce("element", F.lit("")), 2, " "),
    ]
    return atoms.withColumn("line", F.concat(*parts))


def structure_files(atoms: DataFrame, key: str = "structure_id") -> DataFrame:
    """key, text: a PDB text for each key, atoms by serial. One structure's atoms are one row."""
    lines = F.array_sort(F.collect_list(F.struct("atom_serial", "line")))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return pdb_lines(atoms).groupBy(key).agg(F.concat(body, F.lit("\nEND\n")).alias("text"))


def write_texts(df: DataFrame, out: str, key: str, text: str, suffix: str = "") -> DataFrame:
    """Writes text (a string, or bytes) of each row to out/key + suffix, under its name only when whole; returns key,
    path. Keys may name folders below out. The folder must be one that all executors share."""
    kind = dict(df.dtypes)[text]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from uuid import uuid4

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(out)
        for batch in batches:
            done = []
            for name, body in zip(batch[key], batch[text], strict=True):
                path = f"{base}/{name}{suffix}"
                system.create_dir(path.rpartition("/")[0], recursive=True)
                part = f"{path}.{uuid4().hex}.part"
                with system.open_output_stream(part) as stream:
                    stream.write(bytes(body or b"") if kind == "binary" else (body or "").encode())
                system.move(part, path)
                done.append((name, path))
            yield pd.DataFrame(done, columns=[key, "path"])

    return df.select(key, text).mapInPandas(write, f"{key} string, path string")

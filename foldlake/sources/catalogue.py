"""The complex catalogue: a tab-separated file read as text columns, with an ordinal of the input order."""

from __future__ import annotations

import os
import urllib.request

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Texts that stand for a missing value; fixed values.
MISSING = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>", "#N/A", "#NA", "#N/A N/A", "-nan", "-NaN", "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN")


def fetch(url: str, path: str, force: bool = False, timeout: float = 60.0) -> str:
    """Downloads url to path unless the file is there; returns path. A broken download leaves no file."""
    if force or not os.path.exists(path):
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with urllib.request.urlopen(url, timeout=timeout) as got, open(f"{path}.part", "wb") as out:
            while chunk := got.read(8192):
                out.write(chunk)
        os.replace(f"{path}.part", path)
    return path


def read_catalogue(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """All columns as text, missing-value texts as null, and ordinal, the place of the row in its file.

    Ordinals come from the places of the rows in the file splits, so large files are numbered without a single task;
    several files are ordered by name.
    """
    df = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).csv(path)
    df = df.select(*[F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in df.columns], F.col("_metadata").alias("_m"))
    place = F.struct("_m.file_path", "_m.file_block_start", F.monotonically_increasing_id())
    return df.withColumn("ordinal", place).drop("_m")


def numbered(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """df with ordinal as 0, 1, 2...; for small results only, as all rows meet in one task."""
    return df.withColumn(ordinal, (F.row_number().over(Window.orderBy(ordinal)) - 1).cast("long"))

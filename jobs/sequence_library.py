"""Keeps a library of unique sequences up to date as files of raw sequence texts arrive.

    python -m jobs.sequence_library --source TEXTS --output FOLDER --checkpoint FOLDER [--config FILE]

Each text (doc_id, text, lang, source) becomes a sequence as the sequence documents of the engine do it: capital letters
only, modified residues as their letters. Sequences that are too short are left out. Of equal sequences the library keeps
the first: that of the earliest run, then that with the smallest doc_id. A model or an alignment is made once for each of
them, so users want each sequence once and want to know which are new.

The source is a file stream with a checkpoint: a run takes the files that no earlier run took, and ends. A batch writes
the partitions `batch=<n>/lang=<...>` of FOLDER/library by dynamic overwrite and compares with earlier batches only, so a
batch that is repeated after a failure writes the same rows to the same place. FOLDER/report (partitions lang=<...>) holds
counts for each language and source and is written anew for the languages that a batch touched. A run without new files
changes nothing. Checkpoint and output belong together.

Null and empty texts have no sequence. A null or empty lang is `und`. A null doc_id comes last. Repeated rows are one
sequence. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.functions.residues import STANDARD, clean_sequence
from foldlake.functions.text import or_default
from foldlake.operators.catalogue import first_rows
from foldlake.session import scratch, session
from jobs import settings

SOURCE = "doc_id long, text string, lang string, source string"
LIBRARY = "doc_id long, source string, n_residues long, n_standard long, sequence_key string, sequence string, batch long, lang string"
REPORT = "source string, n_sequences long, n_residues long, shortest long, longest long, lang string"
LETTERS = "".join(sorted(STANDARD.values()))


@dataclass(frozen=True)
class Config:
    least_residues: int = 20
    files_a_batch: int | None = None


class Result(NamedTuple):
    library: DataFrame
    read: int
    written: int


def sequence(text: str) -> Column:
    """The sequence of a raw text in any case."""
    return clean_sequence(F.upper(F.replace(F.col(text), F.lit("ß"), F.lit("ss"))))


def sequences(texts: DataFrame, least: int) -> DataFrame:
    """doc_id, source, lang, n_residues, n_standard, sequence_key, sequence of the texts with sequences of so many residues."""
    rows = texts.select("doc_id", "source", or_default("lang", "und").alias("lang"), sequence("text").alias("sequence"))
    size = F.length("sequence").cast("long")
    standard = F.length(F.regexp_replace("sequence", f"[^{LETTERS}]", "")).cast("long")
    kept = rows.where(size >= least)
    return kept.select("doc_id", "source", "lang", size.alias("n_residues"), standard.alias("n_standard"), F.sha2("sequence", 256).alias("sequence_key"), "sequence")


def read_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows written to path; none if nothing was."""
    try:
        spark.read.parquet(path).limit(0).collect()
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def take(batch: DataFrame, number: int, output: str, config: Config) -> tuple[int, int]:
    """Adds a batch of texts to the library and brings the report up to date; returns the rows read and added."""
    spark = batch.sparkSession
    texts, seen = settings.counted(batch, f"read-{number}")
    found = first_rows(sequences(texts, config.least_residues), ["sequence_key"], [F.col("doc_id").asc_nulls_last(), "lang", "source"])
    known = read_back(spark, f"{output}/library", LIBRARY).where(F.col("batch") < number).select("sequence_key")
    new, added = settings.counted(found.join(known, "sequence_key", "left_anti"), f"added-{number}")
    _write(new.withColumn("batch", F.lit(number).cast("long")), f"{output}/library", "batch", "lang")
    library = read_back(spark, f"{output}/library", LIBRARY)
    touched = library.where(F.col("batch") == number).select("lang").distinct()
    report = library.join(touched, "lang", "left_semi").groupBy("lang", "source").agg(
        F.count("*").alias("n_sequences"), F.sum("n_residues").alias("n_residues"), F.min("n_residues").alias("shortest"), F.max("n_residues").alias("longest")
    )
    _write(report, f"{output}/report", "lang")
    counts = settings.rows(seen), settings.rows(added)
    settings.LOG.info("batch %d: read %d texts, added %d sequences to %s/library", number, *counts, output)
    return counts


def exactly(path: str) -> str:
    """A pattern that matches this path alone; patterns stay. A file stream takes a single file by a pattern only."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return path if re.search(r"[*?\[{]", path) else f"{parent}{slash}{{{name}}}"


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: Config = Config()) -> Result:
    """Takes what is new in source; returns the library as it stands, and how many texts were read and sequences added."""
    reader = spark.readStream.schema(SOURCE)
    if config.files_a_batch:
        reader = reader.option("maxFilesPerTrigger", config.files_a_batch)
    counts: list[tuple[int, int]] = []
    stream = reader.parquet(exactly(source)).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = stream.foreachBatch(lambda batch, number: counts.append(take(batch, number, output, config))).start()
    query.awaitTermination()
    read, written = (sum(c[k] for c in counts) for k in (0, 1))
    settings.LOG.info("read %d new texts from %s in %d batches, added %d sequences", read, source, len(counts), written)
    return Result(read_back(spark, f"{output}/library", LIBRARY), read, written)


def job1_sequence_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run twice on documents, in a new folder: its library after the second run."""
    at = scratch(spark, "job1")
    for _ in range(2):
        out = run(spark, f"{sf_dir}/documents.parquet", f"{at}/out", f"{at}/checkpoint")
    return out.library.drop("batch")


JOB1_SQL = rf"""
WITH s AS (SELECT doc_id, source, coalesce(nullif(lang, ''), 'und') AS lang,
  regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(upper(replace(text, 'ß', 'ss')), '[\n\r ]', '', 'g'),
  '(MSE)', 'M'), '(SEP)', 'S'), '(TPO)', 'T'), '(PTR)', 'Y'), '(CSO)', 'C'), '(HYP)', 'P'), '(MLY)', 'K'), '(CME)', 'C'), '\([A-Z]{{3}}\)', 'X', 'g'), '[^\p{{Lu}}]', '', 'g') AS sequence FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY sequence ORDER BY doc_id NULLS LAST, lang NULLS FIRST, source NULLS FIRST) AS k FROM s WHERE length(sequence) >= {Config.least_residues})
SELECT doc_id, source, lang, CAST(length(sequence) AS BIGINT) AS n_residues, CAST(length(regexp_replace(sequence, '[^{LETTERS}]', '', 'g')) AS BIGINT) AS n_standard,
  sha256(sequence) AS sequence_key, sequence FROM f WHERE k = 1
"""


def main(argv: Sequence[str] | None = None) -> None:
    paths = {"source": "Parquet files of texts", "output": "where library and report go", "checkpoint": "what was taken so far"}
    a = settings.parsed(__doc__.splitlines()[0], __file__, paths, argv)
    spark = session("sequence-library")
    try:
        run(spark, a.source, a.output, a.checkpoint, settings.load(Config, a.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

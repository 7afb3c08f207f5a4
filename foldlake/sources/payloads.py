"""Lookup tables from JSON payloads: one text a line, or a column of texts; and the log of payloads that were fetched.

The log only grows. Each try to fetch a key is a row: an answer has its payload, which is null where the service says that
there is none (gone), and a failure that may pass has its error. The latest answer counts; a failure never hides an
earlier answer and is never taken for one, so only keys without any answer are fetched again.
"""

from __future__ import annotations

import urllib.error
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldlake.operators.catalogue import first_rows
from foldlake.sources.entries import download

LOG = "key string, fetched_at timestamp, payload string, gone boolean, error string"

PROTEIN = (
    "primaryAccession string, entryType string, genes array<struct<geneName:struct<value:string>>>,"
    " organism struct<taxonId:int,scientificName:string>, sequence struct<value:string>,"
    " proteinDescription struct<recommendedName:struct<fullName:struct<value:string>>>,"
    " uniProtKBCrossReferences array<struct<database:string,id:string>>"
)
CHAIN_MAP = "map<string,struct<UniProt:map<string,struct<mappings:array<struct<chain_id:string>>>>>>"
SEARCH = "result_set array<struct<identifier:string>>"
ENTITY = "entity_poly struct<pdbx_strand_id:string>"


def proteins(df: DataFrame, payload: str = "payload") -> DataFrame:
    """accession, gene_name, taxon_id, organism, sequence, sequence_length, protein_name, ensembl_ids, reviewed,
    hit_rank (the column rank of df, the place of the protein among the hits of its search, if there is one)."""
    rank = F.col("rank") if "rank" in df.columns else F.lit(None)
    p = df.select(F.from_json(payload, PROTEIN).alias("p"), rank.cast("int").alias("hit_rank")).where("p IS NOT NULL")
    ids = F.transform(F.filter(F.coalesce("p.uniProtKBCrossReferences", F.array()), lambda x: x["database"] == "Ensembl"), lambda x: x["id"])
    gene = F.try_element_at("p.genes", F.lit(1))["geneName"]["value"]
    return p.select(
        F.col("p.primaryAccession").alias("accession"),
        F.coalesce(gene, F.lit("")).alias("gene_name"),
        F.col("p.organism.taxonId").alias("taxon_id"),
        F.coalesce("p.organism.scientificName", F.lit("")).alias("organism"),
        F.coalesce("p.sequence.value", F.lit("")).alias("sequence"),
        F.length(F.coalesce("p.sequence.value", F.lit(""))).alias("sequence_length"),
        F.coalesce("p.proteinDescription.recommendedName.fullName.value", F.lit("Unknown")).alias("protein_name"),
        ids.alias("ensembl_ids"),
        F.coalesce(F.col("p.entryType").contains("reviewed") & ~F.col("p.entryType").contains("unreviewed"), F.lit(True)).alias("reviewed"),
        "hit_rank",
    )


def chain_map(df: DataFrame, payload: str = "payload") -> DataFrame:
    """pdb, accession, rank, chain: accessions in the payload's order, of which the first that lists a chain counts."""
    whole = df.select(F.explode(F.from_json(payload, CHAIN_MAP)).alias("pdb", "v"))
    each = whole.select(F.lower("pdb").alias("pdb"), F.posexplode("v.UniProt").alias("rank", "accession", "m"))
    return each.select("pdb", "accession", "rank", F.explode("m.mappings.chain_id").alias("chain")).distinct()


def structures(df: DataFrame, accession: str = "accession", payload: str = "payload") -> DataFrame:
    """accession, rank, pdb, entity: hits in order; identifiers that are not of the form pdb_entity are left out."""
    hits = df.select(accession, F.posexplode(F.from_json(payload, SEARCH)["result_set"]).alias("rank", "hit"))
    parts = F.split("hit.identifier", "_")
    return hits.where(F.size(parts) == 2).select(accession, "rank", F.upper(parts[0]).alias("pdb"), parts[1].alias("entity"))


def entity_chains(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The columns of df and chains, the trimmed parts of the strand list."""
    text = F.from_json(payload, ENTITY)["entity_poly"]["pdbx_strand_id"]
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn("chains", parts).drop(payload)


def answers(log: DataFrame) -> DataFrame:
    """key, payload, fetched_at of the latest answer of each key of a log: a payload, or null where there is none. Of two at
    the same time the greater payload counts. Keys with failures only are left out, and so are null keys."""
    good = log.where("key IS NOT NULL AND error IS NULL AND (gone OR payload IS NOT NULL)")
    return first_rows(good, ["key"], [F.col("fetched_at").desc_nulls_last(), F.col("payload").desc_nulls_last()]).select("key", "payload", "fetched_at")


def unanswered(keys: DataFrame, log: DataFrame) -> DataFrame:
    """The distinct keys (column key, not null) that no row of the log answers."""
    return keys.select("key").where("key IS NOT NULL").distinct().join(answers(log), "key", "left_anti")


def fetch(keys: DataFrame, url: str, timeout: float = 30.0, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """A row of a log for each distinct key, from url, a template with {key}. An empty body, and the answers 204, 404 and
    410, mean that there is none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key in batch["key"]:
                payload, gone, error = None, False, None
                try:
                    payload = download(url.format(key=quote(key, safe="")), timeout, tries, wait).decode("utf-8", "replace") or None
                    gone = payload is None
                except urllib.error.HTTPError as e:
                    gone = e.code in (404, 410)
                    error = None if gone else f"HTTP {e.code}"
                except (OSError, ValueError) as e:
                    error = f"{type(e).__name__}: {e}"
                out.append((key, pd.Timestamp.now(tz="UTC"), payload, gone, error))
            yield pd.DataFrame(out, columns=["key", "fetched_at", "payload", "gone", "error"])

    return keys.select("key").where("key IS NOT NULL").distinct().mapInPandas(run, LOG)


def refresh(keys: DataFrame, path: str, url: str, **how) -> DataFrame:
    """Fetches the keys that the log at path (Parquet files) does not answer, appends what came, and returns all answers."""
    spark = keys.sparkSession

    def log() -> DataFrame:
        try:
            spark.read.parquet(path).limit(0).collect()
        except AnalysisException:
            return spark.createDataFrame([], LOG)
        return spark.read.schema(LOG).parquet(path)

    fetch(unanswered(keys, log()), url, **how).write.mode("append").parquet(path)
    return answers(log())

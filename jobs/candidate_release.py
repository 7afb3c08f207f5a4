"""Publishes a release of the best candidate for each target, with status, a library and a summary.

    python -m jobs.candidate_release --tables FOLDER --output FOLDER [--config FILE]

The dataset build in small, over plain tables: lines of orders are candidate structures of parts (the targets), their
price stands for the resolution, a flag for a complete antibody; suppliers, nations and regions are the chain of lookups
behind a candidate. A release holds, for every target,

- points/release=<tag>/status=<...>/region=<...>: its best candidate (complete ones first, then the lowest price, then the
  first in order) among the unique lines that pass the filter, with the looked-up names, status and message;
- library/release=<tag>/region=<...>: for each brand the success with the lowest price;
- summary/release=<tag>: counts by status and means, as JSON.

Targets without any candidate are failures with a message, so that none goes missing. A run writes its tag's folders
anew and leaves other releases as they are: running it again, also after a failure, gives the same files' rows.

Null keys have no candidates; null prices come last and fail; repeated lines count once; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.functions.text import sanitize
from foldlake.operators import catalogue, lookup, summary
from foldlake.session import scratch, session
from jobs import settings

POINTS = (
    "target long, name string, brand string, order_key long, line int, supplier_key long, supplier string, nation string, complete boolean,"
    " price double, error_message string, release string, status string, region string"
)


@dataclass(frozen=True)
class Config:
    release: str = "current"
    most_quantity: float = 40.0
    most_price: float = 50_000.0
    complete_flag: str = "A"


class Result(NamedTuple):
    points: DataFrame
    read: int
    written: int


def candidates(lines: DataFrame, config: Config) -> DataFrame:
    """target, order_key, line, supplier_key, complete, price: the best unique line of each part that passes the filter."""
    order = ["l_linenumber", "l_suppkey", F.col("l_extendedprice").asc_nulls_last(), "l_returnflag"]
    kept = catalogue.keep_all(lines, [("quantity", F.col("l_quantity") <= config.most_quantity), ("part", F.col("l_partkey").isNotNull()), ("status", catalogue.present("l_linestatus"))])
    unique = catalogue.first_rows(kept, ["l_orderkey", "l_partkey"], order)
    complete = F.coalesce(F.col("l_returnflag") == config.complete_flag, F.lit(False))
    best = catalogue.best_candidates(unique, ["l_partkey"], complete, "l_extendedprice", ["l_orderkey", "l_linenumber", "l_suppkey"])
    return best.select(
        F.col("l_partkey").alias("target"), F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").cast("int").alias("line"),
        F.col("l_suppkey").alias("supplier_key"), complete.alias("complete"), F.col("l_extendedprice").alias("price"),
    )


def points(part: DataFrame, best: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame, config: Config) -> DataFrame:
    """A row for each part with its candidate, the names behind it, status and message."""
    targets = part.select(F.col("p_partkey").alias("target"), sanitize("p_name", "target").alias("name"), F.col("p_brand").alias("brand"))
    rows = targets.join(best, "target", "left")
    steps = [
        (supplier.select(F.col("s_suppkey").alias("supplier_key"), F.col("s_name").alias("supplier"), "s_nationkey"), "supplier_key", "supplier"),
        (nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"), "n_regionkey"), "s_nationkey", "nation"),
        (region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")), "n_regionkey", "region"),
    ]
    for right, key, first in steps:
        rows = lookup.first_match(rows, right, [key], [first])
    high = F.coalesce(F.col("price") > config.most_price, F.lit(True))
    said = F.concat(F.lit("Price "), F.when(F.col("price").isNull(), "unknown").otherwise(F.format_string("%.2f", F.round("price", 2))), F.lit(f" above {config.most_price:.2f}"))
    state, message = lookup.status([
        (F.col("order_key").isNull(), "failed", "No candidate passes the filter"),
        (F.col("supplier").isNull() | F.col("nation").isNull(), "failed", "No supplier with a nation"),
        (high, "failed", said),
    ])
    rows = rows.withColumns({"status": state, "error_message": message, "release": F.lit(config.release), "region": F.coalesce("region", F.lit("none"))})
    return rows.select(*[c.split()[0] for c in POINTS.split(", ")])


def run(spark: SparkSession, tables: str, output: str, config: Config = Config()) -> Result:
    """Writes the release and returns its points, read back, with the number of lines read and points written."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{tables}/{name}.parquet")

    lines, seen = settings.counted(table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"), "lines")
    made, written = settings.counted(points(table("part"), candidates(lines, config), table("supplier"), table("nation"), table("region"), config), "points")
    at = {name: f"{output}/{name}/release={config.release}" for name in ("points", "library", "summary")}
    made.drop("release").write.mode("overwrite").partitionBy("status", "region").parquet(at["points"])
    counts = settings.rows(seen), settings.rows(written)
    settings.LOG.info("read %d lines from %s, wrote %d points to %s", counts[0], tables, counts[1], at["points"])
    out = spark.read.schema(POINTS).parquet(f"{output}/points").where(F.col("release") == config.release)
    library = summary.best_of_gene(out.where("status = 'success'"), "brand", "price", ["target"]).drop("status", "release")
    library, held = settings.counted(library, "library")
    library.write.mode("overwrite").partitionBy("region").parquet(at["library"])
    summary.status_summary(out.withColumn("share", F.col("complete").cast("double")), "status", "share", "price").write.mode("overwrite").json(at["summary"])
    settings.LOG.info("wrote %d rows to %s and the summary to %s", settings.rows(held), at["library"], at["summary"])
    return Result(out, *counts)


def job2_candidate_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job run twice on the tables, in a new folder: the points of its release after the second run."""
    at = scratch(spark, "job2")
    for _ in range(2):
        out = run(spark, sf_dir, at)
    return out.points.drop("release")


JOB2_SQL = f"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber NULLS FIRST, l_suppkey NULLS FIRST, l_extendedprice NULLS LAST, l_returnflag NULLS FIRST) AS k
  FROM lineitem WHERE l_quantity <= {Config.most_quantity} AND l_partkey IS NOT NULL AND l_linestatus <> 'NA'),
b AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN l_returnflag = '{Config.complete_flag}' THEN 0 ELSE 1 END, l_extendedprice NULLS LAST, l_orderkey, l_linenumber, l_suppkey) AS r FROM f WHERE k = 1),
p AS (SELECT p_partkey AS target, substr(regexp_replace(coalesce(nullif(p_name, ''), 'target'), '[^\\p{{L}}\\p{{N}}_-]', '_', 'g'), 1, 50) AS name, p_brand AS brand, l_orderkey AS order_key,
  CAST(l_linenumber AS INTEGER) AS line, l_suppkey AS supplier_key, s_name AS supplier, n_name AS nation, CASE WHEN l_orderkey IS NOT NULL THEN coalesce(l_returnflag = '{Config.complete_flag}', false) END AS complete,
  l_extendedprice AS price, r_name AS region
  FROM part LEFT JOIN b ON l_partkey = p_partkey AND r = 1 LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)
SELECT target, name, brand, order_key, line, supplier_key, supplier, nation, complete, price,
  CASE WHEN order_key IS NULL THEN 'No candidate passes the filter' WHEN supplier IS NULL OR nation IS NULL THEN 'No supplier with a nation'
    WHEN coalesce(price > {Config.most_price}, true) THEN 'Price ' || coalesce(printf('%.2f', round(price, 2)), 'unknown') || ' above {Config.most_price:.2f}' ELSE '' END AS error_message,
  CASE WHEN order_key IS NULL OR supplier IS NULL OR nation IS NULL OR coalesce(price > {Config.most_price}, true) THEN 'failed' ELSE 'success' END AS status, coalesce(region, 'none') AS region
FROM p
"""


def main(argv: Sequence[str] | None = None) -> None:
    paths = {"tables": "folder of lineitem, part, supplier, nation, region as <name>.parquet", "output": "where releases go"}
    a = settings.parsed(__doc__.splitlines()[0], __file__, paths, argv)
    spark = session("candidate-release")
    try:
        run(spark, a.tables, a.output, settings.load(Config, a.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

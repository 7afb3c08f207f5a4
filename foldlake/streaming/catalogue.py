"""New catalogue files as a stream: the filter of the dataset build applied as files arrive.

The engine's batch operators have no state but the deduplication, which a stream bounds by a watermark on arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlake.operators.catalogue import complex_conditions, keep_all

COLUMNS = ("pdb", "Hchain", "Lchain", "antigen_chain", "antigen_species", "antigen_type", "antigen_name", "resolution")


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the tab-separated files that arrive in a folder, with their arrival time."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
    rows = spark.readStream.schema(schema).option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    return rows.withColumn("arrived", F.current_timestamp())


def filtered(rows: DataFrame, resolution: float = 2.5, late: str = "1 day") -> DataFrame:
    """The rows that the catalogue filter keeps, the first of each (pdb, antigen_chain) within the watermark."""
    kept = keep_all(rows, complex_conditions(rows, resolution))
    return kept.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["pdb", "antigen_chain"])

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of documents tables with extra columns whose names clash with those that operators use inside."""

    def make(rows, schema="doc_id long, text string, lang string, source string"):
        full = [(*r, "en", "src")[:4] if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame(full, schema)
        for name in ("n", "fp", "node", "key", "words", "rank", "label", "kept", "_text", "id", "row", "h"):
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("clash"))
        return df

    return make

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with clashing extra columns from (doc_id, text) rows."""
    def make(rows, parts=3):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.repartition(parts).withColumns({
            "lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"),
            "score": F.lit("clash"), "kept": F.lit("clash"), "value": F.lit(None).cast("int")})

    return make

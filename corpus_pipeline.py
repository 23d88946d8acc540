"""Pipeline over documents: quality, near-duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and its
result is written as Parquet to the shared folder and read again. All but the last return the
columns of ``docs``, extra ones included. The SQL check has none: several stages can't be stated in
SQL. An empty table stays empty in every stage; texts may be null, empty or very long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rolepulse.llm import decontamination, near_dedup, packing, pii, quality_classifier
from rolepulse.llm.texts import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Each row is judged by itself, repeats and rows without an id too; a null text is scored as an empty one."""
    return quality_classifier.accepted(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: that of the least id. Rows of one id are one; rows without an id, and texts without a word under ids of their own, all stay."""
    return near_dedup.deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. A null or empty text has none; each row is judged by itself."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with labels in the place of personal data; a null text stays null."""
    return pii.redacted(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each row lies in the training sequences; a null or empty text is the one id that ends it."""
    return packing.packed(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks),
          ("personal_data", personal_data), ("sequences", sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Copies of tables: layout kept, rows compared before anything is dropped."""

import uuid

import pytest
from pyspark.sql import functions as F

from rolepulse.operators import tableops as O


@pytest.fixture
def databases(spark):
    names = [f"copies_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    for n in names:
        spark.sql(f"CREATE DATABASE {n}")
    yield names
    for n in names:
        spark.sql(f"DROP DATABASE {n} CASCADE")


def rows_of(spark):
    return spark.range(500).select(
        "id", (F.col("id") % 5).alias("b"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("z"), (F.col("id") % 3).cast("string"))).alias("zone"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("day"))


def test_copies_keep_folders_and_buckets(spark, databases):
    one, two = databases
    df = rows_of(spark)
    O.create_table_as(df, f"{one}.plain")
    O.create_table_as(df, f"{one}.folders", ["zone", "day"])
    O.create_table_as(df, f"{one}.both", ["day"], O.Buckets(3, ["b", "id"], ["id"]))
    assert sorted(O.copy_database(spark, one, two)) == ["both", "folders", "plain"]
    want = sorted(map(tuple, df.collect()), key=repr)
    for t, layout in (("plain", ([], None)), ("folders", (["zone", "day"], None)), ("both", (["day"], O.Buckets(3, ["b", "id"], ["id"])))):
        assert O.table_layout(spark, f"{two}.{t}") == layout
        assert sorted(map(tuple, spark.table(f"{two}.{t}").select(df.columns).collect()), key=repr) == want
    assert spark.sql(f"SHOW PARTITIONS {two}.folders").count() == spark.sql(f"SHOW PARTITIONS {one}.folders").count()


def test_a_wrong_copy_is_an_error_and_the_old_table_stays(spark, databases, monkeypatch):
    one, two = databases
    O.create_table_as(rows_of(spark), f"{one}.t", ["day"])
    real = O.create_table_as
    for wrong in (lambda df: df.where("id <> 7"), lambda df: df.withColumn("b", F.when(F.col("id") == 7, 9).otherwise(F.col("b"))),
                  lambda df: df.withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id")))):
        monkeypatch.setattr(O, "create_table_as", lambda df, *a, f=wrong: real(f(df), *a))
        with pytest.raises(ValueError, match="not the 500"):
            O.rename_table(spark, f"{one}.t", f"{two}.t")
        assert spark.table(f"{one}.t").count() == 500 and not spark.catalog.tableExists(f"{two}.t")
    monkeypatch.setattr(O, "create_table_as", real)
    assert O.rename_table(spark, f"{one}.t", f"{two}.t").count() == 500
    assert not spark.catalog.tableExists(f"{one}.t") and O.table_layout(spark, f"{two}.t") == (["day"], None)


def test_row_sums_see_repeated_and_null_rows(spark):
    df = rows_of(spark)
    assert O.row_sums(df) == O.row_sums(df.repartition(7).orderBy("b"))
    assert O.row_sums(df) != O.row_sums(df.union(df.limit(1))) and O.row_sums(df.where("false")) == (0, 0)

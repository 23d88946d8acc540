"""Table operations. Tables are versioned folders: a change writes a new version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Buckets:
    """Files of a table by the hash of some columns."""

    count: int
    columns: list[str]
    sorted_by: list[str]


def quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def replace_into(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows of ``target`` after replacing by key.

    A replaced row is deleted and inserted anew: columns the source lacks take
    their default (NULL if none is given), never the old value. Among source rows
    of one key the last by ``order`` wins; the choice is an aggregate, so a key
    with very many source rows is combined before it is shuffled.
    """
    defaults = defaults or {}
    given = [c for c in target.columns if c in source.columns]
    last = last_by(source.select(*given, *[c for c in order or [] if c not in given]), keys, order or given)
    types = {f.name: f.dataType for f in target.schema.fields}
    fresh = last.select(*[
        (F.col(c) if c in given else defaults.get(c, F.lit(None))).cast(types[c]).alias(c) for c in target.columns
    ])
    return target.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def last_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole last row of each key by ``order``."""
    return _end_by(rows, keys, order, F.max_by)


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole first row of each key by ``order``."""
    return _end_by(rows, keys, order, F.min_by)


def _end_by(rows, keys, order, pick) -> DataFrame:
    whole = F.struct(*[F.col(c) for c in rows.columns])
    # Remaining columns break ties, so the pick does not depend on the run.
    full = F.struct(*[F.col(c) for c in [*order, *[c for c in rows.columns if c not in order]]])
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        pick(whole, full).alias("_r")).select("_r.*")


def sorted_rows(rows: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Global order by ``keys``; the unique ``tie`` lets the range sort split rows with equal keys."""
    return rows.orderBy(*keys, tie)


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Write a new version of a table and return it."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_table_as(df: DataFrame, table: str, partitions: list[str] | None = None, buckets: Buckets | None = None) -> DataFrame:
    """Table with the rows of ``df``, in folders by ``partitions`` and files by ``buckets``."""
    writer = (df.hint("rebalance", *map(F.col, partitions)) if partitions and buckets is None else df).write.format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if buckets is not None:
        writer = writer.bucketBy(buckets.count, *buckets.columns)
        writer = writer.sortBy(*buckets.sorted_by) if buckets.sorted_by else writer
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def table_layout(spark: SparkSession, table: str) -> tuple[list[str], Buckets | None]:
    """Partition columns and buckets of a table, from the catalog."""
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}
    names = lambda key: [n.strip(" `") for n in told.get(key, "").strip("[]").split(",") if n.strip(" `")]
    count = int(told.get("Num Buckets", 0))
    return partitions, Buckets(count, names("Bucket Columns"), names("Sort Columns")) if count else None


def row_sums(df: DataFrame) -> tuple[int, int]:
    """Number of rows, and the sum of their hashes: equal for equal rows in any order."""
    total = F.sum(F.xxhash64(*[F.col(quoted(c)) for c in df.columns]).cast("decimal(38,0)"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(total, F.lit(0)).alias("total")).first()
    return row["n"], int(row["total"])


def copy_table(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Copy of a table in its layout; an error, and no copy, if its rows are not the same."""
    copy = create_table_as(spark.table(old), new, *table_layout(spark, old))
    want, got = row_sums(spark.table(old)), row_sums(copy.select(*spark.table(old).columns))
    if want != got:
        spark.sql(f"DROP TABLE {quoted(new)}")
        raise ValueError(f"{new} has {got[0]} rows that are not the {want[0]} of {old}")
    return copy


def create_table_like(spark: SparkSession, new: str, old: str) -> DataFrame:
    """Empty table with the columns of another."""
    spark.sql(f"CREATE TABLE {quoted(new)} LIKE {quoted(old)} USING parquet")
    return spark.table(new)


def insert_select(source: DataFrame, condition: Column, table: str) -> None:
    """Append the rows that meet a condition."""
    source.where(condition).select(*source.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def truncate_table(spark: SparkSession, table: str) -> DataFrame:
    """Delete every row, keep the columns."""
    spark.sql(f"TRUNCATE TABLE {quoted(table)}")
    return spark.table(table)


def rename_table(spark: SparkSession, old: str, new: str) -> DataFrame:
    """Rename a table; into another database by copying it, comparing the rows, and dropping the old one."""
    def database(name: str) -> str:
        return name.split(".")[0] if "." in name else spark.catalog.currentDatabase()

    if database(old) == database(new):
        spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new)}")
    else:
        copy_table(spark, old, new)
        spark.sql(f"DROP TABLE {quoted(old)}")
    return spark.table(new)


def add_column_default(df: DataFrame, name: str, sql_type: str = "int", default=0) -> DataFrame:
    """New NOT NULL column: existing rows get the default."""
    return df.withColumn(name, F.lit(default).cast(sql_type))


def change_column_type(df: DataFrame, name: str, sql_type: str = "tinyint", strict: bool = True) -> DataFrame:
    """Retype a column; a value out of range is an error, or NULL when not strict."""
    old = F.col(name)
    new = old.try_cast(sql_type)
    if strict:
        # Stated here so that it does not depend on the session's ANSI setting.
        bad = F.raise_error(F.concat(F.lit(f"{name} does not fit {sql_type}: "), old.cast("string"))).cast(sql_type)
        new = F.when(old.isNotNull() & new.isNull(), bad).otherwise(new)
    return df.withColumn(name, new)


def update_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Set a column to one value on every row."""
    return df.withColumn(name, F.lit(value).cast(df.schema[name].dataType))


def copy_database(spark: SparkSession, old: str, new: str) -> list[str]:
    """Copy every table of a database, in its layout, into a new one; returns the table names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(new)}")
    names = [t.name for t in spark.catalog.listTables(old) if not t.isTemporary]
    for name in names:
        copy_table(spark, f"{old}.{name}", f"{new}.{name}")
    return names

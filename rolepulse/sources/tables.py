"""Flow and role tables kept as Parquet folders or behind JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.layouts import FLOW_FIELDS, REPLAY_ORDER, check_type, table_type


def table_path(root: str, log_type: str) -> str:
    return f"{root}/flow_{table_type(check_type(log_type))}"


def read_flow_table(spark: SparkSession, root: str, log_type: str) -> DataFrame:
    """A loaded flow table; filters on ``zone`` and ``day`` prune folders."""
    columns = ", ".join(f"{n} {t}" for n, t in FLOW_FIELDS[check_type(log_type)])
    schema = f"sn bigint, log_time timestamp_ntz, {columns}, zone string, day date"
    names = ["sn", "log_time", *[n for n, _ in FLOW_FIELDS[log_type]], "zone", "day"]
    return spark.read.schema(schema).parquet(table_path(root, log_type)).select(*names)


def read_flow_events(
    spark: SparkSession, root: str, types: tuple[str, ...] = ("createrole", *REPLAY_ORDER)
) -> DataFrame:
    """Loaded tables as one event table; ``sn`` is the line order inside a zone. Columns of other types are NULL."""
    out = None
    for t in types:
        rows = read_flow_table(spark, root, t).withColumn("log_type", F.lit(t)).withColumnRenamed("sn", "ord")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    columns = {n: kind for fields in FLOW_FIELDS.values() for n, kind in fields}
    return out.withColumns({n: F.lit(None).cast(kind) for n, kind in columns.items() if n not in out.columns})


def write_flow_lake(events: DataFrame, path: str) -> None:
    """All flow types as one table, the type as its folders; columns a type lacks are NULL."""
    events.hint("rebalance", F.col("log_type")).write.mode("errorifexists").partitionBy("log_type").parquet(path)


def read_flow_lake(spark: SparkSession, path: str, types: tuple[str, ...] = tuple(FLOW_FIELDS)) -> DataFrame:
    """Wanted types of a table by :func:`write_flow_lake`, in one scan of their folders."""
    columns = {n: t for fields in FLOW_FIELDS.values() for n, t in fields}
    schema = "zone string, day date, ord bigint, log_time timestamp_ntz, " + ", ".join(f"{n} {t}" for n, t in columns.items())
    return spark.read.schema(f"{schema}, log_type string").parquet(path).where(F.col("log_type").isin([check_type(t) for t in types]))


# Without them the whole table comes through one connection and one task.
_SPREAD = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_jdbc(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    """A table of an external database. Address and credentials come from the caller.

    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` (for instance
    over ``sn``) are required: they spread the read over tasks.
    """
    missing = [o for o in _SPREAD if o not in options]
    if missing:
        raise ValueError(f"reading a table over JDBC needs the options {', '.join(missing)}")
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()

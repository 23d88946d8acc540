"""Flow tables: typed, numbered, appended, one folder per run, zone and file day."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.layouts import FLOW_FIELDS, VALID_ZONES, check_type
from rolepulse.operators.numbering import assign_sn
from rolepulse.sinks.loadlog import LoadLog
from rolepulse.sources.flowfiles import failed_fields, loader_fields, typed
from rolepulse.sources.manifest import row_of, split_of, valid_zone
from rolepulse.sources.tables import table_path


def last_sn(spark: SparkSession, path: str) -> dict[str, int]:
    """Largest ``sn`` per zone of an existing table; empty when there is no table yet."""
    try:
        table = spark.read.schema("sn bigint, zone string").parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {}
    # One row per zone of the short zone list.
    return {r["zone"]: r["sn"] for r in table.groupBy("zone").agg(F.max("sn").alias("sn")).collect()}


def load_flow_table(
    lines: DataFrame, log_type: str, root: str, zones: Iterable[str] = VALID_ZONES, run: str | None = None,
) -> str:
    """Append the flow lines of one type to its table and return the table path.

    ``lines`` is what the flow-file readers give for that type. Rows get the next
    numbers of their zone's table, in day and line order. A ``run`` that has a name is
    loaded once: repeated after a failure it gets the numbers it had, repeated after success
    it does nothing. Without a name every call is a run of its own.

    A field that is missing or not of its type becomes NULL. Such lines are loaded, and kept as they
    are, with the names of these fields, in the rejects of the run (:func:`read_rejects`).
    """
    spark = lines.sparkSession
    fields = [n for n, _ in FLOW_FIELDS[check_type(log_type)]]
    path, run = table_path(root, log_type), run or uuid.uuid4().hex
    log = LoadLog(spark, path)
    if log.in_place(run):
        return path
    attempt = f"_loads/runs/{run}/{uuid.uuid4().hex}"
    try:
        rows = lines.where((F.col("log_type") == log_type) & valid_zone(F.col("zone"), zones))
        failed = failed_fields(log_type, loader_fields(F.col("value")))
        checked = rows.withColumns({"_failed": failed, "_line": F.col("value")})
        line = F.when(F.size("_failed") > 0, F.col("_line"))
        typed_rows = typed(checked, log_type, loader_fields).select("zone", "day", "ord", "log_time", *fields, "_failed", line.alias("_line"))
        typed_rows.write.parquet(log.folder.at(f"{attempt}/stage"))
        staged = spark.read.schema(typed_rows.schema).parquet(log.folder.at(f"{attempt}/stage"))
        # One row per zone of the short zone list.
        sizes = staged.groupBy("zone").agg(F.count(F.lit(1)).alias("n"), F.count("_line").alias("bad")).collect()
        count = {r["zone"]: r["n"] for r in sizes}
        # Tables from before the log are numbered on from their rows.
        entry = log.reserve(run, count, last_sn(spark, path) if not log.entries() else {})
        start = spark.createDataFrame([(z, n - 1) for z, n in entry.first.items()], "zone string, start bigint")
        # A chunk is one split of one file, so its size is bounded by the split size. Whole
        # files are kept or dropped above, so the line ids inside a split have no gaps.
        numbered = assign_sn(
            staged, order=["ord"], chunk=[split_of(F.col("ord"))], scope=["zone"], start=start, position=row_of(F.col("ord")),
        )
        (
            numbered.select("sn", "log_time", *fields, "zone", "day").hint("rebalance", F.col("zone"), F.col("day"))
            .write.partitionBy("zone", "day").parquet(log.folder.at(f"{attempt}/rows"))
        )
        if any(r["bad"] for r in sizes):
            bad = staged.where("_line IS NOT NULL").select("zone", "day", F.col("_line").alias("line"), F.col("_failed").alias("fields"))
            bad.write.mode("overwrite").parquet(log.folder.at(f"_loads/rejects/run={run}"))
        log.commit(f"{attempt}/rows", run)
    except Exception:
        # The same run may have been put in place by another caller meanwhile.
        if not log.in_place(run):
            log.folder.delete(attempt)
            raise
    log.folder.delete(f"_loads/runs/{run}")
    return path


def read_rejects(spark: SparkSession, log_type: str, root: str) -> DataFrame:
    """Lines loaded with NULL fields by any run: run, zone, day, line, fields."""
    schema = "zone string, day string, line string, fields array<string>, run string"
    log = LoadLog(spark, table_path(root, log_type))
    if not log.folder.exists("_loads/rejects"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(log.folder.at("_loads/rejects"))


def load_flow_tables(
    read: Callable[[str], DataFrame], root: str, types: Iterable[str] = tuple(FLOW_FIELDS), zones: Iterable[str] = VALID_ZONES,
    run: str | None = None,
) -> dict[str, str]:
    """Load every wanted type of some zones, ``read`` giving its lines; returns type -> table path."""
    return {t: load_flow_table(read(t), t, root, zones, run) for t in types}

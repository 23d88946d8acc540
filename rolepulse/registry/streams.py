"""Queries: routed writes, batch and streaming, read back."""

from pyspark.sql import functions as F

from rolepulse.layouts import VALID_ZONES
from rolepulse.registry.base import RAW, flow_events, flow_lines, grow, query, raw_lines, raw_root, sql
from rolepulse.registry.parsing import _FLOW_LINE
from rolepulse.registry.sources import _RAW_ROWS
from rolepulse.session import work_path
from rolepulse.sinks.flowtables import load_flow_table, read_rejects
from rolepulse.sinks.plainfiles import write_plain
from rolepulse.sinks.routed import route_raw
from rolepulse.sources import formatlog
from rolepulse.sources.flowfiles import read_partitioned
from rolepulse.sources.manifest import manifest
from rolepulse.streaming import ingest

_ROUTED = _FLOW_LINE.replace("SELECT ord,", "SELECT zone, CAST(day AS VARCHAR) AS day, log_type,")


def _back(spark, path):
    return read_partitioned(spark, path).select("zone", "day", "log_type", F.col("value").alias("line"))


@query("route_by_type", sql(_ROUTED, "fl"))
def route_by_type(spark, d):
    out = work_path(spark, "routed")
    route_raw(formatlog.read_raw(spark, raw_root(spark, d), **RAW), out)
    return _back(spark, out)


def _stream(spark, d, runs=1):
    out = work_path(spark, "stream")
    counts = [ingest.run_once(spark, raw_root(spark, d), out, out + "-checkpoint", **RAW) for _ in range(runs)]
    return out, counts


@query("stream_parse_route", sql(_ROUTED, "fl"))
def stream_parse_route(spark, d):
    return _back(spark, _stream(spark, d)[0])


@query("stream_restart_once", sql(_ROUTED, "fl"))
def stream_restart_once(spark, d):
    """A second run on the same checkpoint must add nothing."""
    return _back(spark, _stream(spark, d, runs=2)[0])


@query("stream_replay", sql(_ROUTED, "fl"))
def stream_replay(spark, d):
    """After a normal run everything is processed again into a new output."""
    _stream(spark, d)
    return _back(spark, ingest.replay(spark, raw_root(spark, d), **RAW))


@query("replay_from_start", sql("""
    SELECT zone, log_type, count(*) AS lines FROM fl WHERE log_type <> 'award' GROUP BY zone, log_type""", "fl"))
def replay_from_start(spark, d):
    out = ingest.replay(spark, raw_root(spark, d), max_files=16, **RAW)
    return _back(spark, out).groupBy("zone", "log_type").agg(F.count(F.lit(1)).alias("lines"))


@query("scan_formatlog_stream", sql(_RAW_ROWS, "fl"))
def scan_formatlog_stream(spark, d):
    """The streaming scan of growing files, its records kept as a table: two runs, between them the files grow."""
    out = work_path(spark, "scan")
    for turn in range(2):
        grow(spark, d, f"{out}-raw", turn)
        lines = formatlog.read_growing_stream(spark, f"{out}-raw", zones=VALID_ZONES)
        rows = formatlog.with_path_fields(formatlog.parse(lines))
        rows = rows.select("zone", "day", "log_type", F.col("log_time").try_cast("timestamp_ntz").alias("log_time"),
                           F.col("roleid").try_cast("bigint").alias("roleid"))
        q = (rows.writeStream.format("parquet").option("checkpointLocation", out + "-checkpoint")
             .trigger(availableNow=True).start(out))
        q.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@query("stream_growing_files", sql(_ROUTED, "fl"))
def stream_growing_files(spark, d):
    """The whole ingest of growing files in two runs; the first finds files that end inside of a line."""
    out = work_path(spark, "growing")
    for turn in range(2):
        grow(spark, d, f"{out}-raw", turn)
        ingest.run_once(spark, f"{out}-raw", out, out + "-checkpoint", zones=VALID_ZONES, growing=True)
    return _back(spark, out)


@query("reject_raw_lines", sql("""
    SELECT zone, CAST(day AS VARCHAR) AS day, reason, count(*) AS lines FROM (
      SELECT zone, day, CASE WHEN log_type = 'award' THEN NULL WHEN ord % 50 = 3 THEN 'no_pattern' END AS reason FROM fl)
    WHERE reason IS NOT NULL GROUP BY ALL""", "fl"))
def reject_raw_lines(spark, d):
    """Every fiftieth raw line has a role id that is no number: the ingest keeps these lines beside its output."""
    out = work_path(spark, "rejects")
    lines = raw_lines(flow_events(spark, d))
    broken = F.when(F.col("ord") % 50 == 3, F.replace("value", F.lit("roleid="), F.lit("roleid=#"))).otherwise(F.col("value"))
    lines.select(broken.alias("value"), "zone", "day").write.partitionBy("zone", "day").text(f"{out}-raw")
    route_raw(formatlog.read_raw(spark, f"{out}-raw", **RAW), out, rejects=f"{out}-rejects")
    kept = spark.read.schema("value string, path string, reason string").parquet(f"{out}-rejects")
    return kept.groupBy(formatlog.path_zone(F.col("path")).alias("zone"), formatlog.path_day(F.col("path")).alias("day"), "reason").agg(
        F.count(F.lit(1)).alias("lines"))


@query("reject_flow_lines", sql("""
    SELECT zone, CAST(day AS VARCHAR) AS day, CASE WHEN ord % 3 = 0 THEN 'level' ELSE 'log_time' END AS field, count(*) AS lines
    FROM fl WHERE log_type = 'levelup' AND ord % 7 = 1 GROUP BY ALL""", "fl"))
def reject_flow_lines(spark, d):
    """Every seventh level-up line has a broken level or clock: it is loaded with a NULL and kept as it was."""
    root = work_path(spark, "reject-tables")
    lines = flow_lines(spark, d).where("log_type = 'levelup'")
    fields = F.split("value", " ")
    cut = F.when(F.col("ord") % 3 == 0, F.array_join(F.concat(F.slice(fields, 1, 4), F.array(F.lit("x")), F.slice(fields, 6, 9)), " ")).otherwise(
        F.concat(F.lit("?"), "value"))
    write_plain(lines.withColumn("value", F.when(F.col("ord") % 7 == 1, cut).otherwise(F.col("value"))), "ord", f"{root}/flows")
    load_flow_table(manifest(spark, f"{root}/flows").lines(), "levelup", f"{root}/tables")
    return read_rejects(spark, "levelup", f"{root}/tables").select("zone", "day", F.explode("fields").alias("field")).groupBy(
        "zone", "day", "field").agg(F.count(F.lit(1)).alias("lines"))

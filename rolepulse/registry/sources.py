"""Queries: scans of raw logs, flow files and tables laid down from the events."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rolepulse.layouts import FLOW_FIELDS, REPLAY_ORDER
from rolepulse.operators import numbering
from rolepulse.plans import activity as A
from rolepulse.registry.base import (
    AS_OF, END, RAW, START, flow_events, flow_root, loaded_table, names_root, plain_root, query, raw_root, sql, table_root,
)
from rolepulse.registry.state import STATE
from rolepulse.sources import flowfiles, formatlog
from rolepulse.sources.eventmap import flow_of
from rolepulse.sources.manifest import manifest
from rolepulse.sources.tables import read_flow_events

_RAW_ROWS = """
    SELECT zone, CAST(day AS VARCHAR) AS day, log_type, log_time, roleid FROM fl WHERE log_type <> 'award'"""


def raw_records(lines):
    """Parsed raw lines in a comparable shape."""
    rows = formatlog.with_path_fields(formatlog.parse(lines))
    return rows.select("zone", "day", "log_type", F.col("log_time").try_cast("timestamp_ntz").alias("log_time"),
                       F.col("roleid").try_cast("bigint").alias("roleid"))


@query("scan_formatlog_batch", sql(_RAW_ROWS, "fl"))
def scan_formatlog_batch(spark, d):
    return raw_records(formatlog.read_raw(spark, raw_root(spark, d), **RAW))


@query("discover_flow_files", sql("""
    SELECT zone, log_type, string_agg(name, ' ' ORDER BY name) AS files FROM (
      SELECT DISTINCT zone, log_type, CAST(day AS VARCHAR) || '_' || log_type AS name FROM fl
      WHERE zone <> '1005')
    GROUP BY zone, log_type""", "fl"))
def discover_flow_files(spark, d):
    """Written files; those of zone 1005 lack the underscore and are skipped."""
    return flowfiles.discover(spark, names_root(spark, d)).select(
        "zone", "log_type", F.array_join("file_list", " ").alias("files"))


@query("sort_files", sql("""
    SELECT zone, log_type, name, CAST(row_number() OVER (PARTITION BY zone, log_type ORDER BY name) - 1 AS INTEGER)
           AS position
    FROM (SELECT DISTINCT zone, log_type, CAST(day AS VARCHAR) || '_' || log_type AS name FROM fl)""", "fl"))
def sort_files(spark, d):
    """Written files, placed by their rank in the manifest."""
    files = manifest(spark, plain_root(spark, d)).files.where("log_type <> 'instance'")
    place = F.row_number().over(Window.partitionBy("zone", "log_type").orderBy("rank")) - 1
    return files.select("zone", "log_type", "name", place.alias("position"))


@query("scan_flow_range", sql(f"""
    SELECT zone, day, log_type, log_time, roleid, level, CAST(profession AS INTEGER) AS profession, action,
           online_time, task_id, usetime, killer, scene, pos, award FROM fl
    WHERE day BETWEEN DATE '{START}' AND DATE '{END}' AND log_type <> 'createrole'""", "fl"))
def scan_flow_range(spark, d):
    lines = flowfiles.scan_range(spark, flow_root(spark, d), AS_OF, REPLAY_ORDER)
    return flowfiles.typed_events(lines).select(
        "zone", "day", "log_type", "log_time", "roleid", "level", F.col("profession").cast("int").alias("profession"),
        "action", "online_time", "task_id", "usetime", "killer", "scene", "pos", "award")


@query("first_available_day", sql("SELECT CAST(day AS VARCHAR) AS day FROM firstday", "firstday"))
def first_available_day(spark, d):
    return flowfiles.first_available_day(flowfiles.list_partitions(spark, flow_root(spark, d)), AS_OF)


@query("read_cohort", sql("SELECT roleid, create_time, profession, nation FROM cohort", "cohort"))
def read_cohort(spark, d):
    cohort = A.read_cohort(flow_events(spark, d, "createrole"), AS_OF)
    return cohort.select("roleid", "create_time", F.col("profession").cast("int").alias("profession"),
                         F.col("nation").cast("int").alias("nation"))


@query("read_single_flow", sql("""
    SELECT log_time, roleid, level, task_id, action FROM fl
    WHERE log_type = 'taskflow' AND zone = '1002' AND day = DATE '2024-01-10'""", "fl"))
def read_single_flow(spark, d):
    lines = flowfiles.read_partitioned(
        spark, flow_root(spark, d), ["taskflow"], ("2024-01-10", "2024-01-10"), ["1002"])
    return flowfiles.typed(lines, "taskflow").select("log_time", "roleid", "level", "task_id", "action")


@query("read_flow_table", sql("SELECT roleid, level FROM fl WHERE log_type = 'levelup' AND zone = '1004'", "fl"))
def read_flow_table(spark, d):
    return loaded_table(spark, d, "levelup").where(F.col("zone") == "1004").select("roleid", "level")


@query("role_activity_from_flow_files", sql(f"SELECT {STATE} FROM replayed", "replayed"))
def role_activity_from_flow_files(spark, d):
    """The replay over flow files: day, type and line order come from the files."""
    events, created = flowfiles.activity_inputs(spark, flow_root(spark, d), AS_OF)
    return A.role_activity(events, AS_OF, replay=True, cohort=A.stored_cohort(created, AS_OF))


@query("role_activity_from_plain_files", sql(f"SELECT {STATE} FROM replayed", "replayed"))
def role_activity_from_plain_files(spark, d):
    """The replay over ``<zone>/<day>_<type>`` files: all of them are listed once, those of the range are opened."""
    events, created = flowfiles.activity_inputs(spark, plain_root(spark, d), AS_OF)
    return A.role_activity(events, AS_OF, replay=True, cohort=A.stored_cohort(created, AS_OF))


@query("role_activity_from_flow_tables", sql(f"SELECT {STATE} FROM replayed", "replayed"))
def role_activity_from_flow_tables(spark, d):
    """The replay over loaded tables, where the line order is the running number."""
    for t in (*REPLAY_ORDER, "createrole"):
        loaded_table(spark, d, t)
    root = table_root(spark, d)
    cohort = A.stored_cohort(read_flow_events(spark, root, ("createrole",)), AS_OF)
    return A.role_activity(read_flow_events(spark, root, REPLAY_ORDER), AS_OF, replay=True, cohort=cohort)


def _register_loads() -> None:
    columns = {
        "createrole": "profession, nation", "roleloginlogout": "action, level, online_time",
        "taskflow": "level, task_id, action", "levelup": "profession, level, usetime",
        "death": "level, killer, killer_level, scene, pos", "award": "level, award",
        "instance": "k AS level, k AS instance_tid, CAST(ord % 2 AS INTEGER) AS status",
    }
    for log_type in FLOW_FIELDS:
        source = "taskflow" if log_type == "instance" else log_type
        statement = sql(f"""
            SELECT row_number() OVER (PARTITION BY zone ORDER BY ord) AS sn, zone, log_time, roleid,
                   {columns[log_type]} FROM fl WHERE log_type = '{source}'""", "fl")

        def load(spark, d, log_type=log_type):
            table = loaded_table(spark, d, log_type)
            names = [n for n, _ in FLOW_FIELDS[log_type]]
            kinds = dict(FLOW_FIELDS[log_type])
            return table.select("sn", F.col("zone").cast("string").alias("zone"), "log_time", *[
                F.col(n).cast("int").alias(n) if kinds[n] == "tinyint" else F.col(n) for n in names])

        query(f"load_flow_{'task' if log_type == 'taskflow' else log_type}", statement)(load)


_register_loads()


@query("load_flow_tables", sql("""
    SELECT log_type, zone, count(*) AS row_count, count(*) AS last_sn FROM (
      SELECT log_type, zone FROM fl UNION ALL SELECT 'instance', zone FROM fl WHERE log_type = 'taskflow')
    GROUP BY log_type, zone""", "fl"))
def load_flow_tables(spark, d):
    """Size and last number of every loaded table."""
    return A.union_flows(
        loaded_table(spark, d, t).groupBy(F.lit(t).alias("log_type"), "zone").agg(
            F.count(F.lit(1)).alias("row_count"), F.max("sn").alias("last_sn"))
        for t in FLOW_FIELDS)


@query("assign_sn", sql("""
    SELECT ord, zone, row_number() OVER (PARTITION BY zone ORDER BY ord) AS sn FROM fl WHERE log_type = 'death'""",
    "fl"))
def assign_sn(spark, d):
    deaths = flow_of(flow_events(spark, d, "death"), "death").select("ord", "zone")
    return numbering.assign_sn(deaths, order=["ord"], scope=["zone"])

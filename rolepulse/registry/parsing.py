"""Queries: raw lines rendered from events and parsed back; flow lines; row filters."""

from pyspark.sql import functions as F

from rolepulse.layouts import VALID_ZONES, table_type_column
from rolepulse.operators import rolestats as R
from rolepulse.registry.base import flow_events, flow_of, flow_text, query, raw_lines, sql
from rolepulse.sources import flowfiles, formatlog

_TYPES = {"roleid": "bigint", "level": "int", "online_time": "int", "taskid": "int", "profession": "int",
          "nation": "int", "time_used": "int", "attacker_id": "bigint", "attacker_level": "int", "scene_tag": "int"}


def rendered(spark, d, path=True):
    lines = raw_lines(flow_events(spark, d))
    at = F.concat(F.lit("/logs/"), "zone", F.lit("/"), "day", F.lit("/world2.formatlog"))
    return lines.select("value", "ord", *([at.alias("path")] if path else []))


def _parsed(spark, d, kind, *fields):
    rows = formatlog.parse(rendered(spark, d, path=False)).where(F.col("kind") == kind)
    cast = lambda c: F.col(c).try_cast(_TYPES[c]).alias(c) if c in _TYPES else F.col(c)
    return rows.select("ord", F.col("log_time").try_cast("timestamp_ntz").alias("log_time"), *[cast(c) for c in fields])


@query("parse_login", sql("""
    SELECT ord, log_time, roleid, level, 'login' AS loginout, 0 AS online_time FROM fl WHERE action = 'login'""", "fl"))
def parse_login(spark, d):
    return _parsed(spark, d, "login", "roleid", "level", "loginout", "online_time")


@query("parse_logout", sql("""
    SELECT ord, log_time, roleid, level, 'logout' AS loginout, online_time FROM fl WHERE action = 'logout'""", "fl"))
def parse_logout(spark, d):
    return _parsed(spark, d, "logout", "roleid", "level", "loginout", "online_time")


@query("parse_task", sql("""
    SELECT ord, log_time, action AS flow_type, roleid, level, task_id AS taskid FROM fl
    WHERE log_type = 'taskflow'""", "fl"))
def parse_task(spark, d):
    return _parsed(spark, d, "task", "flow_type", "roleid", "level", "taskid")


@query("parse_createrole", sql("""
    SELECT ord, log_time, roleid, profession, nation FROM fl WHERE log_type = 'createrole'""", "fl"))
def parse_createrole(spark, d):
    return _parsed(spark, d, "createrole", "roleid", "profession", "nation")


@query("parse_levelup", sql("""
    SELECT ord, log_time, roleid, level, usetime AS time_used, profession FROM fl WHERE log_type = 'levelup'""", "fl"))
def parse_levelup(spark, d):
    return _parsed(spark, d, "levelup", "roleid", "level", "time_used", "profession")


@query("parse_death", sql("""
    SELECT ord, log_time, roleid, level, killer AS attacker_id, killer_level AS attacker_level, scene AS scene_tag,
           CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS x, CAST(-CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS y,
           CAST(k AS VARCHAR) AS z FROM fl WHERE log_type = 'death'""", "fl"))
def parse_death(spark, d):
    return _parsed(spark, d, "death", "roleid", "level", "attacker_id", "attacker_level", "scene_tag", "x", "y", "z")


@query("classify_log", sql("""
    SELECT ord, CASE WHEN log_type <> 'award' THEN log_type END AS log_type FROM fl""", "fl"))
def classify_log(spark, d):
    return formatlog.classify(rendered(spark, d, path=False)).select("ord", "log_type")


@query("drop_unmatched", sql("SELECT ord, log_type FROM fl WHERE log_type <> 'award'", "fl"))
def drop_unmatched(spark, d):
    return formatlog.drop_unmatched(formatlog.classify(rendered(spark, d, path=False))).select("ord", "log_type")


@query("require_path_match", sql("""
    SELECT ord, zone, CAST(day AS VARCHAR) AS day, log_type FROM fl
    WHERE log_type <> 'award' AND zone <> '1005'""", "fl"))
def require_path_match(spark, d):
    """Zone 1005 lies in a folder without a day, so its records have nowhere to go."""
    lines = rendered(spark, d).withColumn("path", F.regexp_replace("path", r"/1005/[^/]+/", "/1005/undated/"))
    return formatlog.with_path_fields(formatlog.parse(lines)).select("ord", "zone", "day", "log_type")


@query("path_partitions", sql("SELECT ord, zone, CAST(day AS VARCHAR) AS day FROM fl", "fl"))
def path_partitions(spark, d):
    lines = rendered(spark, d)
    return lines.select("ord", formatlog.path_zone(F.col("path")).alias("zone"),
                        formatlog.path_day(F.col("path")).alias("day"))


_FLOW_LINE = """
    SELECT ord, strftime(log_time, '%Y-%m-%d %H:%M:%S') || ' ' || roleid || ' ' || CASE log_type
        WHEN 'roleloginlogout' THEN action || ' ' || level || ' ' || online_time
        WHEN 'taskflow' THEN level || ' ' || task_id || ' ' || action
        WHEN 'createrole' THEN profession || ' ' || nation
        WHEN 'levelup' THEN profession || ' ' || level || ' ' || usetime
        WHEN 'death' THEN level || ' ' || killer || ' ' || killer_level || ' ' || scene || ' ' || pos END AS line
    FROM fl WHERE log_type <> 'award'"""


@query("format_flow_line", sql(_FLOW_LINE, "fl"))
def format_flow_line(spark, d):
    parsed = formatlog.parse(rendered(spark, d, path=False))
    return parsed.select("ord", formatlog.flow_line(F.col("log_type")).alias("line"))


@query("format_line", sql("""
    SELECT ord, '(' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ',' ||
           CAST(-CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ',' || k || ')' AS line
    FROM fl WHERE log_type = 'death'""", "fl"))
def format_line(spark, d):
    deaths = formatlog.parse(rendered(spark, d, path=False)).where(F.col("log_type") == "death")
    return deaths.select("ord", F.format_string("(%s,%s,%s)", "x", "y", "z").alias("line"))


@query("split_flow_line", sql("""
    SELECT ord, roleid, level, task_id, action, 7 AS loose_fields, 6 AS spaced_fields
    FROM fl WHERE log_type = 'taskflow'""", "fl"))
def split_flow_line(spark, d):
    """A doubled space is one gap to the feature reader and an empty field to the loader."""
    text = flow_text(flow_of(flow_events(spark, d, "taskflow"), "taskflow"), "taskflow")
    text = text.withColumn("value", F.regexp_replace("value", " (?=a)", "  "))
    rows = flowfiles.typed(text.withColumn("line", F.col("value")), "taskflow")
    return rows.select(
        "ord", "roleid", "level", "task_id", "action",
        F.size(flowfiles.loader_fields(F.concat("line", F.lit("\n")))).alias("loose_fields"),
        F.size(flowfiles.feature_fields(F.concat("line", F.lit("\n")))).alias("spaced_fields"))


@query("merge_date_time", sql("SELECT ord, log_time FROM fl WHERE log_type = 'levelup'", "fl"))
def merge_date_time(spark, d):
    text = flow_text(flow_of(flow_events(spark, d, "levelup"), "levelup"), "levelup")
    return text.select("ord", flowfiles.merge_date_time(flowfiles.feature_fields(F.col("value"))).alias("log_time"))


@query("valid_zone", sql("SELECT ord, zone FROM fl WHERE zone IN ('1002', '1004')", "fl"))
def valid_zone(spark, d):
    """Zone 1005 is renamed to one outside the list first."""
    zones = F.when(F.col("zone") == "1005", "1009").otherwise(F.col("zone"))
    rows = flow_events(spark, d).select("ord", zones.alias("zone"))
    return rows.where(flowfiles.valid_zone(F.col("zone"), VALID_ZONES))


@query("rename_type", sql("""
    SELECT ord, CASE log_type WHEN 'taskflow' THEN 'task' ELSE log_type END AS table_type FROM fl""", "fl"))
def rename_type(spark, d):
    return flow_events(spark, d).select("ord", table_type_column(F.col("log_type")).alias("table_type"))


@query("logout_only", sql("SELECT ord, roleid, online_time FROM fl WHERE action = 'logout'", "fl"))
def logout_only(spark, d):
    return R.logout_only(flow_events(spark, d, "roleloginlogout")).select("ord", "roleid", "online_time")


@query("active_task_rows", sql("SELECT ord, roleid, task_id, action FROM fl WHERE log_type = 'taskflow'", "fl"))
def active_task_rows(spark, d):
    return R.task_rows(flow_events(spark, d, "taskflow")).select("ord", "roleid", "task_id", "action")


@query("task_action_lookup", sql("""
    SELECT ord, roleid, task_id FROM fl WHERE log_type = 'taskflow' AND action = 'accomplished'""", "fl"))
def task_action_lookup(spark, d):
    return R.task_rows(flow_events(spark, d, "taskflow"), "accomplished").select("ord", "roleid", "task_id")


@query("project_columns", sql("SELECT roleid, level FROM fl WHERE log_type = 'levelup'", "fl"))
def project_columns(spark, d):
    return flow_of(flow_events(spark, d, "levelup"), "levelup").select("roleid", "level")

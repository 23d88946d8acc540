"""Queries: aggregations per role and over roles, sorts, unions."""

from pyspark.sql import functions as F

from rolepulse.layouts import REPLAY_ORDER
from rolepulse.operators import rolestats as R
from rolepulse.operators.joins import death_sides
from rolepulse.operators.tableops import first_by, last_by, sorted_rows
from rolepulse.plans import activity as A
from rolepulse.registry.base import AS_OF, cohort_of, flow_events, flow_lake, flow_of, query, sql
from rolepulse.sources.tables import read_flow_lake


def cohort_stat(spark, d, stat, log_type):
    """A per-role statistic over the in-range rows of one flow."""
    cohort = cohort_of(spark, d)
    return R.for_cohort(stat, A.activity_range(flow_events(spark, d, log_type), AS_OF, cohort), cohort.roles)


@query("task_count", sql(
    "SELECT roleid, count(*) AS taskid_sum FROM cact WHERE kind = 'taskflow' GROUP BY roleid", "cact"))
def task_count(spark, d):
    return cohort_stat(spark, d, lambda rows: R.task_count(R.task_rows(rows)), "taskflow")


@query("online_time_sum", sql("""
    SELECT roleid, CAST(sum(online_time) AS BIGINT) AS online_sum FROM cact
    WHERE kind = 'roleloginlogout' GROUP BY roleid""", "cact"))
def online_time_sum(spark, d):
    return cohort_stat(spark, d, R.online_time_sum, "roleloginlogout")


def _kills(spark, d):
    cohort = cohort_of(spark, d)
    sides = death_sides(A.activity_range(flow_events(spark, d, "death"), AS_OF, cohort))
    return R.for_cohort(R.kill_counts, sides, cohort.roles)


@query("killed_count", sql("""
    SELECT roleid, count(*) FILTER (WHERE kind = 'killed') AS killed_times FROM cact
    WHERE kind IN ('killed', 'killer') GROUP BY roleid""", "cact"))
def killed_count(spark, d):
    return _kills(spark, d).select("roleid", "killed_times")


@query("killer_count", sql("""
    SELECT roleid, count(*) FILTER (WHERE kind = 'killer') AS killer_num FROM cact
    WHERE kind IN ('killed', 'killer') GROUP BY roleid""", "cact"))
def killer_count(spark, d):
    return _kills(spark, d).select("roleid", "killer_num")


@query("max_level_per_role", sql(
    "SELECT roleid, max(level) AS max_level FROM fl WHERE log_type = 'levelup' GROUP BY roleid", "fl"))
def max_level_per_role(spark, d):
    return R.max_level_per_role(flow_of(flow_events(spark, d, "levelup"), "levelup"))


@query("distinct_rows", sql("""
    SELECT DISTINCT roleid, profession, log_time FROM fl WHERE log_type = 'createrole'""", "fl"))
def distinct_rows(spark, d):
    created = flow_of(flow_events(spark, d, "createrole"), "createrole")
    return created.select("roleid", F.col("profession").cast("int").alias("profession"), "log_time").distinct()


@query("flow_counts", sql("SELECT count(DISTINCT roleid) AS active_roles FROM cact", "cact"))
def flow_counts(spark, d):
    return A.role_activity(flow_events(spark, d, *REPLAY_ORDER), AS_OF, cohort=cohort_of(spark, d)).agg(F.count(F.lit(1)).alias("active_roles"))


@query("order_by_two", sql("SELECT roleid, level FROM fl WHERE log_type = 'levelup' ORDER BY roleid, level", "fl"))
def order_by_two(spark, d):
    ups = flow_of(flow_events(spark, d, "levelup"), "levelup")
    return sorted_rows(ups.select("roleid", "level", "ord"), ["roleid", "level"], "ord").drop("ord")


_ENDS = """
    SELECT roleid, zone, profession, nation, log_time, ord FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY log_time {0}, ord {0}) AS r FROM fl
      WHERE log_type = 'createrole') WHERE r = 1"""


def _ends(spark, d, pick):
    created = flow_of(flow_events(spark, d, "createrole"), "createrole").select(
        "roleid", "zone", F.col("profession").cast("int").alias("profession"),
        F.col("nation").cast("int").alias("nation"), "log_time", "ord")
    return pick(created, ["roleid"], ["log_time", "ord"])


@query("latest_row", sql(_ENDS.format("DESC"), "fl"))
def latest_row(spark, d):
    return _ends(spark, d, last_by)


@query("earliest_row", sql(_ENDS.format("ASC"), "fl"))
def earliest_row(spark, d):
    return _ends(spark, d, first_by)


@query("union_flows", sql("""
    SELECT log_type, roleid, log_time, level, profession, nation, action, online_time, task_id, usetime, killer,
           killer_level, scene, pos, award FROM fl""", "fl"))
def union_flows(spark, d):
    """One scan of the table of all types, its folders pruned by type."""
    types = ("createrole", "roleloginlogout", "taskflow", "levelup", "death", "award")
    return read_flow_lake(spark, flow_lake(spark, d), types).select(
        "log_type", "roleid", "log_time", "level", F.col("profession").cast("int").alias("profession"),
        F.col("nation").cast("int").alias("nation"), "action", "online_time", "task_id", "usetime", "killer",
        "killer_level", "scene", "pos", "award")

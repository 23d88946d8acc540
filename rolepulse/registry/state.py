"""Queries over per-role state: aggregates in event order, replay, and their parts."""

from pyspark.sql import functions as F

from rolepulse.functions.text import position_parts
from rolepulse.layouts import REPLAY_ORDER
from rolepulse.operators import rolestats as R
from rolepulse.plans import activity as A
from rolepulse.registry.base import AS_OF, START, cohort_of, flow_events, query, sql


def _state(spark, d, replay, cohort=None):
    events = flow_events(spark, d, *REPLAY_ORDER)
    return A.role_activity(events, AS_OF, replay, cohort=cohort or cohort_of(spark, d))


STATE = ("roleid, day, log_time, ts, taskid_sum, inst_sum, online_sum, day_act, killed_times, killer_num, "
         "diamond_revive_num, near_levelup_time, last_gift_id, local_level, local_levelup_time, last_up_time, "
         "logout_scene, logout_x, logout_y, logout_z")


@query("role_activity", sql(f"SELECT {STATE} FROM clean", "clean"))
def role_activity(spark, d):
    return _state(spark, d, False)


@query("role_activity_replay", sql(f"SELECT {STATE} FROM replayed", "replayed"))
def role_activity_replay(spark, d):
    return _state(spark, d, True)


# Creations before this day are left out: activity then exists before the cohort day.
LATE = "2024-01-11"


@query("role_activity_late_cohort",
       sql(f"SELECT {STATE} FROM replayed", "replayed").replace(f"DATE '{START}'", f"DATE '{LATE}'"))
def role_activity_late_cohort(spark, d):
    created = flow_events(spark, d, "createrole").where(F.col("day") >= LATE)
    return _state(spark, d, True, A.stored_cohort(created, AS_OF))


@query("role_activity_shuffled_cohort", sql(f"SELECT {STATE} FROM replayed", "replayed"))
def role_activity_shuffled_cohort(spark, d):
    """The route a cohort too large to broadcast takes."""
    return A.role_activity(
        flow_events(spark, d, *REPLAY_ORDER), AS_OF, replay=True, max_rows=0, cohort=cohort_of(spark, d))


@query("level_record", sql("""
    SELECT roleid, level AS local_level, usetime AS levelup_times FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY ord DESC) AS r FROM (
        SELECT *, max(level) OVER (PARTITION BY roleid ORDER BY ord
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pk
        FROM cact WHERE kind = 'levelup') WHERE pk IS NULL OR level > pk) WHERE r = 1""", "cact"))
def level_record(spark, d):
    cohort = cohort_of(spark, d)
    ups = A.activity_range(flow_events(spark, d, "levelup"), AS_OF, cohort)
    return R.for_cohort(R.level_record, ups, cohort.roles)


@query("levelup_pace", sql("""
    SELECT c.roleid, c.near_levelup_time, c.local_levelup_time, c.last_up_time FROM clean c""", "clean"))
def levelup_pace(spark, d):
    return _state(spark, d, False).select("roleid", "near_levelup_time", "local_levelup_time", "last_up_time")


@query("levelup_pace_replay", sql("""
    SELECT roleid, near AS near_levelup_time, pace AS local_levelup_time, prev AS last_up_time FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY nth DESC) AS r FROM steps) WHERE r = 1""", "steps"))
def levelup_pace_replay(spark, d):
    return _state(spark, d, True).select("roleid", "near_levelup_time", "local_levelup_time", "last_up_time")


@query("last_gift", sql("""
    SELECT roleid, award AS last_gift_id FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY ts DESC, ord) AS r FROM cact WHERE kind = 'award')
    WHERE r = 1""", "cact"))
def last_gift(spark, d):
    cohort = cohort_of(spark, d)
    awards = A.activity_range(flow_events(spark, d, "award"), AS_OF, cohort)
    return R.for_cohort(R.last_gift, awards, cohort.roles)


@query("last_gift_replay", sql("""
    SELECT roleid, gift AS last_gift_id FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY nth DESC) AS r FROM steps) WHERE r = 1""", "steps"))
def last_gift_replay(spark, d):
    return _state(spark, d, True).select("roleid", "last_gift_id")


@query("award_level_floor", sql("""
    SELECT roleid, local_level FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY nth DESC) AS r FROM steps) WHERE r = 1""", "steps"))
def award_level_floor(spark, d):
    return _state(spark, d, True).select("roleid", "local_level")


@query("last_death_place", sql("""
    SELECT roleid, scene AS logout_scene, CAST(trunc(value) AS INTEGER) AS logout_x,
           CAST(trunc(-value) AS INTEGER) AS logout_y, k AS logout_z FROM (
      SELECT *, row_number() OVER (PARTITION BY roleid ORDER BY day DESC, ord DESC) AS r FROM cact
      WHERE kind = 'killed') WHERE r = 1""", "cact"))
def last_death_place(spark, d):
    cohort = cohort_of(spark, d)
    deaths = A.activity_range(flow_events(spark, d, "death"), AS_OF, cohort)
    deaths = deaths.withColumn("xyz", position_parts(F.col("pos")))
    return R.for_cohort(R.last_death_place, deaths, cohort.roles)


@query("logout_level", sql("""
    SELECT roleid, max(level) AS known_level FROM cact
    WHERE kind IN ('levelup', 'roleloginlogout') GROUP BY roleid""", "cact"))
def logout_level(spark, d):
    cohort = cohort_of(spark, d)
    events = flow_events(spark, d, "levelup", "roleloginlogout")
    return R.for_cohort(R.logout_level, A.handled(A.activity_range(events, AS_OF, cohort)), cohort.roles)


@query("last_activity", sql("""
    SELECT roleid, CAST(max(log_time) AS DATE) AS day, strftime(max(log_time), '%H:%M:%S') AS log_time, max(ts) AS ts
    FROM cact GROUP BY roleid""", "cact"))
def last_activity(spark, d):
    cohort = cohort_of(spark, d)
    events = flow_events(spark, d, *REPLAY_ORDER)
    return R.for_cohort(R.last_activity, A.handled(A.activity_range(events, AS_OF, cohort)), cohort.roles)

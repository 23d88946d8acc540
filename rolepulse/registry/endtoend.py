"""Query: the whole way from growing raw logs to the lost rate."""

from pyspark.sql import functions as F

from rolepulse import jobs
from rolepulse.layouts import VALID_ZONES
from rolepulse.plans import activity as A
from rolepulse.plans import churn as C
from rolepulse.registry.base import AS_OF, grow, query, sql
from rolepulse.session import work_path
from rolepulse.sources.tables import read_flow_events
from rolepulse.streaming import ingest

# The raw log tells of no awards.
_TYPES = ("createrole", "roleloginlogout", "taskflow", "levelup", "death")
_SQL = sql("""
    SELECT round(avg(CAST(is_lost AS INTEGER)), 6) AS lost_rate, count(*) AS active_roles,
           (SELECT count(*) FROM cohort) AS cohort_roles,
           CAST(sum(local_level) AS BIGINT) AS levels, CAST(sum(near_levelup_time) AS BIGINT) AS paces, CAST(sum(online_sum) AS BIGINT) AS online
    FROM labels_replayed""", "labels_replayed", "cohort").replace("FROM ev)", "FROM ev WHERE log_type <> 'award')", 1)


@query("raw_logs_to_lost_rate", _SQL)
def raw_logs_to_lost_rate(spark, d):
    """Two runs of the ingest and of the load, between them the raw logs grow; then the replay over the tables."""
    root = work_path(spark, "end-to-end")
    for turn in range(2):
        grow(spark, d, f"{root}/raw", turn)
        ingest.run_once(spark, f"{root}/raw", f"{root}/flows", f"{root}/checkpoint", zones=VALID_ZONES, growing=True)
    jobs.load_job(spark, f"{root}/flows", f"{root}/tables")
    created = read_flow_events(spark, f"{root}/tables", ("createrole",))
    cohort = A.stored_cohort(created, AS_OF)
    roles = A.role_activity(read_flow_events(spark, f"{root}/tables", _TYPES[1:]), AS_OF, replay=True, cohort=cohort)
    labelled = C.churn_label(roles, C.global_max(roles, cohort.first_day()))
    sums = labelled.agg(*[F.sum(c).cast("long").alias(n) for c, n in (
        ("local_level", "levels"), ("near_levelup_time", "paces"), ("online_sum", "online"))])
    return C.lost_rate(labelled, cohort.roles).withColumn("lost_rate", F.round("lost_rate", 6)).crossJoin(F.broadcast(sums))

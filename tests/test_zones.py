"""Per-zone results against the plans for one population, run on each zone alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rolepulse.plans import activity as A
from rolepulse.plans import churn as C
from rolepulse.plans import zones as Z
from tests.test_state import AS_OF, events_of, make_rows


@pytest.fixture(scope="module")
def events(spark):
    """The same role ids in three zones: one opens later, one has role creations but no activity, one no creations."""
    early = events_of(spark, make_rows(21, 9, 12, hot=60))
    late = events_of(spark, make_rows(22, 7, 12)).withColumn("zone", F.lit("1004")).withColumn("day", F.col("day") + F.expr("interval 6 days").cast("interval day"))
    late = late.withColumn("day", F.col("day").cast("date")).withColumn("log_time", F.col("log_time") + F.expr("interval 6 days"))
    idle = early.where("log_type = 'createrole'").withColumn("zone", F.lit("1005"))
    closed = early.where("log_type <> 'createrole'").withColumn("zone", F.lit("1009"))
    return early.unionByName(late).unionByName(idle).unionByName(closed).cache()


@pytest.mark.parametrize("replay", [False, True])
@pytest.mark.parametrize("max_rows", [0, 1000])
def test_zones_equal_runs_on_each_zone_alone(spark, events, replay, max_rows):
    cohorts = Z.zone_cohorts(events, AS_OF)
    roles = Z.role_activity_by_zone(events, AS_OF, replay, max_rows=max_rows, cohorts=cohorts).cache()
    top = Z.zone_max(roles, cohorts.days)
    scored = Z.zone_score(roles, top, max_rows=max_rows)
    rates = {r["zone"]: tuple(r)[1:] for r in Z.zone_lost_rate(scored, cohorts).collect()}
    days = {r["zone"]: r["day"] for r in cohorts.days.collect()}
    assert days == {"1002": dt.date(2016, 11, 1), "1004": dt.date(2016, 11, 7), "1005": dt.date(2016, 11, 1)}
    assert set(rates) == set(days)
    for zone in days:
        own = events.where(F.col("zone") == zone)
        cohort = A.stored_cohort(own, AS_OF)
        alone = A.role_activity(own, AS_OF, replay, cohort=cohort)
        assert sorted(map(tuple, roles.where(F.col("zone") == zone).drop("zone").collect())) == sorted(map(tuple, alone.collect()))
        highest = C.global_max(alone, cohort.first_day())
        mine = top.where(F.col("zone") == zone).drop("zone")
        if alone.count():
            assert mine.collect() == highest.select(mine.columns).collect()
        want = C.score(alone, highest)
        got = scored.where(F.col("zone") == zone).drop("zone")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert rates[zone] == tuple(C.lost_rate(want, cohort.roles).first())
    assert rates["1005"][0] is None and rates["1002"][0] != rates["1004"][0]
    both = roles.groupBy("roleid").agg(F.countDistinct("zone").alias("n")).where("n > 1").count()
    assert both > 3


def test_no_events_no_zones(spark, events):
    nothing = events.where("false")
    cohorts = Z.zone_cohorts(nothing, AS_OF)
    roles = Z.role_activity_by_zone(nothing, AS_OF, cohorts=cohorts)
    assert roles.count() == 0 and Z.zone_max(roles, cohorts.days).count() == 0


def test_zones_are_joined_not_crossed(spark, events):
    cohorts = Z.zone_cohorts(events, AS_OF)
    roles = Z.role_activity_by_zone(events, AS_OF, cohorts=cohorts)
    plan = Z.zone_score(roles, Z.zone_max(roles, cohorts.days))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan

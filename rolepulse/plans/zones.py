"""Results per zone: every zone has its own cohort day, cohort, maximum and lost rate.

A zone is a server of its own: one role id may live in several of them. So a role is the
pair (zone, role id) here, and the plans for one population run on that pair as their key. What one
row says for a whole population is a row per zone, joined by zone; it is broadcast after a check of
the number of zones.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.functions.text import safe_ratio
from rolepulse.functions.times import to_epoch
from rolepulse.layouts import LOST_DAY
from rolepulse.operators.joins import BROADCAST_ROWS, fits_broadcast
from rolepulse.plans import activity as A
from rolepulse.plans.churn import encoded, is_lost, select_features
from rolepulse.session import materialise

KEY = ("zone", "roleid")


@dataclass(frozen=True)
class ZoneCohorts:
    """``days``: zone and its cohort day. ``roles``: zone, roleid and creation of the roles of that day."""

    days: DataFrame
    roles: DataFrame


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def zone_cohorts(events: DataFrame, as_of: str | dt.date) -> ZoneCohorts:
    """The cohort of each zone, from one pass over the role creations."""
    created = A.in_range(events.where(F.col("log_type") == "createrole"), as_of)
    table = materialise(A.last_creation(created, "zone", "day", "roleid"), "zone-cohorts")
    days = table.groupBy("zone").agg(F.min("day").alias("day"))
    return ZoneCohorts(days, table.join(small(days), ["zone", "day"]).drop("day"))


def zone_range(events: DataFrame, as_of: str | dt.date, cohorts: ZoneCohorts) -> DataFrame:
    """Events of each zone from its cohort day to the end of the range; none of zones without one."""
    first = small(cohorts.days.withColumnRenamed("day", "_first"))
    return A.in_range(events, as_of).join(first, "zone").where(F.col("day") >= F.col("_first")).drop("_first")


def role_activity_by_zone(events: DataFrame, as_of: str | dt.date, replay: bool = False, clock: str = "UTC",
                          max_rows: int = BROADCAST_ROWS, cohorts: ZoneCohorts | None = None) -> DataFrame:
    """State of every active cohort role of every zone: zone, roleid and the columns of the role state.

    A killer is a role of the zone whose log tells of the death.
    """
    cohorts = cohorts or zone_cohorts(events, as_of)
    of_zone = lambda role: F.when(F.col(role).isNotNull(), F.struct("zone", F.col(role).alias("roleid")))
    rows = zone_range(events, as_of, cohorts).withColumns({"roleid": of_zone("roleid"), "killer": of_zone("killer")})
    keys = cohorts.roles.select(of_zone("roleid").alias("roleid"))
    days = A.cohort_role_days(rows, keys, clock, max_rows)
    state = A.replay_state(days, clock) if replay else A.event_time_state(days, clock)
    return state.select("roleid.zone", F.col("roleid.roleid").alias("roleid"), *[c for c in state.columns if c != "roleid"])


def zone_max(roles: DataFrame, days: DataFrame, clock: str = "UTC") -> DataFrame:
    """zone, the largest value of each feature in it, and its newest time, at least the midnight of its cohort day."""
    names = select_features(roles)
    top = roles.groupBy("zone").agg(*[F.max(n).alias(n) for n in names], F.max("ts").alias("ts"))
    floor = to_epoch(F.col("day").cast("timestamp_ntz"), clock)
    return days.join(top, "zone", "left").select(
        "zone", *[F.coalesce(n, F.lit(0)).alias(n) for n in names], F.greatest("ts", floor).alias("ts"))


def zone_score(roles: DataFrame, top: DataFrame, lost_day: int = LOST_DAY, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """zone, roleid, is_lost, label and every feature divided by the maximum of its zone."""
    names = select_features(roles)
    highest = small(top.select("zone", *[F.col(n).alias(f"max_{n}") for n in ("ts", *names)]), max_rows)
    lost = is_lost(lost_day)
    return roles.select(*KEY, "ts", *names).join(highest, "zone").select(
        *KEY, lost.alias("is_lost"), encoded(lost).alias("label"), *[safe_ratio(F.col(n), F.col(f"max_{n}")).alias(n) for n in names])


def zone_lost_rate(scored: DataFrame, cohorts: ZoneCohorts) -> DataFrame:
    """zone, share of lost roles among its active ones (NULL if none), active roles, cohort size."""
    active = scored.groupBy("zone").agg(
        F.avg(F.col("is_lost").cast("int")).alias("lost_rate"), F.count(F.lit(1)).alias("active_roles"))
    sizes = cohorts.roles.groupBy("zone").agg(F.count(F.lit(1)).alias("cohort_roles"))
    return sizes.join(active, "zone", "left").select(
        "zone", "lost_rate", F.coalesce("active_roles", F.lit(0)).alias("active_roles"), "cohort_roles")

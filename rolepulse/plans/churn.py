"""Population maximum, churn label, normalised features and their statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from rolepulse.functions.text import safe_ratio
from rolepulse.functions.times import DAY_SECONDS, to_epoch
from rolepulse.layouts import LOST_DAY, MODEL_FEATURES
from rolepulse.plans.activity import Cohort, role_activity, stored_cohort

IGNORED_PREFIXES = ("last_", "local_", "logout_")
IGNORED_NAMES = ("ts", "roleid")


def select_features(roles: DataFrame) -> list[str]:
    """Integer counters of the role state, in the fixed model order."""
    whole = (ByteType, ShortType, IntegerType, LongType)
    names = [
        f.name for f in roles.schema.fields
        if isinstance(f.dataType, whole) and f.name not in IGNORED_NAMES and not f.name.startswith(IGNORED_PREFIXES)
    ]
    known = [n for n in MODEL_FEATURES if n in names]
    return known + sorted(n for n in names if n not in known)


def global_max(roles: DataFrame, first_day: DataFrame, zone: str = "UTC") -> DataFrame:
    """One row: the largest value of each feature, and the newest time (at least the first day's midnight)."""
    floor = to_epoch(F.col("day").cast("timestamp_ntz"), zone)
    names = select_features(roles)
    top = roles.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names], F.max("ts").alias("ts"))
    return top.crossJoin(F.broadcast(first_day)).select(*names, F.greatest("ts", floor).alias("ts"))


def with_top(roles: DataFrame, top: DataFrame, *names: str) -> DataFrame:
    """Every role beside ``max_<name>`` columns of the one-row maximum."""
    return roles.crossJoin(F.broadcast(top.select(*[F.col(n).alias(f"max_{n}") for n in names])))


def is_lost(lost_day: int = LOST_DAY) -> Column:
    """Whether the newest time of all is more than ``lost_day`` days past the role's own."""
    return F.col("max_ts") - F.col("ts") > DAY_SECONDS * lost_day


def churn_label(roles: DataFrame, top: DataFrame, lost_day: int = LOST_DAY) -> DataFrame:
    """Add ``max_ts`` and ``is_lost``."""
    return with_top(roles, top, "ts").withColumn("is_lost", is_lost(lost_day))


def encoded(lost: Column, signed: bool = False) -> Column:
    """1 for lost and 0 otherwise, or -1 for lost and 1 otherwise when ``signed``."""
    return F.when(lost, -1.0).otherwise(1.0) if signed else lost.cast("double")


def label_encode(labelled: DataFrame, signed: bool = False, name: str = "label") -> DataFrame:
    return labelled.withColumn(name, encoded(F.col("is_lost"), signed))


def score(roles: DataFrame, top: DataFrame, lost_day: int = LOST_DAY) -> DataFrame:
    """roleid, is_lost, label and every feature divided by its maximum (0.0 where that is 0)."""
    names = select_features(roles)
    lost = is_lost(lost_day)
    return with_top(roles.select("roleid", "ts", *names), top, "ts", *names).select(
        "roleid", lost.alias("is_lost"), encoded(lost).alias("label"),
        *[safe_ratio(F.col(n), F.col(f"max_{n}")).alias(n) for n in names])


def labelled_features(events: DataFrame, as_of: str | dt.date, replay: bool = False, zone: str = "UTC",
                      lost_day: int = LOST_DAY, cohort: Cohort | None = None) -> DataFrame:
    """Label and normalised features of every active cohort role, straight from the events."""
    cohort = cohort or stored_cohort(events, as_of)
    roles = role_activity(events, as_of, replay, zone, cohort=cohort)
    return score(roles, global_max(roles, cohort.first_day(), zone), lost_day)


def lost_rate(labelled: DataFrame, cohort: DataFrame) -> DataFrame:
    """One row: share of lost roles among active ones (NULL if none), active roles, cohort size."""
    active = labelled.agg(
        F.avg(F.col("is_lost").cast("int")).alias("lost_rate"), F.count(F.lit(1)).alias("active_roles"))
    return active.crossJoin(F.broadcast(cohort.agg(F.count(F.lit(1)).alias("cohort_roles"))))


def class_feature_stats(features: DataFrame, names: list[str]) -> DataFrame:
    """Mean and population deviation of each feature for lost and other roles; one pass, one row per feature."""
    aggs = []
    for n in names:
        for side, keep in (("lost", F.col("is_lost")), ("unlost", ~F.col("is_lost"))):
            aggs += [F.avg(F.when(keep, F.col(n))).alias(f"{n}_{side}_mean"),
                     F.stddev_pop(F.when(keep, F.col(n))).alias(f"{n}_{side}_std")]
    one = features.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(n).alias("feature"), *[
            F.col(f"{n}_{side}_{stat}").alias(f"{side}_{stat}") for side in ("lost", "unlost") for stat in ("mean", "std")
        ]) for n in names
    ])
    return one.select(F.inline(rows))

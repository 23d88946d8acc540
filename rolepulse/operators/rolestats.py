"""Single features per role, each one or two hash aggregates.

Where an order decides, rows are first combined on a finer key (day, level or
second). Every step has a map-side part, so a role with very many rows is
already small when it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.functions.times import clock_time, to_epoch
from rolepulse.operators.joins import BROADCAST_ROWS, fits_broadcast


def for_cohort(
    stat: Callable[[DataFrame], DataFrame], rows: DataFrame, cohort: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """A per-role statistic for cohort roles only.

    A cohort of checked small size is broadcast and cuts the rows first. Joining a
    larger one first would send all rows of a hot role to one task, so then the
    statistic, which combines rows before shuffling them, comes before the join.
    """
    keys = cohort.select("roleid")
    if fits_broadcast(keys, max_rows):
        return stat(rows.join(F.broadcast(keys), "roleid", "left_semi"))
    return stat(rows).join(keys, "roleid", "left_semi")


def logout_only(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("action") == "logout")


def task_rows(tasks: DataFrame, action: str | None = None) -> DataFrame:
    """Task rows that count: all of them, or those of one action."""
    return tasks if action is None else tasks.where(F.col("action") == action)


def task_count(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("roleid").agg(F.count(F.lit(1)).alias("taskid_sum"))


def online_time_sum(sessions: DataFrame) -> DataFrame:
    return logout_only(sessions).groupBy("roleid").agg(F.sum("online_time").cast("bigint").alias("online_sum"))


def kill_counts(sides: DataFrame) -> DataFrame:
    """killed_times and killer_num per role from two-sided deaths, in one aggregate."""
    return sides.groupBy("roleid").agg(
        F.count_if(F.col("side") == "killed").alias("killed_times"),
        F.count_if(F.col("side") == "killer").alias("killer_num"),
    )


def last_activity(touched: DataFrame, zone: str = "UTC") -> DataFrame:
    last = F.max("log_time").alias("last")
    return touched.groupBy("roleid").agg(last).select(
        "roleid", F.col("last").cast("date").alias("day"), clock_time(F.col("last")).alias("log_time"),
        to_epoch(F.col("last"), zone).alias("ts"),
    )


def max_level_per_role(levelups: DataFrame) -> DataFrame:
    return levelups.groupBy("roleid").agg(F.max("level").alias("max_level"))


def level_record(levelups: DataFrame) -> DataFrame:
    """Highest level and the use time of the row that first reached it."""
    firsts = levelups.groupBy("roleid", "level").agg(F.min_by("usetime", "ord").alias("usetime"))
    return firsts.groupBy("roleid").agg(
        F.max("level").alias("local_level"), F.max_by("usetime", "level").alias("levelup_times"))


def last_gift(awards: DataFrame) -> DataFrame:
    """Award of the newest time; of several in that second, the first line."""
    per_second = awards.groupBy("roleid", "log_time").agg(F.min_by("award", "ord").alias("award"))
    return per_second.groupBy("roleid").agg(F.max_by("award", "log_time").alias("last_gift_id"))


def last_death_place(deaths: DataFrame) -> DataFrame:
    """Scene and position of a victim's last death by day and line."""
    parts = {"scene": F.col("scene"), "x": F.col("xyz.x"), "y": F.col("xyz.y"), "z": F.col("xyz.z")}
    per_day = deaths.groupBy("roleid", "day").agg(*[F.max_by(c, "ord").alias(n) for n, c in parts.items()])
    return per_day.groupBy("roleid").agg(*[F.max_by(n, "day").alias(f"logout_{n}") for n in parts])


def logout_level(touched: DataFrame) -> DataFrame:
    """Best level known from level-ups or logouts."""
    rows = touched.where(F.col("kind").isin("levelup", "roleloginlogout"))
    return rows.groupBy("roleid").agg(F.max("level").alias("known_level"))

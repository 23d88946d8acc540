"""Activity per role.

Events are first combined per (role, day, kind, small sub-key). That step is a
plain hash aggregate with a map-side part, so however many rows one role has, a
task sends at most one row per combination. Everything ordered is then settled
per role on those combined rows, whose number is bounded by the days, levels and
clock seconds of the range and not by the event volume.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolepulse.functions.text import position_parts
from rolepulse.functions.times import clock_time, epoch_clock, to_epoch
from rolepulse.layouts import RANGE_END, RANGE_START, REPLAY_ORDER
from rolepulse.operators.joins import BROADCAST_ROWS, fits_broadcast
from rolepulse.session import materialise
from rolepulse.sources.flowfiles import as_date


def union_flows(flows: Iterable[DataFrame]) -> DataFrame:
    """Flows of different types as one event table; columns a type lacks are NULL."""
    out = None
    for flow in flows:
        out = flow if out is None else out.unionByName(flow, allowMissingColumns=True)
    return out


def in_range(events: DataFrame, as_of: str | dt.date, start: int = RANGE_START, end: int = RANGE_END) -> DataFrame:
    base = as_date(as_of)
    return events.where(F.col("day").between(
        F.lit(base + dt.timedelta(days=start)), F.lit(base + dt.timedelta(days=end))))


def cohort_day(events: DataFrame, as_of: str | dt.date) -> DataFrame:
    """One row ``day``: the first in-range day with a created role (NULL if none)."""
    return in_range(events.where(F.col("log_type") == "createrole"), as_of).agg(F.min("day").alias("day"))


def read_cohort(events: DataFrame, as_of: str | dt.date) -> DataFrame:
    """Roles created on the cohort day; of several lines for a role the last wins."""
    # The range repeats what the subquery implies, so that it reaches the scan.
    created = in_range(events.where(F.col("log_type") == "createrole"), as_of).where(
        F.col("day") == cohort_day(events, as_of).scalar())
    return last_creation(created, "roleid")


def last_creation(created: DataFrame, *keys: str) -> DataFrame:
    last = lambda c: F.max_by(c, "ord").alias(c)
    return created.groupBy(*keys).agg(
        F.max_by("log_time", "ord").alias("create_time"), last("profession"), last("nation"))


@dataclass(frozen=True)
class Cohort:
    """The stored roles of the cohort day, and that day (None without a created role)."""

    roles: DataFrame
    day: dt.date | None

    def first_day(self) -> DataFrame:
        """One row ``day``."""
        return self.roles.sparkSession.range(1).select(F.lit(self.day).cast("date").alias("day"))


def stored_cohort(events: DataFrame, as_of: str | dt.date) -> Cohort:
    """The cohort from one pass over the role creations.

    The last creation of each role and day is written as a table; its day, size and
    members are then read from there. One date returns to the driver.
    """
    created = in_range(events.where(F.col("log_type") == "createrole"), as_of)
    table = materialise(last_creation(created, "day", "roleid"), "cohort")
    day = table.agg(F.min("day")).first()[0]
    return Cohort(table.where(F.col("day") == F.lit(day).cast("date")).drop("day"), day)


def activity_range(events: DataFrame, as_of: str | dt.date, cohort: Cohort) -> DataFrame:
    """Events from the cohort day to the end of the range; none without a cohort day."""
    if cohort.day is None:
        return events.where(F.lit(False))
    return in_range(events, as_of, start=(cohort.day - as_date(as_of)).days)


def handled(events: DataFrame) -> DataFrame:
    """Rows that say something about a role: one per touched role, deaths giving two.

    ``login`` rows, role creation and unhandled types are not activity.
    """
    logout = (F.col("log_type") != "roleloginlogout") | (F.col("action") == "logout")
    rows = events.where(F.col("log_type").isin(list(REPLAY_ORDER)) & logout)
    own = F.struct(F.col("log_type").alias("kind"), F.col("roleid").alias("role"))
    sides = F.when(
        F.col("log_type") == "death",
        F.array(
            F.struct(F.lit("killed").alias("kind"), F.col("roleid").alias("role")),
            F.struct(F.lit("killer").alias("kind"), F.col("killer").alias("role")),
        ),
    ).otherwise(F.array(own))
    return rows.select(
        F.inline(sides), "day", "ord", "log_time", "level", "usetime", "award", "online_time", "scene", "pos",
    ).withColumnRenamed("role", "roleid")


def role_day_parts(touched: DataFrame, zone: str = "UTC") -> DataFrame:
    """Combine touched rows per (role, day, kind, sub).

    ``sub`` is the level of a levelup row (only the first row of a level can raise
    the role on that day) and the second of an award row; otherwise NULL.
    """
    kind = F.col("kind")
    victim = kind == "killed"
    xyz = position_parts(F.when(victim, F.col("pos")))
    rows = touched.select(
        "roleid", "day", "kind", "ord", "level", "usetime", "award", "online_time", "scene",
        to_epoch(F.col("log_time"), zone).alias("ts"),
        xyz.alias("xyz"),
    ).withColumn("sub", F.when(kind == "levelup", F.col("level").cast("bigint")).when(kind == "award", F.col("ts")))
    latest = lambda c, name: F.max_by(c, "ord").alias(name)
    earliest = lambda c, name: F.min_by(c, "ord").alias(name)
    return rows.groupBy("roleid", "day", "kind", "sub").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("ts_min"), F.max("ts").alias("ts_max"),
        F.sum("online_time").alias("online"),
        F.min("ord").alias("first_ord"), earliest("ts", "first_ts"),
        earliest("usetime", "usetime"), earliest("award", "award"), F.min("level").alias("level_min"),
        latest("scene", "scene"), latest(F.col("xyz.x"), "x"), latest(F.col("xyz.y"), "y"), latest(F.col("xyz.z"), "z"),
    )


def role_days(parts: DataFrame) -> DataFrame:
    """One row per role and day, its level-ups as a list in line order.

    The list holds one entry per distinct level reached that day.
    """
    kind = F.col("kind")
    of = lambda k, c: F.when(kind == k, F.col(c))
    award_ts = of("award", "sub")
    late = kind.isin("killed", "killer", "roleloginlogout")
    return parts.groupBy("roleid", "day").agg(
        F.coalesce(F.sum(of("taskflow", "n")), F.lit(0)).alias("tasks"),
        F.coalesce(F.sum(of("roleloginlogout", "online")), F.lit(0)).alias("online"),
        F.coalesce(F.sum(of("killed", "n")), F.lit(0)).alias("killed"),
        F.coalesce(F.sum(of("killer", "n")), F.lit(0)).alias("kills"),
        F.min("ts_min").alias("any_first_ts"), F.max("ts_max").alias("any_ts"),
        F.max(of("taskflow", "ts_max")).alias("task_ts"),
        F.max(F.when(late, F.col("ts_max"))).alias("late_ts"),
        F.max(award_ts).alias("award_ts"),
        F.max_by("award", award_ts).alias("award_id"),
        F.max_by("first_ord", award_ts).alias("award_ord"),
        F.min(of("award", "first_ord")).alias("award_first_ord"),
        F.min(of("award", "level_min")).alias("award_floor"),
        F.max(F.when(kind == "killed", F.struct("scene", "x", "y", "z"))).alias("place"),
        F.sort_array(F.collect_list(F.when(kind == "levelup", F.struct(
            F.col("first_ord").alias("ord"), F.col("sub").cast("int").alias("level"),
            F.col("usetime").alias("usetime"), F.col("first_ts").alias("ts"),
        )))).alias("ups"),
    )


def cohort_role_days(events: DataFrame, cohort: DataFrame, zone: str = "UTC",
                     max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Daily rows of cohort roles.

    A cohort small enough is broadcast before anything is shuffled. A larger one is
    joined after the map-side combine, when no role is hot any more.
    """
    keys = cohort.select("roleid")
    touched = handled(events)
    if fits_broadcast(keys, max_rows):
        parts = role_day_parts(touched.join(F.broadcast(keys), "roleid", "left_semi"), zone)
        return role_days(parts.repartition("roleid"))
    # Both shuffles hash the role, and what follows groups by it: no further exchange.
    parts = role_day_parts(touched, zone).repartition("roleid")
    return role_days(parts.join(keys, "roleid", "left_semi"))


def _state(level, pace, prev, near, ts, gift, seen) -> Column:
    return F.struct(
        level.cast("int").alias("level"), pace.cast("int").alias("pace"), prev.cast("int").alias("prev"),
        near.cast("int").alias("near"), ts.cast("bigint").alias("ts"), gift.cast("int").alias("gift"),
        seen.alias("seen"),
    )


def start_state(seen: Column | None = None) -> Column:
    zero = F.lit(0)
    return _state(zero, zero, zero, zero, zero, zero, F.lit(False) if seen is None else seen)


def step_up(s: Column, u: Column) -> Column:
    """State after one level-up row: only a rise in level counts, only a slower rise moves the pace."""
    creates = ~s.seen
    rises = creates | (u.level > s.level)
    slower = rises & ~creates & (s.pace < u.usetime)
    return _state(
        F.when(rises, u.level).otherwise(s.level),
        F.when(creates | slower, u.usetime).otherwise(s.pace),
        F.when(slower, s.pace).otherwise(s.prev),
        F.when(slower, u.usetime - s.pace).otherwise(s.near),
        F.when(rises, F.greatest(s.ts, u.ts)).otherwise(s.ts),
        s.gift, F.lit(True),
    )


def replay_day(s: Column, d: Column) -> Column:
    """State after one day, its flows taken in replay order."""
    up = F.aggregate(d.ups, s, step_up)

    def later(u: Column) -> Column:
        ts = F.greatest(u.ts, d.task_ts)
        seen = u.seen | d.task_ts.isNotNull()
        creating = ~seen & (d.award_ord == d.award_first_ord)
        wins = (d.award_ts > ts) & ~creating
        return _state(
            F.least(u.level, d.award_floor), u.pace, u.prev, u.near,
            F.greatest(ts, d.award_ts, d.late_ts),
            F.when(wins, d.award_id).otherwise(u.gift), F.lit(True),
        )

    # A one-element transform names the folded value, so it is evaluated once.
    return F.get(F.transform(F.array(up), later), F.lit(0))


def _role_rows(days: DataFrame) -> DataFrame:
    """One row per role: plain sums, and its days in order (at most one entry per day of the range)."""
    died = F.col("place").isNotNull()
    return days.groupBy("roleid").agg(
        F.sum("tasks").alias("taskid_sum"), F.sum("online").alias("online_sum"),
        F.sum("killed").alias("killed_times"), F.sum("kills").alias("killer_num"),
        F.min("any_first_ts").alias("any_first_ts"), F.max("any_ts").alias("any_ts"),
        F.max_by("award_id", "award_ts").alias("latest_award"),
        F.max_by("place", F.when(died, F.col("day"))).alias("place"),
        F.sort_array(F.collect_list(F.struct(
            "day", "task_ts", "award_ts", "award_id", "award_ord", "award_first_ord", "award_floor", "late_ts", "ups",
        ))).alias("days"),
    )


def _role_state(rows: DataFrame, zone: str) -> DataFrame:
    clock = epoch_clock(F.col("ts"), zone)
    zero = F.lit(0)
    place = lambda c: F.coalesce(F.col(f"place.{c}"), zero)
    return rows.select(
        "roleid", clock.cast("date").alias("day"), clock_time(clock).alias("log_time"), "ts",
        "taskid_sum", zero.cast("bigint").alias("inst_sum"), "online_sum", zero.cast("bigint").alias("day_act"),
        "killed_times", "killer_num", zero.cast("bigint").alias("diamond_revive_num"),
        F.col("fold.near").alias("near_levelup_time"),
        F.coalesce("gift", zero).alias("last_gift_id"),
        F.col("fold.level").alias("local_level"), F.col("fold.pace").alias("local_levelup_time"),
        F.col("fold.prev").alias("last_up_time"),
        place("scene").alias("logout_scene"), place("x").alias("logout_x"),
        place("y").alias("logout_y"), place("z").alias("logout_z"),
    )


def replay_state(days: DataFrame, zone: str = "UTC") -> DataFrame:
    """Role state as a line-by-line replay leaves it, quirks included.

    An award with a lower level lowers the role again, a level-up that raises
    nothing does not count as activity, and a gift needs a strictly newer time.
    """
    rows = _role_rows(days).withColumn("fold", F.aggregate("days", start_state(), replay_day))
    return _role_state(rows.withColumns({"ts": F.col("fold.ts"), "gift": F.col("fold.gift")}), zone)


def event_time_state(days: DataFrame, zone: str = "UTC") -> DataFrame:
    """Role state by event time: every handled row is activity, the latest award is the gift."""
    rows = _role_rows(days).withColumn("ups", F.flatten(F.transform("days", lambda d: d.ups)))
    first_up = F.get("ups", F.lit(0)).ts
    born_otherwise = ~F.coalesce(first_up <= F.col("any_first_ts"), F.lit(False))
    rows = rows.withColumn("fold", F.aggregate("ups", start_state(born_otherwise), step_up))
    return _role_state(rows.withColumns({"ts": F.col("any_ts"), "gift": F.col("latest_award")}), zone)


def role_activity(events: DataFrame, as_of: str | dt.date, replay: bool = False, zone: str = "UTC",
                  max_rows: int = BROADCAST_ROWS, cohort: Cohort | None = None) -> DataFrame:
    """State of every active cohort role from the cohort day on; event-time rules unless ``replay``.

    ``cohort`` saves looking for the role creations among ``events``.
    """
    cohort = cohort or stored_cohort(events, as_of)
    days = cohort_role_days(activity_range(events, as_of, cohort), cohort.roles, zone, max_rows)
    return replay_state(days, zone) if replay else event_time_state(days, zone)

"""Role tables: activity per role and the unchanging base data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.operators.numbering import assign_sn
from rolepulse.operators.tableops import replace_into

# ---- fixed values: columns, types and defaults of the role tables ------------
ROLE_ACT_FLOW = {
    "day": "date", "log_time": "string", "task_sum": "int", "inst_sum": "int", "day_act": "int",
    "killed_times": "int", "diamond_revive": "int", "last_gift_id": "int", "online_time": "int",
    "logout_scene": "int", "levelup_lasttime": "int", "logout_pos_x": "int", "logout_pos_y": "int",
    "logout_pos_z": "int", "id": "bigint", "roleid": "bigint", "killer_sum": "int", "init30_level": "int",
}
ROLE_ACT_DEFAULTS = {"task_sum": 0, "inst_sum": 0, "last_gift_id": 0, "online_time": 0, "killer_sum": 0}

# Role state column -> table column; the first ten are always written.
WRITTEN = {
    "day": "day", "log_time": "log_time", "taskid_sum": "task_sum", "inst_sum": "inst_sum", "day_act": "day_act",
    "killed_times": "killed_times", "diamond_revive_num": "diamond_revive", "online_sum": "online_time",
    "roleid": "roleid", "killer_num": "killer_sum",
}
WRITTEN_IN_FULL = {
    "last_gift_id": "last_gift_id", "logout_scene": "logout_scene", "local_levelup_time": "levelup_lasttime",
    "logout_x": "logout_pos_x", "logout_y": "logout_pos_y", "logout_z": "logout_pos_z", "local_level": "init30_level",
}

ROLE_BASE = {
    "id": "bigint", "name": "string", "gender": "tinyint", "profession": "tinyint", "zone": "int",
    "create_time": "timestamp_ntz", "nation": "int",
}
# ---- end of fixed values ----------------------------------------------------


def save_role_activity(target: DataFrame, roles: DataFrame, keys: tuple[str, ...] = ("roleid",),
                       full: bool = False) -> DataFrame:
    """``target`` (role_act_flow or init30_behavior) after replacing the rows of ``roles``.

    New rows get the next ids; columns that are not written fall back to their defaults.
    """
    columns = {**WRITTEN, **(WRITTEN_IN_FULL if full else {})}
    rows = roles.select(*[F.col(a).cast(ROLE_ACT_FLOW[b]).alias(b) for a, b in columns.items()])
    if "id" in target.columns:
        last = target.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))   # one row
        numbered = assign_sn(rows, order=["roleid"], name="id")
        rows = numbered.crossJoin(F.broadcast(last)).withColumn("id", F.col("id") + F.col("_last")).drop("_last")
    defaults = {c: F.lit(v) for c, v in ROLE_ACT_DEFAULTS.items()}
    return replace_into(target, rows, list(keys), defaults=defaults)


def save_role_base(target: DataFrame, cohort: DataFrame) -> DataFrame:
    """``target`` (role_base) after replacing the cohort's roles; name and gender are not known."""
    rows = cohort.select(F.col("roleid").alias("id"), "profession", "nation", "create_time")
    return replace_into(target, rows, ["id"], order=["create_time"])

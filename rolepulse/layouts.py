"""Record layouts of the flow logs and the constants shared by every job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: layouts, zones and orders the inputs dictate -------------

# Fields that follow "date time" on a flow line, in file order.
FLOW_FIELDS: dict[str, list[tuple[str, str]]] = {
    "createrole": [("roleid", "bigint"), ("profession", "tinyint"), ("nation", "tinyint")],
    "roleloginlogout": [("roleid", "bigint"), ("action", "string"), ("level", "int"), ("online_time", "int")],
    "taskflow": [("roleid", "bigint"), ("level", "int"), ("task_id", "int"), ("action", "string")],
    "levelup": [("roleid", "bigint"), ("profession", "tinyint"), ("level", "int"), ("usetime", "int")],
    "death": [
        ("roleid", "bigint"), ("level", "int"), ("killer", "bigint"),
        ("killer_level", "int"), ("scene", "int"), ("pos", "string"),
    ],
    "award": [("roleid", "bigint"), ("level", "int"), ("award", "int")],
    "instance": [("roleid", "bigint"), ("level", "int"), ("instance_tid", "int"), ("status", "int")],
}

# Types the raw log produces, in the order its patterns are tried.
RAW_TYPES = ("roleloginlogout", "taskflow", "createrole", "levelup", "death")

# Replay order of the activity flows inside one day.
REPLAY_ORDER = ("levelup", "taskflow", "award", "death", "roleloginlogout")

VALID_ZONES = ("1002", "1004", "1005")
RAW_ZONES = ("1004", "1005")          # zones and file name the ingest takes
RAW_FILE = "world2.formatlog"
TABLE_RENAMES = {"taskflow": "task"}

RANGE_START = -30        # first day looked at, relative to as_of
RANGE_END = -2           # last day looked at, relative to as_of
LOST_DAY = 1             # days without activity after which a role counts as lost
SGD_ITERATIONS = 10

# The eight counters the churn model uses. Three have no producer and stay 0.
MODEL_FEATURES = (
    "taskid_sum", "inst_sum", "online_sum", "day_act",
    "killed_times", "killer_num", "diamond_revive_num", "near_levelup_time",
)
# ---- end of fixed values ----------------------------------------------------


def check_type(log_type: str) -> str:
    if log_type not in FLOW_FIELDS:
        raise ValueError(f"unknown flow type {log_type!r}; known types: {', '.join(sorted(FLOW_FIELDS))}")
    return log_type


def table_type(log_type: str) -> str:
    """Name a flow type carries once it is a table (``taskflow`` becomes ``task``)."""
    return TABLE_RENAMES.get(log_type, log_type)


def table_type_column(log_type: Column) -> Column:
    out = log_type
    for old, new in TABLE_RENAMES.items():
        out = F.when(log_type == old, F.lit(new)).otherwise(out)
    return out


def replay_rank(log_type: Column) -> Column:
    """Position of a flow type in the replay order of one day; NULL if it is not replayed."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(REPLAY_ORDER):
        out = F.when(log_type == name, F.lit(i)).otherwise(out)
    return out

"""Game flows derived from the ``events`` table by a fixed mapping.

click -> taskflow, error -> death, purchase -> award / levelup, signup ->
createrole, view -> login / logout; ``event_id`` is the line order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.layouts import FLOW_FIELDS, VALID_ZONES

AS_OF = "2024-01-31"

# The mapping's own parameters.
KILLERS = 150
PROFESSIONS = 8
NATIONS = 3


# ---- fixed values: flow type -> event_type ----------------------------------
EVENT_TYPES = {
    "createrole": "signup", "taskflow": "click", "death": "error", "roleloginlogout": "view",
    "award": "purchase", "levelup": "purchase", "instance": "click",
}
# ---- end of fixed values ----------------------------------------------------


def flow_events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """Events as rows of the common event shape: all of them, or those of some flow types.

    Asking for types puts a plain ``event_type`` filter on the scan.
    """
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    if types:
        source = source.where(F.col("event_type").isin(sorted({EVENT_TYPES[t] for t in types})))
    etype, eid, user, value = F.col("event_type"), F.col("event_id"), F.col("user_id"), F.col("value")
    even = eid % 2 == 0
    log_type = F.col("log_type")
    k = F.col("k")
    # k and log_type feed many columns: a step of their own computes them once per row.
    e = source.select(
        "event_id", "ts", "user_id", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(etype == "signup", "createrole")
        .when(etype == "click", "taskflow")
        .when(etype == "error", "death")
        .when(etype == "view", "roleloginlogout")
        .when((etype == "purchase") & even, "award")
        .when(etype == "purchase", "levelup").alias("log_type"),
    )

    def only(t: str, c: Column, kind: str) -> Column:
        return F.when(log_type == t, c.cast(kind)).cast(kind)

    money = value.cast("decimal(12,2)")
    base = e.select(
        F.element_at(F.array(*[F.lit(z) for z in VALID_ZONES]), (user % 3 + 1).cast("int")).alias("zone"),
        F.col("ts").cast("date").alias("day"),
        "log_type",
        eid.alias("ord"),
        F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts"), F.minute("ts"),
                             F.second("ts")).alias("log_time"),
        user.alias("roleid"),
        only("createrole", user % PROFESSIONS, "tinyint").alias("profession0"),
        only("createrole", user % NATIONS, "tinyint").alias("nation"),
        only("levelup", user % PROFESSIONS, "tinyint").alias("profession1"),
        F.when(log_type != "createrole", k).alias("level"),
        only("taskflow", k, "int").alias("task_id"),
        F.when(log_type == "taskflow", F.when(even, "accomplished").otherwise("accepted"))
        .when(log_type == "roleloginlogout", F.when(even, "logout").otherwise("login")).alias("action"),
        only("roleloginlogout", F.when(even, F.floor(value)).otherwise(0), "int").alias("online_time"),
        only("levelup", F.floor(value * 100), "int").alias("usetime"),
        only("death", (user + eid) % KILLERS, "bigint").alias("killer"),
        only("death", k, "int").alias("killer_level"),
        only("death", k % 10, "int").alias("scene"),
        F.when(log_type == "death", F.concat(
            F.lit("("), money.cast("string"), F.lit(","), (-money).cast("string"), F.lit(","), k.cast("string"),
            F.lit(")"))).alias("pos"),
        only("award", k, "int").alias("award"),
        "k",
    )
    return base.withColumn("profession", F.coalesce("profession0", "profession1")).drop("profession0", "profession1").where(
        F.col("log_type").isin([t for t in types if t != "instance"] + ["taskflow"] * ("instance" in types))
        if types else F.lit(True)
    )


def flow_of(events: DataFrame, log_type: str) -> DataFrame:
    """One flow's own columns. ``instance`` rows have no event kind: clicks stand in for them."""
    if log_type == "instance":
        events = events.where(F.col("log_type") == "taskflow").withColumns({
            "log_type": F.lit("instance"),
            "instance_tid": F.col("k"),
            "status": (F.col("ord") % 2).cast("int"),
        })
    names = [n for n, _ in FLOW_FIELDS[log_type]]
    return events.where(F.col("log_type") == log_type).select("zone", "day", "log_type", "ord", "log_time", *names)


def flow_text(flow: DataFrame, log_type: str) -> DataFrame:
    """A flow as text lines in its file layout, with zone, day, log_type and ord."""
    names = [n for n, _ in FLOW_FIELDS[log_type]]
    value = F.concat_ws(" ", F.col("log_time").cast("string"), *[F.col(n).cast("string") for n in names])
    return flow.select(value.alias("value"), "zone", F.col("day").cast("string").alias("day"), "log_type", "ord")


def raw_lines(events: DataFrame) -> DataFrame:
    """Events rendered as raw log lines; awards become chatter no pattern matches."""
    t = F.col("log_type")
    head = F.concat(F.col("log_time").cast("string"), F.lit(" gs1 formatlog:"))
    xyz = F.split(F.regexp_replace("pos", "[()]", ""), ",")
    body = (
        F.when((t == "roleloginlogout") & (F.col("action") == "login"),
               F.format_string("rolelogin:acct=zz:roleid=%s:os=2:lev=%s", "roleid", "level"))
        .when(t == "roleloginlogout",
              F.format_string("rolelogout:acct=zz:roleid=%s:os=2:lev=%s:ip=1.1.1.1:time=%s",
                              "roleid", "level", "online_time"))
        .when(t == "taskflow", F.format_string("task_%s:from=1:os=2:roleid=%s:level=%s:taskid=%s",
                                               "action", "roleid", "level", "task_id"))
        .when(t == "createrole", F.format_string("createrole:from=1:roleid=%s:os=2:profession=%s:nation=%s",
                                                 "roleid", "profession", "nation"))
        .when(t == "levelup", F.format_string("levelup_lo:roleid=%s:level=%s:zone=1:time_used=%s:prof=%s",
                                              "roleid", "level", "usetime", "profession"))
        .when(t == "death", F.format_string(
            "death:roleid=%s:level=%s:attacker_id=%s:attacker_level=%s:why=1:scene_tag=%s:x=%s:y=%s:z=%s",
            F.col("roleid"), F.col("level"), F.col("killer"), F.col("killer_level"), F.col("scene"),
            F.get(xyz, F.lit(0)), F.get(xyz, F.lit(1)), F.get(xyz, F.lit(2))))
        .otherwise(F.format_string("chat:roleid=%s:hello", "roleid"))
    )
    return events.select(F.concat(head, body).alias("value"), "zone", F.col("day").cast("string").alias("day"), "ord")

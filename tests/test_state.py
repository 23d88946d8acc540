"""Per-role state against a plain loop over the same rows, on random roles and with a hot one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rolepulse.plans import activity as A
from rolepulse.plans import churn as C

AS_OF = "2016-12-01"
FIRST = dt.date(2016, 11, 1)
RANK = {"levelup": 0, "taskflow": 1, "award": 2, "death": 3, "roleloginlogout": 4}
SCHEMA = ("zone string, day date, log_type string, ord long, log_time timestamp_ntz, roleid long, level int, "
          "action string, online_time int, usetime int, killer long, scene int, pos string, award int, "
          "profession tinyint, nation tinyint")


def make_rows(seed, roles, per_role, hot=0):
    rng = random.Random(seed)
    rows, n = [], 0
    for r in range(roles):
        rows.append(dict(day=FIRST, log_type="createrole", roleid=r, second=0, profession=1, nation=2))
    owners = [r for r in range(roles) for _ in range(per_role)] + [0] * hot
    for r in owners:
        t = rng.choice(list(RANK))
        row = dict(day=FIRST + dt.timedelta(days=rng.randrange(0, 31)), log_type=t, roleid=r,
                   second=rng.randrange(0, 50), level=rng.randrange(-1, 9))
        if t == "levelup":
            row["usetime"] = rng.randrange(-2, 30)
        elif t == "award":
            row["award"] = rng.randrange(1, 99)
        elif t == "death":
            row.update(killer=rng.randrange(0, roles + 3), scene=rng.randrange(9),
                       pos=f"({rng.uniform(-5, 5):.2f},{rng.uniform(-5, 5):.2f},7)")
        elif t == "roleloginlogout":
            row.update(action=rng.choice(["login", "logout"]), online_time=rng.randrange(0, 600))
        rows.append(row)
    rng.shuffle(rows)
    for row in rows:
        row["ord"] = n = n + 1
    return rows


def events_of(spark, rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    out = []
    for r in rows:
        full = {**dict.fromkeys(names), **r, "zone": "1002"}
        full["log_time"] = dt.datetime.combine(r["day"], dt.time()) + dt.timedelta(seconds=r["second"])
        out.append(tuple(full[n] for n in names))
    return spark.createDataFrame(out, SCHEMA)


def epoch(row):
    return (row["day"] - dt.date(1970, 1, 1)).days * 86400 + row["second"]


def loop(rows, last_day):
    """The replay, one row after the other."""
    cohort = {r["roleid"] for r in rows if r["log_type"] == "createrole" and r["day"] == FIRST}
    state = {}
    todo = [r for r in rows if r["log_type"] in RANK and FIRST <= r["day"] <= last_day]
    for r in sorted(todo, key=lambda r: (r["day"], RANK[r["log_type"]], r["ord"])):
        t = r["log_type"]
        if t == "roleloginlogout" and r["action"] == "login":
            continue
        sides = [("killed", r["roleid"]), ("killer", r["killer"])] if t == "death" else [(t, r["roleid"])]
        for kind, role in sides:
            if role not in cohort:
                continue
            new = role not in state
            s = state.setdefault(role, dict(
                ts=epoch(r), taskid_sum=0, online_sum=0, killed_times=0, killer_num=0, near_levelup_time=0,
                last_gift_id=0, local_level=0, local_levelup_time=0, last_up_time=0, logout_scene=0, logout_x=0,
                logout_y=0, logout_z=0))
            if kind == "levelup":
                if new:
                    s.update(local_level=r["level"], local_levelup_time=r["usetime"])
                elif r["level"] > s["local_level"]:
                    s["local_level"] = r["level"]
                    if s["local_levelup_time"] < r["usetime"]:
                        s["last_up_time"] = s["local_levelup_time"]
                        s["near_levelup_time"] = r["usetime"] - s["local_levelup_time"]
                        s["local_levelup_time"] = r["usetime"]
                    s["ts"] = max(s["ts"], epoch(r))
            elif kind == "award":
                if epoch(r) > s["ts"]:
                    s.update(ts=epoch(r), last_gift_id=r["award"])
                s["local_level"] = min(s["local_level"], r["level"])
            else:
                s["ts"] = max(s["ts"], epoch(r))
                if kind == "taskflow":
                    s["taskid_sum"] += 1
                elif kind == "roleloginlogout":
                    s["online_sum"] += r["online_time"]
                elif kind == "killer":
                    s["killer_num"] += 1
                else:
                    x, y, z = (int(float(p)) for p in r["pos"].strip("()").split(","))
                    s["killed_times"] += 1
                    s.update(logout_scene=r["scene"], logout_x=x, logout_y=y, logout_z=z)
    return state


@pytest.mark.parametrize("seed, roles, per_role, hot, max_rows", [
    (1, 40, 12, 0, 1000), (2, 60, 6, 0, 0), (3, 30, 40, 0, 1000), (4, 25, 8, 900, 1000), (5, 25, 8, 900, 0),
])
def test_replay_equals_loop(spark, seed, roles, per_role, hot, max_rows):
    rows = make_rows(seed, roles, per_role, hot)
    got = A.role_activity(events_of(spark, rows), AS_OF, replay=True, max_rows=max_rows).collect()
    want = loop(rows, dt.date(2016, 11, 29))
    assert len(got) == len(want)
    for r in got:
        assert {k: r[k] for k in want[r["roleid"]]} == want[r["roleid"]], r["roleid"]


def test_struct_order_gives_the_same_state(spark):
    """Flow files order lines by (file, split, row) instead of one number."""
    events = events_of(spark, make_rows(6, 30, 20))
    split = events.withColumn("ord", F.struct(
        F.floor(F.col("ord") / 100).alias("file"), F.lit(0).alias("block"), (F.col("ord") % 100).alias("row")))
    a, b = (sorted(map(tuple, A.role_activity(e, AS_OF, replay=True).collect())) for e in (events, split))
    assert a == b


def test_no_cohort_gives_no_rows(spark):
    events = events_of(spark, make_rows(7, 5, 5)).where("log_type <> 'createrole'")
    assert A.role_activity(events, AS_OF).count() == 0
    features = C.labelled_features(events, AS_OF)
    rate = C.lost_rate(features, A.read_cohort(events, AS_OF)).first()
    assert tuple(rate) == (None, 0, 0)
    stats = C.class_feature_stats(features, ["online_sum"]).first()
    assert tuple(stats) == ("online_sum", None, None, None, None)


def test_lost_is_strictly_more_than_a_day(spark):
    roles = spark.createDataFrame([(1, 86400 * 9), (2, 86400 * 9 - 1)], "roleid long, ts long")
    top = spark.createDataFrame([(86400 * 10,)], "ts long")
    got = {r["roleid"]: r["is_lost"] for r in C.churn_label(roles, top).collect()}
    assert got == {1: False, 2: True}


def test_select_features_is_the_model_order(spark):
    from rolepulse.layouts import MODEL_FEATURES

    assert C.select_features(A.role_activity(events_of(spark, make_rows(8, 3, 3)), AS_OF)) == list(MODEL_FEATURES)

"""Raw lines, one by one: what each pattern takes and what it refuses."""

import pytest
from pyspark.sql import functions as F

from rolepulse.sources import formatlog as L

LINES = {
    "2016-11-10 00:00:05 gs1 formatlog:rolelogin:acct=zz:roleid=11:os=2:lev=1":
        ("roleloginlogout", "2016-11-10 00:00:05 11 login 1 0"),
    "2016-11-10 00:10:05 gs1 formatlog:rolelogout:acct=zz:roleid=11:os=2:lev=4:ip=1.1.1.1:time=600":
        ("roleloginlogout", "2016-11-10 00:10:05 11 logout 4 600"),
    "2016-11-10 00:02:00 gs1 formatlog:task_accomplished:from=1:os=2:roleid=11:level=2:taskid=20091":
        ("taskflow", "2016-11-10 00:02:00 11 2 20091 accomplished"),
    "2016-11-10 00:00:00 gs1 formatlog:createrole:from=1:roleid=11:os=2:profession=3:nation=2":
        ("createrole", "2016-11-10 00:00:00 11 3 2"),
    "2016-11-10 00:03:00 gs1 formatlog:levelup_lo:roleid=11:level=2:zone=1:time_used=120:prof=3":
        ("levelup", "2016-11-10 00:03:00 11 3 2 120"),
    "2016-11-10 00:04:00 gs1 formatlog:death:roleid=11:level=2:attacker_id=12:attacker_level=9:why=1:scene_tag=7"
    ":x=1.5:y=-2.7:z=30": ("death", "2016-11-10 00:04:00 11 2 12 9 7 (1.5,-2.7,30)"),
    # noise around and inside, unanchored on both ends
    "<13>x 2016-11-10T00:04:00.125 a b formatlog:createrole:from=:roleid=7:x=1:y=2:profession=1:nation=0 tail  end":
        ("createrole", "2016-11-10T00:04:00.125 7 1 0"),
    # a marker whose own pattern fails must not hide a later match
    "2016-11-10 00:00:00 formatlog:rolelogin: formatlog:death:roleid=1:level=2:attacker_id=3:attacker_level=4:w=1"
    ":scene_tag=5:x=.5:y=0:z=0": ("death", "2016-11-10 00:00:00 1 2 3 4 5 (.5,0,0)"),
    "2016-11-10 00:04:00 gs1 formatlog:chat:roleid=11:hello": (None, None),
    "2016-11-10 00:04:00 gs1 formatlog:createrole:from=1:roleid=x:os=2:profession=3:nation=2": (None, None),
    "no time formatlog:rolelogin:acct=zz:roleid=11:os=2:lev=1": (None, None),
    "2016-11-10 00:02:00 formatlog:task_:from=1:os=2:roleid=11:level=2:taskid=20091": (None, None),
    "": (None, None),
}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(LINES)], "n int, value string")


def test_classify(lines):
    got = {r["value"]: r["log_type"] for r in L.classify(lines).collect()}
    assert got == {line: want[0] for line, want in LINES.items()}


def test_flow_lines(lines):
    parsed = L.parse(lines)
    got = {r["n"]: (r["log_type"], r["line"]) for r in
           parsed.select("n", "log_type", L.flow_line(F.col("log_type")).alias("line")).collect()}
    assert got == {i: want for i, want in enumerate(LINES.values()) if want[0]}


def test_every_pattern_runs_once_per_line(lines):
    plan = L.parse(lines).where("kind = 'death' AND log_type IS NOT NULL")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_replace") == len(L.LINE_KINDS)


@pytest.mark.parametrize("path, zone, day", [
    ("/export/seven/1004/2016-11-10/world2.formatlog", "1004", "2016-11-10"),
    ("file:/w/zone=1005/day=2016-11-10/part-0.txt", "1005", "2016-11-10"),
    ("/export/seven/1004/undated/world2.formatlog", "", ""),
])
def test_path_fields(spark, path, zone, day):
    row = spark.range(1).select(L.path_zone(F.lit(path)), L.path_day(F.lit(path))).first()
    assert tuple(row) == (zone, day)

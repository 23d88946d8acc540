"""The cohort day decides where activity starts, and only the listed zones decide the cohort day."""

import os

from rolepulse.plans import activity as A
from rolepulse.sources import flowfiles

AS_OF = "2016-12-01"


def put(root, zone, day, log_type, *lines):
    folder = os.path.join(root, f"zone={zone}", f"day={day}", f"log_type={log_type}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-00000.txt"), "w") as f:
        f.writelines(line + "\n" for line in lines)


def state(spark, root, zones=None):
    events, created = flowfiles.activity_inputs(spark, root, AS_OF, zones)
    return A.role_activity(events, AS_OF, replay=True, cohort=A.stored_cohort(created, AS_OF)).collect()


def test_activity_starts_on_the_cohort_day(spark, tmp_path):
    root = str(tmp_path)
    put(root, "1004", "2016-11-15", "createrole", "2016-11-15 00:00:00 7 1 2")
    put(root, "1004", "2016-11-10", "taskflow", "2016-11-10 00:00:01 7 1 20 accepted", "2016-11-10 00:00:02 7 1 21 accepted")
    put(root, "1004", "2016-11-16", "taskflow", "2016-11-16 00:00:01 7 1 22 accepted")
    assert [(r["roleid"], r["taskid_sum"]) for r in state(spark, root)] == [(7, 1)]
    # the same from one event table
    events = flowfiles.typed_events(flowfiles.read_partitioned(spark, root))
    assert [r["taskid_sum"] for r in A.role_activity(events, AS_OF).collect()] == [1]


def test_unlisted_zones_do_not_set_the_cohort_day(spark, tmp_path):
    root = str(tmp_path)
    put(root, "1009", "2016-11-05", "createrole", "2016-11-05 00:00:00 1 1 2")
    put(root, "1004", "2016-11-15", "createrole", "2016-11-15 00:00:00 7 1 2")
    put(root, "1004", "2016-11-16", "taskflow", "2016-11-16 00:00:01 7 1 22 accepted")
    assert [r["roleid"] for r in state(spark, root, ["1002", "1004", "1005"])] == [7]


def test_no_created_roles(spark, tmp_path):
    root = str(tmp_path)
    put(root, "1004", "2016-11-16", "taskflow", "2016-11-16 00:00:01 7 1 22 accepted")
    assert state(spark, root) == []

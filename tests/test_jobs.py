"""Files, tables, streams and training on small real layouts."""

import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rolepulse.operators.numbering import assign_sn, id_blocks
from rolepulse.plans import activity as A
from rolepulse.plans import training as T
from rolepulse.sinks.flowtables import load_flow_table, load_flow_tables
from rolepulse.sources import flowfiles
from rolepulse.sources.tables import read_flow_table, table_path
from rolepulse.streaming import ingest


def put(root, name, *lines):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(line + "\n" for line in lines)


@pytest.fixture
def plain(tmp_path):
    root = str(tmp_path / "flows")
    put(root, "1002/2016-11-08_taskflow", "2016-11-08 00:00:01 7 1 20 accepted", "2016-11-08 00:00:02 8 1 21 accepted")
    put(root, "1002/2016-11-07_taskflow", "2016-11-07 00:00:01 7 1 19 accepted")
    put(root, "1002/2016-11-07_createrole", "2016-11-07 00:00:00 7 1 2")
    put(root, "1004/2016-11-08_taskflow", "2016-11-08 00:00:09 9 1 22 accomplished")
    put(root, "1002/notes", "no underscore")
    put(root, "1009/2016-11-08_taskflow", "2016-11-08 00:00:09 1 1 1 accepted")
    return root


def test_discover(spark, plain):
    got = {(r["zone"], r["log_type"]): r["file_list"] for r in flowfiles.discover(spark, plain).collect()}
    assert got == {
        ("1002", "taskflow"): ["2016-11-07_taskflow", "2016-11-08_taskflow"],
        ("1002", "createrole"): ["2016-11-07_createrole"],
        ("1004", "taskflow"): ["2016-11-08_taskflow"],
    }


def test_read_plain_skips_missing_files(spark, plain):
    days = flowfiles.day_range("2016-11-10", -5, -2)
    got = flowfiles.read_plain(spark, plain, days, ["taskflow", "award"])
    rows = sorted((r["zone"], r["day"], r["log_type"], r["value"][-1:]) for r in got.collect())
    assert [r[:3] for r in rows] == [
        ("1002", "2016-11-07", "taskflow"), ("1002", "2016-11-08", "taskflow"), ("1002", "2016-11-08", "taskflow"),
        ("1004", "2016-11-08", "taskflow")]
    assert flowfiles.read_plain(spark, plain, ["1999-01-01"], ["award"]).count() == 0


def test_load_numbers_in_day_and_line_order_and_goes_on(spark, plain, tmp_path):
    def read(log_type):
        return flowfiles.read_plain(spark, plain, ["2016-11-07", "2016-11-08"], [log_type])

    root = str(tmp_path / "tables")
    load_flow_tables(read, root, ["taskflow", "createrole"])
    assert os.path.basename(table_path(root, "taskflow")) == "flow_task"

    def numbers():
        return sorted((r["zone"], r["sn"], r["task_id"]) for r in read_flow_table(spark, root, "taskflow").collect())

    first = [("1002", 1, 19), ("1002", 2, 20), ("1002", 3, 21), ("1004", 1, 22)]
    assert numbers() == first
    load_flow_table(read("taskflow"), "taskflow", root)
    assert numbers() == sorted(first + [("1002", 4, 19), ("1002", 5, 20), ("1002", 6, 21), ("1004", 2, 22)])


def test_assign_sn_is_dense(spark):
    rows = spark.range(0, 5000, 7).repartition(6)
    got = assign_sn(rows, order=["id"], chunk=id_blocks("id", 100), start=10).orderBy("id").collect()
    assert [r["sn"] for r in got] == list(range(11, 11 + len(got)))


def test_assign_sn_by_position(spark):
    rows = spark.range(0, 400).select("id", F.floor(F.col("id") / 64).alias("file"), (F.col("id") + 1000).alias("at"))
    for max_chunks in (100, 0):
        got = assign_sn(rows, order=["id"], chunk=[F.col("file")], position=F.col("at"), max_chunks=max_chunks)
        assert [r["sn"] for r in got.orderBy("id").collect()] == list(range(1, 401))
    with pytest.raises(Exception, match="not contiguous"):
        assign_sn(rows.where("id <> 5"), order=["id"], chunk=[F.col("file")], position=F.col("at")).collect()


RAW = {
    "1004/2016-11-10/world2.formatlog": [
        "2016-11-10 00:00:00 gs1 formatlog:createrole:from=1:roleid=11:os=2:profession=3:nation=2",
        "2016-11-11 00:00:01 gs1 formatlog:rolelogin:acct=zz:roleid=11:os=2:lev=1",
        "2016-11-10 00:04:00 gs1 formatlog:chat:roleid=11:hello",
    ],
    "1005/2016-11-10/world2.formatlog": [
        "2016-11-10 00:03:00 gs1 formatlog:levelup_lo:roleid=11:level=2:zone=1:time_used=120:prof=3",
    ],
    **{name: ["2016-11-10 00:03:00 gs1 formatlog:levelup_lo:roleid=5:level=2:zone=1:time_used=120:prof=3"] for name in (
        "misc/world2.formatlog", "1004/2016-11-10/world2.test", "1777/2016-11-10/world2.formatlog")},
}


def test_stream_restart_and_replay(spark, tmp_path):
    raw, out, check = (str(tmp_path / n) for n in ("raw", "out", "check"))
    for name, lines in RAW.items():
        put(raw, name, *lines)

    def rows(path):
        return sorted((r["zone"], r["day"], r["log_type"], r["value"])
                      for r in flowfiles.read_partitioned(spark, path).collect())

    want = [
        ("1004", "2016-11-10", "createrole", "2016-11-10 00:00:00 11 3 2"),
        # a late line goes where its file path says
        ("1004", "2016-11-10", "roleloginlogout", "2016-11-11 00:00:01 11 login 1 0"),
        ("1005", "2016-11-10", "levelup", "2016-11-10 00:03:00 11 3 2 120"),
    ]
    # files outside a listed zone's folder and of another name are not even opened
    assert ingest.run_once(spark, raw, out, check) == {"read": 4, "written": 3}
    assert rows(out) == want
    assert ingest.run_once(spark, raw, out, check) == {"read": 0, "written": 0}
    assert rows(out) == want
    put(raw, "1005/2016-11-11/world2.formatlog",
        "2016-11-11 00:00:00 gs1 formatlog:createrole:from=1:roleid=12:os=2:profession=3:nation=2")
    assert ingest.run_once(spark, raw, out, check) == {"read": 1, "written": 1}
    want.append(("1005", "2016-11-11", "createrole", "2016-11-11 00:00:00 12 3 2"))
    assert rows(out) == sorted(want)
    assert rows(ingest.replay(spark, raw, max_files=1)) == sorted(want)


def test_the_last_of_rolled_files_wins_and_all_batches_are_counted(spark, tmp_path):
    """A role is created again in each rolled file; its last line is the one of the last file, whatever the names."""
    raw, out, check = (str(tmp_path / n) for n in ("raw", "out", "check"))
    want = {}
    for turn, name in enumerate(("c", "a", "b")):
        for role in range(4):
            put(raw, f"1004/2016-11-10/{name}{role}.log", *[
                f"2016-11-10 00:00:00 gs1 formatlog:createrole:from=1:roleid={role}:os=2:profession={p}:nation=2"
                for p in (7, turn + role)])
            want[role] = turn + role
        assert ingest.run_once(spark, raw, out, check, file_name="*.log")["read"] == 8
    created = flowfiles.typed_events(flowfiles.read_partitioned(spark, out))
    assert {r["roleid"]: r["profession"] for r in A.read_cohort(created, "2016-12-01").collect()} == want
    root = str(tmp_path / "tables")
    load_flow_table(flowfiles.read_partitioned(spark, out, ["createrole"]), "createrole", root)
    last = read_flow_table(spark, root, "createrole").groupBy("roleid").agg(F.max_by("profession", "sn").alias("p"))
    assert {r["roleid"]: r["p"] for r in last.collect()} == want


def test_counts_reach_beyond_the_kept_progress(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for n in range(105):
        put(raw, f"1004/2016-11-10/{n}.log", "2016-11-10 00:00:01 gs1 formatlog:rolelogin:acct=zz:roleid=1:os=2:lev=1")
    counts = ingest.run_once(spark, raw, out, out + "-check", file_name="*.log", max_files=1)
    assert counts == {"read": 105, "written": 105}


def test_weights_equal_the_sgd_models(spark):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    names = ["a", "b", "c"]
    df = spark.range(200).select(
        (F.col("id") % 3 == 0).cast("double").alias("label"),
        (F.col("id") * 37 % 101 / 101).alias("a"), (F.col("id") * 53 % 89 / 89).alias("b"),
        F.lit(0.0).alias("c")).cache()
    points = df.rdd.map(lambda r: LabeledPoint(r["label"], [r["a"], r["b"], r["c"]]))
    for mine, theirs in ((T.train_svm, SVMWithSGD), (T.train_logistic, LogisticRegressionWithSGD)):
        want = theirs.train(points, iterations=10).weights.toArray()
        assert mine(df, names) == pytest.approx(list(want), abs=1e-9)
    assert Vectors.dense(T.train_svm(df, names)).size == 3


def test_training_without_rows(spark):
    empty = spark.createDataFrame([], "label double, a double")
    assert T.train_logistic(empty, ["a"]) == [0.0]


def test_full_save_of_role_state(spark):
    from rolepulse.plans import saving as S
    from tests.test_state import AS_OF, events_of, make_rows

    state = A.role_activity(events_of(spark, make_rows(9, 6, 20)), AS_OF, replay=True).cache()
    schema = ", ".join(f"{c} {t}" for c, t in S.ROLE_ACT_FLOW.items())
    saved = S.save_role_activity(spark.createDataFrame([], schema), state, full=True).collect()
    want = {r["roleid"]: r for r in state.collect()}
    assert sorted(r["id"] for r in saved) == list(range(1, len(want) + 1))
    for r in saved:
        w = want[r["roleid"]]
        assert (r["levelup_lasttime"], r["last_gift_id"], r["init30_level"], r["logout_pos_y"]) == (
            w["local_levelup_time"], w["last_gift_id"], w["local_level"], w["logout_y"])


def test_churn_and_load_jobs_agree_with_the_events(spark, sf_dir, tmp_path):
    from rolepulse import jobs
    from rolepulse.plans import churn as C
    from rolepulse.registry.base import AS_OF, flow_events, flow_root

    flows = flow_root(spark, sf_dir)
    result = jobs.churn_job(spark, flows, str(tmp_path / "out"), AS_OF)
    direct = C.labelled_features(flow_events(spark, sf_dir), AS_OF, replay=True)
    assert sorted(map(tuple, result["features"].collect())) == sorted(map(tuple, direct.collect()))
    assert result["weights"].columns == ["feature", "svm", "logistic"] and result["weights"].count() == 8
    assert result["lost_rate"].first()["active_roles"] == direct.count()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jobs.churn_job(spark, flows, str(tmp_path / "out"), AS_OF)


def test_statistics_do_not_depend_on_the_cohort_route(spark):
    from rolepulse.operators import rolestats as R
    from tests.test_state import events_of, make_rows

    events = events_of(spark, make_rows(10, 20, 10, hot=300))
    cohort = events.where("log_type = 'createrole' AND roleid % 2 = 0")
    tasks = events.where("log_type = 'taskflow'")
    small, large = (sorted(map(tuple, R.for_cohort(R.task_count, tasks, cohort, n).collect())) for n in (1000, 0))
    assert small == large and small

"""The manifest of flow files, the order number of lines, numbering by ranges, the plain layout in the jobs."""

import os

import pytest
from pyspark.sql import functions as F

from rolepulse import jobs
from rolepulse.operators.numbering import assign_sn
from rolepulse.registry.base import AS_OF, flow_lines, flow_root, plain_root
from rolepulse.sinks.plainfiles import write_plain
from rolepulse.sources import flowfiles, manifest as M
from rolepulse.sources.tables import read_flow_table


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def expected(spark, sf_dir):
    """(zone, day, type) -> lines in order, from the events."""
    out = {}
    for r in flow_lines(spark, sf_dir).orderBy("ord").collect():
        out.setdefault((r["zone"], r["day"], r["log_type"]), []).append(r["value"])
    return out


def in_order(lines):
    out = {}
    for r in sorted(lines.collect(), key=lambda r: r["ord"]):
        out.setdefault((r["zone"], r["day"], r["log_type"]), []).append(r["value"])
    return out


@pytest.mark.parametrize("make", [flow_root, plain_root])
def test_order_numbers_are_unique_and_follow_the_lines(spark, sf_dir, make):
    root, want = make(spark, sf_dir), expected(spark, sf_dir)
    found = M.manifest(spark, root)
    lines = found.lines()
    assert lines.schema.simpleString().endswith("ord:bigint>")
    assert in_order(lines) == want
    numbers = lines.select("ord").distinct().count()
    assert numbers == lines.count() == sum(map(len, want.values()))
    ranks = [r["rank"] for r in found.files.orderBy("zone", "day", "log_type", "batch", "part").collect()]
    assert ranks == list(range(1, len(ranks) + 1)) and found.types() == {t for _, _, t in want}


@pytest.mark.parametrize("make", [flow_root, plain_root])
def test_many_files_and_small_splits(spark, sf_dir, make, monkeypatch):
    """The route for manifests too large for the driver, over files cut into many splits."""
    root, want = make(spark, sf_dir), expected(spark, sf_dir)
    monkeypatch.setattr(M, "BROADCAST_FILES", 3)
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "700"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert M.least_split_bytes(spark) == 700
        assert in_order(M.manifest(spark, root).lines()) == want
        few = M.manifest(spark, root).only(["1002"], ["taskflow", "death"], ("2024-01-05", "2024-01-09")).lines()
        assert in_order(few) == {k: v for k, v in want.items() if k[0] == "1002" and k[2] in ("taskflow", "death") and "2024-01-05" <= k[1] <= "2024-01-09"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_order_numbers_that_do_not_fit_are_an_error(spark):
    row = spark.range(1).select(F.lit(5).cast("long").alias("slot"), F.lit(0).cast("long").alias("at"), F.lit(1 << 30).cast("long").alias("row"))
    with pytest.raises(Exception, match="too many"):
        row.select(M.order_number(F.col("slot"), F.col("at"), F.col("row"), 100)).collect()


def test_files_of_neither_layout_and_no_files(spark, tmp_path):
    for name in ("1002/notes", "1002/2024-01-01_taskflow", "batch=3/zone=1004/day=2024-01-02/log_type=death/part-00012-x.txt", "readme.txt"):
        path = tmp_path / "mixed" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("2024-01-01 00:00:00 1\n")
    rows = M.list_files(spark, str(tmp_path / "mixed")).orderBy("zone").collect()
    assert [(r["zone"], r["day"], r["log_type"], r["batch"], r["part"], r["size"], r["partitioned"]) for r in rows] == [
        ("1002", "2024-01-01", "taskflow", 0, 0, 22, False), ("1004", "2024-01-02", "death", 3, 12, 22, True)]
    assert M.manifest(spark, str(tmp_path / "mixed")).lines().count() == 2
    (tmp_path / "empty").mkdir()
    for root in ("empty", "nowhere"):
        found = M.manifest(spark, str(tmp_path / root))
        assert found.count == 0 and found.types() == set() and found.lines().count() == 0


def test_jobs_take_the_plain_layout(spark, sf_dir, tmp_path):
    plain, routed = plain_root(spark, sf_dir), flow_root(spark, sf_dir)
    assert os.path.exists(f"{plain}/1002/2024-01-10_taskflow".removeprefix("file:"))
    both = [jobs.churn_job(spark, root, str(tmp_path / name), AS_OF) for root, name in ((plain, "a"), (routed, "b"))]
    for name in ("role_state", "features", "lost_rate", "class_feature_stats"):
        a, b = (sorted(map(repr, r[name].collect())) for r in both)
        assert a == b and a
    loaded = [jobs.load_job(spark, root, str(tmp_path / f"tables-{name}")) for root, name in ((plain, "a"), (routed, "b"))]
    assert set(loaded[0]) == set(loaded[1]) and len(loaded[0]) == 7
    a, b = (sorted(map(tuple, read_flow_table(spark, str(tmp_path / f"tables-{n}"), "death").collect())) for n in "ab")
    assert a == b and a


def test_load_takes_the_zones_it_is_told(spark, tmp_path):
    for zone in ("2001", "1004", "1002"):
        path = tmp_path / "flows" / zone / "2024-01-01_levelup"
        path.parent.mkdir(parents=True)
        path.write_text("2024-01-01 00:00:00 7 1 2 30\n2024-01-01 00:00:01 8 1 2 30\n")
    jobs.load_job(spark, str(tmp_path / "flows"), str(tmp_path / "tables"), zones=["2001", "1004"])
    rows = read_flow_table(spark, str(tmp_path / "tables"), "levelup").collect()
    assert sorted((r["zone"], r["sn"], r["roleid"]) for r in rows) == [("1004", 1, 7), ("1004", 2, 8), ("2001", 1, 7), ("2001", 2, 8)]


def test_plain_files_are_not_overwritten(spark, sf_dir):
    with pytest.raises(FileExistsError):
        write_plain(flow_lines(spark, sf_dir).where("log_type = 'levelup'"), "ord", plain_root(spark, sf_dir))


def test_flow_file_route_needs_no_sort_aggregate(spark, sf_dir):
    from rolepulse.plans import activity as A

    for root in (flow_root(spark, sf_dir), plain_root(spark, sf_dir)):
        events, created = flowfiles.activity_inputs(spark, root, AS_OF)
        plan = physical(A.role_activity(events, AS_OF, replay=True, cohort=A.stored_cohort(created, AS_OF)))
        assert "HashAggregate" in plan and "SortAggregate" not in plan
        assert "SortAggregate" not in physical(A.last_creation(created, "day", "roleid"))


def test_ranges_number_sparse_and_hot_ids(spark):
    rows = spark.range(3000).select(
        (F.col("id") * 1_000_003 * (F.col("id") % 7 + 1)).alias("role"), F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("z"), (F.col("id") % 40).cast("string"))).alias("zone"),
        F.col("id").alias("tie")).repartition(7)
    got = assign_sn(rows, order=["role", "tie"], scope=["zone"], start=spark.createDataFrame([("a", 5)], "zone string, start long"))
    for limit in (100_000, 0):
        got = assign_sn(rows, order=["role", "tie"], scope=["zone"], start=spark.createDataFrame([("a", 5)], "zone string, start long"), max_chunks=limit)
        by_zone = {}
        for r in got.collect():
            by_zone.setdefault(r["zone"], []).append((r["role"], r["tie"], r["sn"]))
        for zone, mine in by_zone.items():
            first = 6 if zone == "a" else 1
            assert [sn for _, _, sn in sorted(mine)] == list(range(first, first + len(mine)))
        assert "SinglePartition" not in physical(got)
    assert [r["sn"] for r in assign_sn(rows, order=["role", "tie"], start=3).orderBy("role", "tie").collect()] == list(range(4, 3004))
    assert assign_sn(rows.where("false"), order=["role"]).count() == 0

"""Loads that fail, are repeated, or run at the same time: every row once, dense numbers, nothing left behind."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from rolepulse import jobs
from rolepulse.sinks import flowtables
from rolepulse.sinks.flowtables import load_flow_table
from rolepulse.sinks.loadlog import LoadLog
from rolepulse.sources.manifest import manifest
from rolepulse.sources.tables import read_flow_table, table_path


def put(root, zone, day, roles):
    path = root / zone / f"{day}_levelup"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{day} 00:00:0{i % 10} {r} 1 2 30\n" for i, r in enumerate(roles)))


def rows(spark, root):
    return sorted((r["zone"], r["sn"], r["roleid"]) for r in read_flow_table(spark, str(root), "levelup").collect())


def left_behind(root):
    top = os.path.join(table_path(str(root), "levelup"), "_loads")
    return [n for d, _, names in os.walk(top) for n in names if "/log" not in d and not n.endswith(".crc")]


def test_a_failed_load_repeated_gives_each_row_once(spark, tmp_path, monkeypatch):
    flows, tables = tmp_path / "flows", tmp_path / "tables"
    put(flows, "1002", "2024-01-01", [7, 8])
    put(flows, "1004", "2024-01-01", [9])
    real = flowtables.assign_sn

    def broken(*args, **kwargs):
        return real(*args, **kwargs).withColumn("sn", F.raise_error(F.lit("lost")).cast("bigint"))

    monkeypatch.setattr(flowtables, "assign_sn", broken)
    with pytest.raises(Exception, match="lost"):
        jobs.load_job(spark, str(flows), str(tables))
    assert left_behind(tables) == []
    monkeypatch.setattr(flowtables, "assign_sn", real)
    # Another load comes in between; the numbers of the failed one stay its own.
    put(tmp_path / "other", "1002", "2024-01-02", [5])
    jobs.load_job(spark, str(tmp_path / "other"), str(tables))
    for _ in range(2):  # what is done is not done again
        jobs.load_job(spark, str(flows), str(tables))
        assert rows(spark, tables) == [("1002", 1, 7), ("1002", 2, 8), ("1002", 3, 5), ("1004", 1, 9)]
    jobs.load_job(spark, str(flows), str(tables), run="again")
    assert rows(spark, tables)[3:5] == [("1002", 4, 7), ("1002", 5, 8)] and len(rows(spark, tables)) == 7
    assert left_behind(tables) == []
    with pytest.raises(ValueError, match="reserved"):
        LoadLog(spark, table_path(str(tables), "levelup")).reserve("again", {"1002": 99}, {})


def test_loads_at_the_same_time_share_the_numbers_out(spark, tmp_path):
    tables = tmp_path / "tables"
    for n in range(3):
        put(tmp_path / f"flows{n}", "1002", f"2024-01-0{n + 1}", [10 * n + i for i in range(n + 2)])

    def load(n):
        found = manifest(spark, str(tmp_path / f"flows{n % 3}"))
        return load_flow_table(found.lines(), "levelup", str(tables), run=f"run{n % 3}")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(load, range(6)))  # each run twice
    got = rows(spark, tables)
    assert [sn for _, sn, _ in got] == list(range(1, 10))
    assert sorted(r for *_, r in got) == sorted(10 * n + i for n in range(3) for i in range(n + 2))
    for n in range(3):  # a run has its numbers in one piece
        mine = [sn for _, sn, r in got if r // 10 == n]
        assert mine == list(range(mine[0], mine[0] + n + 2))
    assert left_behind(tables) == []


def test_tables_from_before_the_log_are_numbered_on(spark, tmp_path):
    path = table_path(str(tmp_path), "levelup")
    old = spark.sql("SELECT 7L sn, timestamp_ntz '2024-01-01 00:00:00' log_time, 1L roleid, cast(1 as tinyint) profession, 2 level, 3 usetime, '1002' zone, date '2024-01-01' day")
    old.write.partitionBy("zone", "day").parquet(path + "/run=old")
    put(tmp_path / "flows", "1002", "2024-01-02", [4])
    load_flow_table(manifest(spark, str(tmp_path / "flows")).lines(), "levelup", str(tmp_path))
    assert rows(spark, tmp_path) == [("1002", 7, 1), ("1002", 8, 4)]


def test_an_empty_load(spark, tmp_path):
    put(tmp_path / "flows", "1002", "2024-01-02", [])
    jobs.load_job(spark, str(tmp_path / "flows"), str(tmp_path / "tables"))
    put(tmp_path / "flows", "1002", "2024-01-02", [3])
    jobs.load_job(spark, str(tmp_path / "flows"), str(tmp_path / "tables"))
    assert rows(spark, tmp_path / "tables") == [("1002", 1, 3)]

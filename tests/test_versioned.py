"""Bucketed tables: only touched buckets are written, versions are whole, writers do not lose each other's rows."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from rolepulse.operators.tableops import replace_into
from rolepulse.operators.versioned import BucketedTable

SCHEMA = "id long, name string, score int, day date"


def table(spark, tmp_path, buckets=16):
    return BucketedTable(spark, str(tmp_path / "table"), spark.createDataFrame([], SCHEMA).schema, ["id"], buckets)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions_equal_replacing_the_whole_table(spark, tmp_path):
    rng = random.Random(2)
    t = table(spark, tmp_path)
    whole = spark.createDataFrame([(i, f"n{i}", i, None) for i in range(300)], SCHEMA)
    t.create(whole)
    for turn in range(3):
        ids = [rng.randrange(400) for _ in range((3, 40, 0)[turn])]
        source = spark.createDataFrame([(i, rng.randrange(99), n) for n, i in enumerate(ids * 2)], "id int, score long, at int")
        before = t.version()
        after = t.replace(source, ["at"], {"name": F.lit("new")})
        whole = spark.createDataFrame(
            replace_into(whole, source, ["id"], ["at"], {"name": F.lit("new")}).collect(), SCHEMA)
        assert rows(t.read()) == rows(whole)
        touched = {r[0] for r in source.select(t.bucket()).distinct().collect()}
        same = {b for b in before.folders if after.folders.get(b) == before.folders[b]}
        assert same == set(before.folders) - touched
        assert after.number == before.number + bool(ids) and rows(t.read(before)) != rows(t.read()) or not ids
        if turn == 0:
            files = {f for f in t.read(after).inputFiles()} & {f for f in t.read(before).inputFiles()}
            assert len(files) >= 12 - 3  # untouched buckets are the same files


def test_untouched_buckets_are_not_read(spark, tmp_path):
    t = table(spark, tmp_path)
    t.create(spark.createDataFrame([(i, "x", 1, None) for i in range(200)], SCHEMA))
    some = t.read(t.version(), {3, 5})
    assert len({f.split("/_bucket=")[1].split("/")[0] for f in some.inputFiles()}) == 2
    assert 0 < some.count() < 60


def test_two_writers_at_once(spark, tmp_path):
    t = table(spark, tmp_path, 4)
    t.create(spark.createDataFrame([(i, "old", i, None) for i in range(40)], SCHEMA))

    def write(n):
        t.replace(spark.createDataFrame([(n, f"w{n}")], "id long, name string"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    got = {r["id"]: r["name"] for r in t.read().collect()}
    assert {i: got[i] for i in range(4)} == {i: f"w{i}" for i in range(4)} and len(got) == 40 and t.version().number == 4


def test_empty_tables_and_other_keys(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read().count() == 0 and t.version().number == -1
    t.create(spark.createDataFrame([], SCHEMA))
    assert t.read().count() == 0
    t.replace(spark.createDataFrame([(None, "null key"), (1, "one")], "id long, name string"))
    assert rows(t.read()) == [(1, "one", None, None), (None, "null key", None, None)]
    with pytest.raises(ValueError, match="buckets by"):
        table(spark, tmp_path, 8).version()
    with pytest.raises(FileExistsError):
        t._publish(type(t.version())(-1, {}), {})

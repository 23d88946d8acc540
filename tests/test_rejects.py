"""Lines that are not written: counted for each reason, kept where they carry a marker; one pass per training step; one scan of all types."""

import os
import re

from pyspark.sql import functions as F

from rolepulse.plans import training as T
from rolepulse.registry.base import flow_lake
from rolepulse.sinks.flowtables import load_flow_table, read_rejects
from rolepulse.sinks.routed import route_raw
from rolepulse.sources import flowfiles, formatlog
from rolepulse.sources.manifest import manifest
from rolepulse.sources.tables import read_flow_lake, read_flow_table

GOOD = "2016-11-10 00:03:00 gs1 formatlog:levelup_lo:roleid={}:level=2:zone=1:time_used=120:prof=3"


def raw(tmp_path):
    lines = [GOOD.format(1), "2016-11-10 00:04:00 gs1 formatlog:chat:roleid=11:hello", GOOD.format("x"), "formatlog:death:roleid=1", "", GOOD.format(2)]
    for name, some in (("1004/2016-11-10", lines), ("1005/2016-11-11", [GOOD.format(3)]), ("1004/tenth", [GOOD.format(4), "noise"])):
        path = tmp_path / "raw" / name / "world2.formatlog"
        path.parent.mkdir(parents=True)
        path.write_text("".join(f"{x}\n" for x in some))
    path = F.col("_metadata.file_path")
    reader = formatlog.SOURCE_ORDER  # the columns a source gives
    assert reader == ("modified", "path", "block")
    return lambda spark: spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "raw")).select(
        "value", path.alias("path"), F.unix_micros(F.col("_metadata.file_modification_time")).alias("modified"), F.col("_metadata.file_block_start").alias("block"))


def test_every_line_is_written_counted_or_kept(spark, tmp_path):
    read = raw(tmp_path)
    for name, limit in (("a", 100), ("b", 0)):  # dealt out by splits, or by ranges
        out, rejects = str(tmp_path / name), str(tmp_path / f"{name}-rejects")
        counts = route_raw(read(spark), out, batch=3, max_splits=limit, rejects=rejects)
        assert counts == {"read": 9, "written": 3, "no_marker": 3, "no_pattern": 2, "no_path": 1}
        kept = sorted((r["reason"], r["value"]) for r in spark.read.parquet(f"{rejects}/batch=3").collect())
        assert kept == [("no_path", GOOD.format(4)), ("no_pattern", GOOD.format("x")), ("no_pattern", "formatlog:death:roleid=1")]
        assert sorted(r["value"] for r in flowfiles.read_partitioned(spark, out).collect()) == [
            f"2016-11-10 00:03:00 {n} 3 2 120" for n in (1, 2, 3)]


def test_batches_without_rejects_write_none(spark, tmp_path):
    read = raw(tmp_path)
    clean = read(spark).where(F.col("path").contains("1005"))
    assert route_raw(clean, str(tmp_path / "out"), rejects=str(tmp_path / "rejects")) == {
        "read": 1, "written": 1, "no_marker": 0, "no_pattern": 0, "no_path": 0}
    assert not os.path.exists(tmp_path / "rejects")


def test_only_lines_with_a_marker_are_shuffled(spark, tmp_path):
    from rolepulse.sinks import routed

    lines = raw(tmp_path)(spark)
    dealt, n = routed.in_source_order(lines, routed.source_splits(lines), 1, 100)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert n == 9 and dealt.count() == 6
    assert plan.index("Exchange") < plan.index("Contains(value") if "Contains(value" in plan else plan.index("Exchange") < plan.index("formatlog:")
    assert dealt.rdd.getNumPartitions() == 6 and "rangepartitioning" not in plan


def test_failed_casts_are_kept_with_their_names(spark, tmp_path):
    path = tmp_path / "flows" / "1002" / "2024-01-01_levelup"
    path.parent.mkdir(parents=True)
    text = ["2024-01-01 00:00:00 7 1 2 30", "2024-01-01 00:00:01 8 300 2 30", "soon 8 1 2 30 ", "2024-01-01 00:00:02 9 1", "2024-01-01 00:00:03 5 1 2 30"]
    path.write_text("\n".join(text) + "\n")
    load_flow_table(manifest(spark, str(tmp_path / "flows")).lines(), "levelup", str(tmp_path / "tables"), run="one")
    rows = read_flow_table(spark, str(tmp_path / "tables"), "levelup").orderBy("sn").collect()
    assert [(r["sn"], r["roleid"], r["profession"], r["usetime"]) for r in rows] == [
        (1, 7, 1, 30), (2, 8, None, 30), (3, 1, 2, None), (4, 9, 1, None), (5, 5, 1, 30)]
    kept = {r["line"]: r["fields"] for r in read_rejects(spark, "levelup", str(tmp_path / "tables")).where("run = 'one' AND zone = '1002'").collect()}
    assert kept == {text[1]: ["profession"], text[2]: ["log_time", "usetime"], text[3]: ["level", "usetime"]}
    assert read_rejects(spark, "death", str(tmp_path / "tables")).count() == 0


def test_one_job_for_each_step_of_both_models(spark):
    df = spark.range(300).select((F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") * 37 % 101 / 101).alias("a"), (F.col("id") % 7 / 7).alias("b")).cache()
    df.count()
    alone = {m: T.train(df, ["a", "b"], (m,))[m] for m in T.PULLS}
    sc = spark.sparkContext
    sc.setJobGroup("both-models", "")
    both = T.train(df, ["a", "b"])
    jobs = len(sc.statusTracker().getJobIdsForGroup("both-models"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert both == alone
    assert 1 <= jobs <= 2 * T.SGD_ITERATIONS  # a job, and with adaptive execution one for its exchange, a step


def test_all_types_are_one_scan(spark, sf_dir):
    some = read_flow_lake(spark, flow_lake(spark, sf_dir), ("death", "levelup", "award"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and re.search(r"PartitionFilters: \[.*log_type", plan)
    assert {r["log_type"] for r in some.select("log_type").distinct().collect()} == {"death", "levelup", "award"}

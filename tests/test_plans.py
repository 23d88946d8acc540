"""Plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest

import __spark_entry__ as entry
from rolepulse.plans import activity as A
from rolepulse.plans import churn as C
from rolepulse.registry.base import AS_OF, flow_events, flow_root, loaded_table
from rolepulse.sources import flowfiles
from rolepulse.sources.tables import read_flow_events


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    """Plan with whole, uncut scan details."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final(df):
    """The plan adaptive execution ended with."""
    df.collect()
    return physical(df).split("\n+- == Initial Plan ==")[0]


def main_part(plan):
    """Operators of the query itself, subqueries left out."""
    return "\n".join(line for line in plan.splitlines() if "Subquery" not in line)


def test_no_python_in_any_lazy_query(spark, sf_dir):
    for name in ("role_activity", "role_activity_replay", "normalise_features_replay", "parse_death", "format_flow_line",
                 "cohort_semi_join", "replace_into", "local_to_epoch_dst", "class_feature_stats"):
        plan = physical(entry.queries()[name](spark, sf_dir))
        assert not re.search("EvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan), name


def test_role_activity_has_two_exchanges_and_hash_aggregates(spark, sf_dir):
    events = flow_events(spark, sf_dir)
    cohort = A.read_cohort(events, AS_OF)
    base = main_part(physical(cohort.select("roleid"))).count("Exchange")
    plan = main_part(physical(A.replay_state(A.cohort_role_days(A.in_range(events, AS_OF), cohort))))
    broadcasts = plan.count("BroadcastExchange")
    assert broadcasts == 1 and "LeftSemi" in plan
    assert plan.count("Exchange") - broadcasts - base == 2
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan


def test_large_cohort_is_not_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        events = flow_events(spark, sf_dir)
        plan = main_part(physical(A.role_activity(events, AS_OF, replay=True, max_rows=0)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan
    # combine, role, cohort (its own aggregate already hashes the role): no exchange past the join
    assert plan.count("Exchange hashpartitioning") == 3


def test_events_are_combined_once_for_state_and_maximum(spark, sf_dir):
    plan = final(C.labelled_features(flow_events(spark, sf_dir), AS_OF))
    assert re.search(r"ReusedExchange \[roleid#\d+L, day#\d+, kind", plan)


def test_event_filters_reach_the_scan(spark, sf_dir):
    plan = formatted(A.in_range(flow_events(spark, sf_dir, "levelup"), AS_OF).select("roleid"))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "event_type" in pushed and "GreaterThanOrEqual(ts" in pushed
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>", plan)


@pytest.mark.parametrize("source", ["files", "tables"])
def test_days_and_types_prune_folders(spark, sf_dir, source):
    if source == "files":
        plan = formatted(flowfiles.scan_range(spark, flow_root(spark, sf_dir), AS_OF, ["death"], zones=["1002"]))
        wanted = ("day", "log_type", "zone")
    else:
        loaded_table(spark, sf_dir, "death")
        from rolepulse.registry.base import table_root
        plan = formatted(A.in_range(read_flow_events(spark, table_root(spark, sf_dir), ("death",)), AS_OF))
        wanted = ("day",)
    filters = re.search(r"PartitionFilters: (.*)", plan).group(1)
    assert all(w in filters for w in wanted)


def test_maximum_is_one_broadcast_row(spark, sf_dir):
    plan = main_part(physical(entry.queries()["normalise_cross_join"](spark, sf_dir)))
    assert "BroadcastNestedLoopJoin" in plan and "CartesianProduct" not in plan


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = formatted(entry.queries()["update_from_latest"](spark, sf_dir))
    assert "struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_numbering_has_no_single_task_over_rows(spark, sf_dir):
    plan = main_part(physical(entry.queries()["assign_sn"](spark, sf_dir)))
    assert "SinglePartition" not in plan


def test_output_folders_are_rebalanced(spark):
    rows = spark.range(10).selectExpr("cast(id as string) value", "'1' zone", "'2' day", "'3' log_type")
    plan = physical(rows.hint("rebalance", "zone", "day", "log_type"))
    assert "REBALANCE" in plan

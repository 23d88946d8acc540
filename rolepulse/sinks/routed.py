"""Routed flow files: one folder per batch, zone, day and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rolepulse.layouts import RAW_TYPES
from rolepulse.operators.numbering import BROADCAST_CHUNKS
from rolepulse.sources.formatlog import SOURCE_ORDER, TASK_ACTION, classify, flow_line, has_marker, parse, path_zone, with_path_fields

# Lines with a marker that one task parses, sorts and writes; a split is not cut.
ROWS_PER_TASK = 2_000_000

ROUTE = ("zone", "day", "log_type")


def routed_lines(parsed: DataFrame, *carried: str) -> DataFrame:
    """Parsed records with a path match, rendered: columns value, zone, day, log_type, and ``carried`` ones.

    Zone and day come from the file path, so a late line follows its file, not its clock.
    """
    return parsed.where(F.col("log_type").isin(list(RAW_TYPES))).select(
        flow_line(F.col("log_type")).alias("value"), *ROUTE, *carried
    )


def _write(sorted_lines: DataFrame, path: str, batch: int) -> None:
    # Repeating a batch replaces its own folder and no other; a whole folder is moved into place at commit.
    (
        sorted_lines.select("value", *ROUTE).write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(*ROUTE).text(f"{path}/batch={batch}")
    )


def write_routed_in_order(lines: DataFrame, order: str, path: str, batch: int = 0) -> None:
    """Write flow lines as one batch, in line order by ``order`` (unique per line).

    Range partitioning on (folder, order) cuts a hot folder into several files,
    numbered in line order. Lines of a higher batch come after those of a lower one.
    """
    keys = [F.col(c) for c in (*ROUTE, order)]
    _write(lines.repartitionByRange(*keys).sortWithinPartitions(*keys), path, batch)


def source_splits(lines: DataFrame) -> DataFrame:
    """One row per split of the source: SOURCE_ORDER, lines ``n``, and ``marked`` ones that may match a pattern."""
    return lines.groupBy(*SOURCE_ORDER).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(has_marker(F.col("value"))).alias("marked"))


def in_source_order(lines: DataFrame, splits: DataFrame, rows_per_task: int, max_splits: int) -> tuple[DataFrame, int]:
    """The marked lines, dealt out to tasks by whole splits in source order, and the number of all lines.

    Only marked lines are shuffled. With more splits than can be copied to every executor, their
    order is found by a range partitioning.
    """
    marked = lines.where(has_marker(F.col("value"))).withColumn("row", F.monotonically_increasing_id())
    found = splits.limit(max_splits + 1).collect()
    if len(found) > max_splits:
        return marked.repartitionByRange(*SOURCE_ORDER, "row"), splits.agg(F.sum("n")).first()[0]
    # A small batch is still shared out to all cores.
    total = sum(r["marked"] for r in found)
    rows_per_task = max(1, min(rows_per_task, -(-total // lines.sparkSession.sparkContext.defaultParallelism)))
    placed, before = [], 0
    for r in sorted(found, key=lambda r: [r[c] for c in SOURCE_ORDER]):
        placed.append((*[r[c] for c in SOURCE_ORDER], before // rows_per_task))
        before += r["marked"]
    tasks = max(1, -(-before // rows_per_task))
    schema = ", ".join(f"{c} {splits.schema[c].dataType.simpleString()}" for c in SOURCE_ORDER)
    task = lines.sparkSession.createDataFrame(placed, f"{schema}, task int")
    dealt = marked.join(F.broadcast(task), list(SOURCE_ORDER)).repartitionById(tasks, F.least("task", F.lit(tasks - 1)))
    return dealt.drop("task"), sum(r["n"] for r in found)


# Why a line is not written: no marker of any kind, a marker but no pattern, no zone and day in its path.
NO_MARKER, NO_PATTERN, NO_PATH = "no_marker", "no_pattern", "no_path"


def with_reason(lines: DataFrame, task_action: str = TASK_ACTION) -> DataFrame:
    """The classified lines with the ``reason`` why they are rejected, NULL for those that are written."""
    found = classify(lines, task_action)
    return found.withColumn("reason", F.when(F.col("kind").isNull(), NO_PATTERN).when(path_zone(F.col("path")) == "", NO_PATH))


def route_raw(
    lines: DataFrame, path: str, batch: int = 0, task_action: str = TASK_ACTION, rows_per_task: int = ROWS_PER_TASK,
    max_splits: int = BROADCAST_CHUNKS, rejects: str | None = None,
) -> dict[str, int]:
    """Parse raw lines and write what matches as one batch; returns the lines read, written and not written for each reason.

    A first pass counts the lines of each split and those with a marker of some kind. Only
    these go through the exchange that puts whole splits in source order, so what is shuffled
    follows the lines that match; the patterns run once per line, after it. Files are numbered in source order.

    Lines with a marker that are not written go to ``rejects``, a Parquet folder with the batch as
    its folders, if it is named and the batch has any; those without a marker are only counted.
    """
    written, failed = Observation(), Observation()
    dealt, read = in_source_order(lines, source_splits(lines), rows_per_task, max_splits)
    order = [*SOURCE_ORDER, "row"]
    one = F.lit(1)
    parsed = parse(dealt.observe(failed, F.count(one).alias("marked")), task_action)
    matched = Observation()
    placed = with_path_fields(parsed.observe(matched, F.count(one).alias("n")))
    routed = routed_lines(placed, *order).observe(written, F.count(one).alias("n"))
    _write(routed.sortWithinPartitions(*ROUTE, *order), path, batch)
    marked, hits, out = failed.get["marked"], matched.get["n"], written.get["n"]
    counts = {"read": read or 0, "written": out, NO_MARKER: (read or 0) - marked, NO_PATTERN: marked - hits, NO_PATH: hits - out}
    if rejects is not None and marked > out:
        bad = with_reason(lines.where(has_marker(F.col("value"))), task_action).where("reason IS NOT NULL")
        bad.select("value", "path", "reason").write.mode("overwrite").parquet(f"{rejects}/batch={batch}")
    return counts

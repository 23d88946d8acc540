"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolepulse.operators.joins import fits_broadcast
from rolepulse.session import materialise

# Chunks whose offsets we are willing to copy to every executor (a path and two numbers each).
BROADCAST_CHUNKS = 100_000


def chunk_offsets(cut: DataFrame, scope: list[str], names: list[str], start: DataFrame | int,
                  position: Column | None = None) -> DataFrame:
    """One row per chunk: how many numbers its scope has used before it."""
    stats = [F.count(F.lit(1)).alias("_n")]
    if position is not None:
        stats += [F.min(position).alias("_first"), F.max(position).alias("_last")]
    counts = cut.groupBy(*scope, *names).agg(*stats)
    # Sequential, but over one row per chunk only.
    before = (Window.partitionBy(*scope) if scope else Window).orderBy(*names).rowsBetween(
        Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_n").over(before), F.lit(0))
    offsets = counts.withColumn("_base", base)
    offsets = _with_start(offsets, scope, start)
    if position is not None:
        gap = F.raise_error(F.lit("positions inside a chunk are not contiguous")).cast("bigint")
        whole = F.col("_last") - F.col("_first") + 1 == F.col("_n")
        offsets = offsets.withColumn("_base", F.when(whole, F.col("_base") - F.col("_first") + 1).otherwise(gap))
    return offsets.select(*scope, *names, "_base")


# An id of monotonically_increasing_id: partition above, row of the partition below.
_ROW_BITS = 33


def range_numbered(
    df: DataFrame, order: list[str], scope: list[str] | None = None, start: DataFrame | int = 0, name: str = "sn",
    max_chunks: int = BROADCAST_CHUNKS,
) -> DataFrame:
    """Number the rows of each ``scope`` 1, 2, 3, … in ``order``, whatever their values are.

    Rows are partitioned by range on (scope, order), sorted inside their partition and written
    as a table with their place in it. What is summed up in sequence is one count for each
    partition and scope in it, so at most as many rows as there are partitions and scopes.
    """
    scope = scope or []
    keys = [*scope, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    table = materialise(placed, "numbered").withColumns({
        "_part": F.shiftright("_id", _ROW_BITS), "_row": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}).drop("_id")
    runs = table.groupBy(*scope, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    if scope:
        before = Window.partitionBy(*scope).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    else:
        # One row per partition.
        base, rows = 0, []
        for r in sorted(runs.collect(), key=lambda r: r["_part"]):
            rows.append((r["_part"], r["_first"], base))
            base += r["_n"]
        offsets = df.sparkSession.createDataFrame(rows, "_part bigint, _first bigint, _base bigint")
    offsets = _with_start(offsets, scope, start).select(*scope, "_part", (F.col("_base") - F.col("_first") + 1).alias("_base"))
    if not scope or fits_broadcast(offsets, max_chunks):
        offsets = F.broadcast(offsets)
    return table.join(offsets, [*scope, "_part"]).select((F.col("_base") + F.col("_row")).cast("bigint").alias(name), *df.columns)


def _with_start(offsets: DataFrame, scope: list[str], start: DataFrame | int) -> DataFrame:
    if not isinstance(start, DataFrame):
        return offsets.withColumn("_base", F.col("_base") + F.lit(start))
    # One row per scope.
    return offsets.join(F.broadcast(start), scope, "left").withColumn(
        "_base", F.col("_base") + F.coalesce("start", F.lit(0))).drop("start")


def assign_sn(
    df: DataFrame, order: list[str], chunk: list[Column] | None = None, scope: list[str] | None = None,
    start: DataFrame | int = 0, name: str = "sn", position: Column | None = None,
    max_chunks: int = BROADCAST_CHUNKS,
) -> DataFrame:
    """Number the rows of each ``scope`` 1, 2, 3, … in ``order``.

    Without ``chunk`` they are numbered by ranges (:func:`range_numbered`).
    ``chunk`` are expressions that follow ``order`` and cut a scope into pieces of
    bounded size (a file split, a block of ids). Rows are numbered inside their
    chunk in parallel; only one count per chunk is summed up in sequence. Where
    rows already carry a gap-free ``position`` inside their chunk, they are numbered
    where they lie, without a shuffle as long as the offsets can be broadcast.
    ``start`` is the last number in use, or a table (scope columns, ``start``) of them.

    The input is read twice, so it must be stable: a table, not a sampled plan.
    """
    if chunk is None:
        return range_numbered(df, order, scope, start, name, max_chunks)
    scope = scope or []
    names = [f"_c{i}" for i in range(len(chunk))]
    cut = df.withColumns(dict(zip(names, chunk)))
    offsets = chunk_offsets(cut, scope, names, start, position)
    if position is not None:
        if fits_broadcast(offsets, max_chunks):
            offsets = F.broadcast(offsets)
        number = F.col("_base") + position
    else:
        cut = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*scope, *names).orderBy(*order)))
        # The window already hashes rows by chunk, so the join moves only the offsets.
        number = F.col("_base") + F.col("_rn")
    numbered = cut.join(offsets, [*scope, *names])
    return numbered.select(number.cast("bigint").alias(name), *df.columns)


def id_blocks(column: str, size: int = 1 << 18) -> list[Column]:
    """Chunks of a unique integer column: at most ``size`` rows each."""
    return [F.floor(F.col(column) / size)]

"""Joins: cohort membership, both sides of a death, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a one-column key table we are willing to copy to every executor
# (about 100 MB as a hashed relation).
BROADCAST_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the real row count, taken by one distributed count, is within the bound."""
    return df.count() <= max_rows


def semi_join_keys(rows: DataFrame, keys: DataFrame, on: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key occurs in ``keys``.

    A key set whose size was checked is broadcast: no shuffle, no skew. A larger
    one is joined by shuffle, where adaptive execution splits a hot key.
    """
    keys = keys.select(on)
    if fits_broadcast(keys, max_rows):
        keys = F.broadcast(keys)
    return rows.join(keys, on, "left_semi")


def death_sides(deaths: DataFrame) -> DataFrame:
    """Each death as two rows in one pass: ``side`` killed (the victim) and killer."""
    sides = F.array(
        F.struct(F.lit("killed").alias("side"), F.col("roleid").alias("role")),
        F.struct(F.lit("killer").alias("side"), F.col("killer").alias("role")),
    )
    rest = [c for c in deaths.columns if c != "roleid"]
    return deaths.select(F.inline(sides), *rest).withColumnRenamed("role", "roleid")


def update_from_lookup(
    target: DataFrame, lookup: DataFrame, target_key: str, lookup_key: str, value: str, set_column: str
) -> DataFrame:
    """Set ``set_column`` to the looked-up value: NULL when unmatched, an error when a used code is ambiguous."""
    unique = lookup.groupBy(F.col(lookup_key).alias("_code")).agg(
        F.first(value).alias("_value"), F.count(F.lit(1)).alias("_matches"))
    picked = F.when(
        F.col("_matches") > 1,
        F.raise_error(F.concat(F.lit("more than one match for code "), F.col("_code").cast("string")))
        .cast(lookup.schema[value].dataType),
    ).otherwise(F.col("_value"))
    keep = [picked.alias(c) if c == set_column else F.col(c) for c in target.columns]
    if set_column not in target.columns:
        keep.append(picked.alias(set_column))
    return target.join(unique, F.col(target_key) == F.col("_code"), "left").select(*keep)


def _update_from(target, source, key, source_key, value, set_column, pick) -> DataFrame:
    found = source.groupBy(F.col(source_key).alias("_key")).agg(pick(value).alias("_value"))
    keep = [F.col("_value").alias(c) if c == set_column else F.col(c) for c in target.columns]
    return target.join(found, F.col(key) == F.col("_key"), "left").select(*keep)


def update_from_latest(
    target: DataFrame, source: DataFrame, key: str, source_key: str, value: str, set_column: str
) -> DataFrame:
    """Set ``set_column`` to the largest related ``value``, NULL without one.

    The source shrinks to one row per key before it is joined, so a hot key costs nothing.
    """
    return _update_from(target, source, key, source_key, value, set_column, F.max)


def update_from_earliest(
    target: DataFrame, source: DataFrame, key: str, source_key: str, value: str, set_column: str
) -> DataFrame:
    """Set ``set_column`` to the smallest related ``value``, NULL without one."""
    return _update_from(target, source, key, source_key, value, set_column, F.min)

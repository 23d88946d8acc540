"""Flow files: one space-separated text file per zone, day and type.

Two layouts are understood, and which files there are comes from a manifest of them: the plain
one, ``<root>/<zone>/<day>_<type>``, whose files are read by name, and the partitioned one this
package writes, ``<root>/batch=…/zone=…/day=…/log_type=…``, read with partition pruning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.functions.text import name_type
from rolepulse.layouts import FLOW_FIELDS, RANGE_END, RANGE_START, REPLAY_ORDER, VALID_ZONES, check_type
from rolepulse.sources.manifest import Manifest, list_files, manifest, valid_zone


def as_date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def day_range(as_of: str | dt.date, start: int = RANGE_START, end: int = RANGE_END) -> list[str]:
    """Days ``as_of + start … as_of + end``, both included."""
    base = as_date(as_of)
    return [(base + dt.timedelta(days=n)).isoformat() for n in range(start, end + 1)]


def read_partitioned(
    spark: SparkSession, root: str, types: Iterable[str] | None = None, days: tuple[str, str] | None = None,
    zones: Iterable[str] | None = None, files: Manifest | None = None,
) -> DataFrame:
    """Lines of the partitioned layout with zone, day, log_type and their line order.

    Types, days (first and last) and zones prune folders. ``files`` is the manifest of the root, if it is known.
    """
    wanted = (files or manifest(spark, root, zones)).only(zones, types, days)
    return wanted.ordered(wanted.folders())


def list_partitions(spark: SparkSession, root: str) -> DataFrame:
    """zone, day, log_type of every flow file, from names only."""
    return list_files(spark, root).select("zone", "day", "log_type")


def read_plain(
    spark: SparkSession, root: str, days: Iterable[str], types: Iterable[str], zones: Iterable[str] = VALID_ZONES
) -> DataFrame:
    """Lines of the plain layout on the given days. Files that do not exist are skipped."""
    found = manifest(spark, root, zones).only(types=types)
    return replace(found, files=found.files.where(F.col("day").isin(list(days)) & ~F.col("partitioned"))).lines()


def scan_range(
    spark: SparkSession, root: str, as_of: str | dt.date, types: Iterable[str], start: int = RANGE_START,
    end: int = RANGE_END, zones: Iterable[str] | None = None,
) -> DataFrame:
    """Lines of the wanted types on the days ``as_of + start … as_of + end``; other folders are not read."""
    days = day_range(as_of, start, end)
    return read_partitioned(spark, root, types, (days[0], days[-1]), zones)


def activity_inputs(
    spark: SparkSession, root: str, as_of: str | dt.date, zones: Iterable[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Events from the first day with created roles to the end of the range, and the roles created on that day.

    The root is listed once, whatever its layout. The day comes from the file names of the wanted
    zones alone; one date returns to the driver.
    """
    files = manifest(spark, root, zones)
    first = first_available_day(files.files, as_of).first()["day"] or ""
    events = files.only(types=REPLAY_ORDER, days=(first, day_range(as_of)[-1] if first else "")).lines()
    created = files.only(types=["createrole"], days=(first, first)).lines()
    return typed_events(events), typed_events(created)


def first_available_day(
    partitions: DataFrame, as_of: str | dt.date, start: int = RANGE_START, end: int = RANGE_END
) -> DataFrame:
    """One row ``day``: the earliest in-range day that has a createrole file, NULL if none."""
    days = day_range(as_of, start, end)
    return partitions.where(
        (F.col("log_type") == "createrole") & F.col("day").between(days[0], days[-1])
    ).agg(F.min("day").alias("day"))


def discover(spark: SparkSession, root: str, zones: Iterable[str] = VALID_ZONES) -> DataFrame:
    """Files per (zone, type) of the plain layout, sorted by name. Only file names are read."""
    return group_files(list_files(spark, root).where(~F.col("partitioned")).select("zone", "name"), zones)


def group_files(files: DataFrame, zones: Iterable[str] = VALID_ZONES) -> DataFrame:
    """Group (zone, name) rows by zone and type, names sorted; names without ``_`` are skipped.

    A group holds one name per day, so its list is bounded by the number of days kept.
    """
    named = files.where(valid_zone(F.col("zone"), zones) & name_type(F.col("name")).isNotNull())
    return named.groupBy("zone", name_type(F.col("name")).alias("log_type")).agg(
        F.sort_array(F.collect_set("name")).alias("file_list")
    )


def loader_fields(line: Column) -> Column:
    """Split on single spaces after dropping the line end; double spaces give empty fields."""
    return F.split(F.regexp_replace(line, r"^\n+|\n+$", ""), " ")


def feature_fields(line: Column) -> Column:
    """Split on any run of white space."""
    return F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")


def merge_date_time(fields: Column) -> Column:
    """Fields 0 and 1 as one wall clock."""
    return F.concat_ws(" ", F.get(fields, F.lit(0)), F.get(fields, F.lit(1))).try_cast("timestamp_ntz")


def typed(lines: DataFrame, log_type: str, split=feature_fields) -> DataFrame:
    """Typed columns of one flow type from ``value`` lines; other columns are carried along."""
    fields = FLOW_FIELDS[check_type(log_type)]
    cut = lines.withColumn("_f", split(F.col("value")))
    cols = [F.get("_f", F.lit(i + 2)).try_cast(t).alias(n) for i, (n, t) in enumerate(fields)]
    carried = [c for c in lines.columns if c not in ("value", "_f")]
    return cut.select(*carried, merge_date_time(F.col("_f")).alias("log_time"), *cols)


def failed_fields(log_type: str, fields: Column) -> Column:
    """Names of the fields of a cut line that are missing or not of their type, ``log_time`` for its clock."""
    tries = [F.when(merge_date_time(fields).isNull(), "log_time")]
    for i, (name, kind) in enumerate(FLOW_FIELDS[check_type(log_type)]):
        tries.append(F.when(F.get(fields, F.lit(i + 2)).try_cast(kind).isNull(), name))
    return F.filter(F.array(*tries), lambda n: n.isNotNull())


def typed_events(lines: DataFrame) -> DataFrame:
    """All flow types in one pass, as the common event shape (fields of other types are NULL)."""
    cut = lines.withColumn("_f", feature_fields(F.col("value")))
    where: dict[str, list[tuple[str, int]]] = {}
    kinds: dict[str, str] = {}
    for name, fields in FLOW_FIELDS.items():
        for i, (column, kind) in enumerate(fields):
            where.setdefault(column, []).append((name, i + 2))
            kinds[column] = kind
    cols = []
    for column, places in where.items():
        out = None
        for name, i in places:
            hit, value = F.col("log_type") == name, F.get("_f", F.lit(i))
            out = F.when(hit, value) if out is None else out.when(hit, value)
        cols.append(out.try_cast(kinds[column]).alias(column))
    return cut.select(
        "zone", F.col("day").cast("date").alias("day"), "log_type", "ord",
        merge_date_time(F.col("_f")).alias("log_time"), *cols,
    )

"""What flow files there are: one row per file, from one listing, with its place in the line order.

Both layouts are understood: the plain one, ``<root>/<zone>/<day>_<type>``, and the
partitioned one this package writes, ``<root>/batch=…/zone=…/day=…/log_type=…/part-…``.
Reading is driven by the listing: only files it holds are opened, and every line gets one
64-bit order number from its file's place.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.functions.text import name_date, name_type
from rolepulse.layouts import VALID_ZONES, check_type
from rolepulse.operators.numbering import assign_sn

# Files whose places are copied to every executor, and ranked on the driver (a path and a few numbers each).
BROADCAST_FILES = 100_000
# An order number: the slot of a split above, the row of a task below.
ROW_BITS = 30
_ID_BITS = 33

LINES = "value string, zone string, day string, log_type string, ord bigint"
_FILES = ("path string, uri string, name string, zone string, day string, log_type string, batch bigint, part bigint, size bigint, "
          "modified timestamp, partitioned boolean")
# Lines of a folder are ordered by batch and part; the numbers are compared, not their text.
_ORDER = ["zone", "day", "log_type", "batch", "part", "path"]


def valid_zone(zone: Column, zones: Iterable[str] = VALID_ZONES) -> Column:
    return zone.cast("string").isin(list(zones))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every flow file below ``root``; files of neither layout are left out. No file is opened."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _FILES)
    # ``path`` is what a reader takes, ``uri`` how lines name their file.
    path = F.col("path")
    part = lambda pattern: F.regexp_extract(path, pattern, 1)
    number = lambda pattern: F.coalesce(part(pattern).try_cast("bigint"), F.lit(0))
    folder = r"/zone=([^/]+)/day=([^/]+)/log_type=([^/]+)/[^/]+$"
    partitioned = path.rlike(folder)
    name = F.substring_index(path, "/", -1)
    either = lambda i, plain: F.when(partitioned, F.regexp_extract(path, folder, i)).otherwise(plain)
    return found.select(
        "path", F.col("_metadata.file_path").alias("uri"), name.alias("name"), either(1, F.element_at(F.split(path, "/"), -2)).alias("zone"),
        either(2, name_date(name)).alias("day"), either(3, name_type(name)).alias("log_type"),
        number(r"/batch=(\d+)/").alias("batch"), number(r"/part-(\d+)[^/]*$").alias("part"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"), partitioned.alias("partitioned"),
    ).where(F.col("log_type").isNotNull())


@dataclass(frozen=True)
class Manifest:
    """The flow files of a root: ``files`` with ``rank`` (1, 2, 3, … in line order) and ``slot``, and how many there are.

    A file takes one slot for each ``slot_bytes`` begun, so that the slots of all splits of all
    files are different and rise in line order, up to 2^33 of them.
    """

    spark: SparkSession
    root: str
    files: DataFrame
    count: int
    slot_bytes: int
    wanted: tuple[Column, ...] = ()

    def only(self, zones: Iterable[str] | None = None, types: Iterable[str] | None = None,
             days: tuple[str, str] | None = None) -> Manifest:
        """The files of some zones and types and of the days from first to last."""
        wanted = self.wanted + folder_filters(zones, types, days)
        files = self.files
        for keep in wanted[len(self.wanted):]:
            files = files.where(keep)
        return replace(self, files=files, wanted=wanted)

    def types(self) -> set[str]:
        return {r["log_type"] for r in self.files.select("log_type").distinct().collect()}

    def fingerprint(self) -> str:
        """A name for what the files hold: the same until a file comes, goes or changes."""
        each = F.xxhash64("uri", "size", "modified").cast("decimal(38,0)")
        row = self.files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(each), F.lit(0)).alias("total")).first()
        return f"{row['n']}-{int(row['total']) % (1 << 64):016x}"

    def lines(self) -> DataFrame:
        """Their lines: value, zone, day, log_type, ord.

        The files are opened by name. With more of them than fit a list of names, the root is
        read: its folders are pruned where it has the partitioned layout.
        """
        named = self.files.select("path", "partitioned").limit(BROADCAST_FILES + 1).collect()
        if not named:
            return self.spark.createDataFrame([], LINES)
        if len(named) <= BROADCAST_FILES:
            return self.ordered(self.spark.read.text([r["path"] for r in named]))
        if not all(r["partitioned"] for r in named):
            return self.ordered(self.spark.read.option("recursiveFileLookup", "true").text(self.root))
        return self.ordered(self.folders())

    def folders(self) -> DataFrame:
        """The text of a partitioned root, its folders pruned by the filters of this manifest."""
        text = self.spark.read.schema("value string, zone string, day string, log_type string").text(self.root)
        for keep in self.wanted:
            text = text.where(keep)
        return text

    def ordered(self, text: DataFrame) -> DataFrame:
        """LINES of text files as they are read; those the manifest does not list are left out."""
        # Both are taken where the file is read; rows rise inside a split, and a split is read by one task.
        at = F.col("_metadata.file_block_start")
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ID_BITS) - 1))
        read = text.select("value", F.col("_metadata.file_path").alias("uri"), at.alias("_at"), row.alias("_row"))
        files = self.files.select("uri", "zone", "day", "log_type", "slot")
        files = F.broadcast(files) if self.count <= BROADCAST_FILES else files
        return read.join(files, "uri").select(
            "value", "zone", "day", "log_type", order_number(F.col("slot"), F.col("_at"), F.col("_row"), self.slot_bytes).alias("ord"))


def folder_filters(zones: Iterable[str] | None, types: Iterable[str] | None, days: tuple[str, str] | None) -> tuple[Column, ...]:
    """Filters on ``zone``, ``log_type`` and ``day`` for what is given."""
    out = []
    if zones is not None:
        out.append(valid_zone(F.col("zone"), zones))
    if types is not None:
        out.append(F.col("log_type").isin([check_type(t) for t in types]))
    if days is not None:
        out.append(F.col("day").between(*days))
    return tuple(out)


def order_number(slot: Column, at: Column, row: Column, slot_bytes: int) -> Column:
    """One number in line order: the slot of the split that starts at byte ``at``, then the row of the task."""
    split = slot + F.floor(at / slot_bytes)
    too_many = F.raise_error(F.lit("too many splits or rows for an order number")).cast("bigint")
    fits = (row < 1 << ROW_BITS) & (split < 1 << (63 - ROW_BITS))
    return F.when(fits, F.shiftleft(split, ROW_BITS).bitwiseOR(row)).otherwise(too_many)


def split_of(ord: Column) -> Column:
    """The split of an order number."""
    return F.shiftright(ord, ROW_BITS)


def row_of(ord: Column) -> Column:
    return ord.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def least_split_bytes(spark: SparkSession) -> int:
    """No split of a file that goes on is shorter than this."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return max(1, min(size(spark.conf.get(f"spark.sql.files.{name}")) for name in ("maxPartitionBytes", "openCostInBytes")))


def manifest(spark: SparkSession, root: str, zones: Iterable[str] | None = None) -> Manifest:
    """List ``root`` once and rank its files.

    Up to BROADCAST_FILES files are ranked on the driver, which lists them anyway; more by ranges.
    """
    found = list_files(spark, root)
    if zones is not None:
        found = found.where(valid_zone(F.col("zone"), zones))
    slot_bytes = least_split_bytes(spark)
    slots = F.floor(F.col("size") / slot_bytes) + 1
    rows = found.withColumn("slots", slots).limit(BROADCAST_FILES + 1).collect()
    if len(rows) <= BROADCAST_FILES:
        placed, slot = [], 0
        for rank, r in enumerate(sorted(rows, key=lambda r: [r[c] for c in _ORDER]), 1):
            placed.append((*r[:-1], rank, slot))
            slot += r["slots"]
        files = spark.createDataFrame(placed, f"{_FILES}, rank bigint, slot bigint")
        return Manifest(spark, root, files, len(rows), slot_bytes)
    return _ranked_by_ranges(spark, root, found.withColumn("slots", slots), slot_bytes)


def _ranked_by_ranges(spark: SparkSession, root: str, found: DataFrame, slot_bytes: int) -> Manifest:
    """Every slot of every file is a row that is numbered; a file keeps its first number."""
    each = found.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).drop("slots")
    numbered = assign_sn(each, order=[*_ORDER, "_slot"], name="slot").where("_slot = 0").drop("_slot")
    files = assign_sn(numbered, order=["slot"], name="rank").select(*found.drop("slots").columns, "rank", F.col("slot") - 1)
    files = files.toDF(*found.drop("slots").columns, "rank", "slot")
    return Manifest(spark, root, files, files.count(), slot_bytes)

"""Flow files of the plain layout: ``<root>/<zone>/<day>_<type>``, one file each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.session import work_path
from rolepulse.sources.manifest import list_files

FILE = ("zone", "day", "log_type")


def write_plain(lines: DataFrame, order: str, root: str, separator: str = "_") -> None:
    """Write flow lines (``value``, zone, day, log_type and a unique ``order``) as plain files.

    The layout has one file for each zone, day and type, so one task writes it, whatever its size;
    the partitioned layout cuts it. Files are written aside and moved into place one by one, which
    changes names only. A file that is there already is an error.
    """
    spark = lines.sparkSession
    aside = work_path(spark, "plain")
    (
        lines.repartition(*FILE).sortWithinPartitions(*FILE, order).select("value", *FILE)
        .write.option("maxRecordsPerFile", 0).partitionBy(*FILE).text(aside)
    )
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    # One row per file.
    for f in list_files(spark, aside).select("path", *FILE).collect():
        target = path(f"{root}/{f['zone']}/{f['day']}{separator}{f['log_type']}")
        store.mkdirs(target.getParent())
        if store.exists(target) or not store.rename(path(f["path"]), target):
            raise FileExistsError(f"could not move a flow file to {target.toString()}")


def first_lines(lines: DataFrame, order: str) -> DataFrame:
    """The first line of each file."""
    return lines.groupBy(*FILE).agg(F.min_by("value", order).alias("value"), F.min(order).alias(order))

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold from a laptop to a large cluster; sizes stay with the caller.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_dirs: dict[str, str] = {}


def local_session(cores: str = "8", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and benches on one machine."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("rolepulse")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="rolepulse-")
    return _local_dirs[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below :func:`work_root`."""
    return os.path.join(work_root(spark), "rolepulse", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Raw log stream to routed flow files.

Stateless: a line is parsed, rendered and written to the folder its file path
names, so late lines need no watermark. Offsets live in the checkpoint. A batch
writes a folder of its own number and replaces it when it is repeated after a
crash, so every line appears once, and readers take batches in their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rolepulse.layouts import RAW_FILE, RAW_ZONES
from rolepulse.session import work_path
from rolepulse.sinks.routed import route_raw
from rolepulse.sources.formatlog import TASK_ACTION, read_growing_stream, read_raw_stream
from rolepulse.sources.growing import MAX_BYTES

# Files per micro-batch: a large backlog is worked off in steps that each commit.
MAX_FILES = 10_000


def start_ingest(
    spark: SparkSession, raw: str, out: str, checkpoint: str, once: bool = True, interval: str = "1 minute",
    max_files: int | None = MAX_FILES, task_action: str = TASK_ACTION, file_name: str = RAW_FILE,
    zones: Iterable[str] = RAW_ZONES, on_batch: Callable[[int, dict[str, int]], None] | None = None,
    growing: bool = False, max_bytes: int = MAX_BYTES, idle: float | None = None, rejects: str | None = None,
) -> StreamingQuery:
    """Start the ingest; ``once`` works off what is there and stops.

    Files are read as a whole, once each, at most ``max_files`` in a batch; or, if they are
    ``growing``, followed line by line, at most ``max_bytes`` in a batch (``idle``: see
    :mod:`rolepulse.sources.growing`). A checkpoint belongs to one of the two. Of growing files, a
    run with ``once`` takes one batch; :func:`run_once` takes all.

    ``on_batch`` gets the number of each batch and its counts of lines ``read``, ``written``, and
    not written for each reason. Lines that carry a kind's marker and are not written go to ``rejects``.
    """
    def handle(lines, batch: int) -> None:
        counts = route_raw(lines, out, batch, task_action, rejects=rejects)
        if on_batch is not None:
            on_batch(batch, counts)

    if growing:
        lines = read_growing_stream(spark, raw, file_name, zones, max_bytes=max_bytes, idle=idle)
    else:
        lines = read_raw_stream(spark, raw, max_files, file_name, zones)
    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def run_once(spark: SparkSession, raw: str, out: str, checkpoint: str, **options) -> dict[str, int]:
    """Work off what is new (options of :func:`start_ingest`) and return how many lines were read and written."""
    total = {"read": 0, "written": 0}
    batches: list[int] = []

    def add(batch: int, counts: dict[str, int]) -> None:
        batches.append(batch)
        for name in total:
            total[name] += counts[name]

    while True:
        done = len(batches)
        start_ingest(spark, raw, out, checkpoint, once=True, on_batch=add, **options).awaitTermination()
        if not options.get("growing") or len(batches) == done:
            return total


def replay(spark: SparkSession, raw: str, **options) -> str:
    """Process everything again into a new output with a new checkpoint; old ones stay."""
    out = work_path(spark, "replay")
    run_once(spark, raw, out, out + "-checkpoint", **options)
    return out

"""Following raw logs while they grow: a stream of the lines appended since the last batch.

The offset of the stream is a map from file to byte position, kept in the checkpoint like any
other. A batch ends each file behind a line end, so half a line at the end of a file waits
until it is whole; every line comes once, in the order of its file. A batch takes a bounded
number of bytes, oldest files first, and is cut into pieces that are read in parallel.

A file is known by its path and a hash of its first bytes. If the path holds another beginning, or
less than was read, the file was rotated: what was not read of it is looked for under the other
names of the folder, and the new file starts at its first byte. A file that has not changed for
``idle`` seconds is taken as ended: its last line needs no line end.

Listing and reading go through Arrow's file systems (local, HDFS, S3, …), since stream readers run
in Python processes without a JVM.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
import re
import time
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "value string, path string, modified bigint, block bigint"
# First bytes of a file that name it, besides its folder.
HEAD_BYTES = 4096
# Bytes of a batch, of a piece that one task reads, and of a read.
MAX_BYTES = 16 << 30
PIECE_BYTES = 64 << 20
READ_BYTES = 4 << 20
# Files that are gone are remembered for so many seconds since their last change.
REMEMBERED = 7 * 86400


class Entry(dict):
    """What the offset holds of a file: bytes ``done`` before the batch and ``to`` its end, ``head`` and its hash, ``modified`` (microseconds)."""

    def __init__(self, done: int, to: int, head: int, hash: str, modified: int):
        super().__init__(done=done, to=to, head=head, hash=hash, modified=modified)


def opened_store(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if re.match(r"file:/", root):
        root = "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def head_hash(file, size: int) -> str:
    return hashlib.sha256(file.read_at(size, 0)).hexdigest()[:32]


def same_beginning(store: fs.FileSystem, path: str, size: int, entry: dict) -> bool:
    """Whether a file begins like the one of an entry and holds at least what was read of it."""
    if size < entry["to"]:
        return False
    with store.open_input_file(path) as f:
        return head_hash(f, entry["head"]) == entry["hash"]


def line_end(file, start: int, limit: int, size: int) -> int:
    """Behind the last line end up to ``limit``; without one, behind the first that follows; ``start`` if there is none at all."""
    at = limit
    while at > start:
        low = max(start, at - READ_BYTES)
        found = file.read_at(at - low, low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    at = limit
    while at < size:
        block = file.read_at(min(READ_BYTES, size - at), at)
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return start


def lines_between(file, start: int, end: int, first: int, last: int) -> Iterator[list[bytes]]:
    """The lines that start in [start, end) of a stretch first … last of whole lines, a block at a time.

    A piece that begins inside a line leaves it to the piece before; its own last line may go on behind its end.
    """
    at, held = start, b""
    if start > first:
        at = start - 1
        while at < last:  # to the first line start at or behind ``start``
            block = file.read_at(min(READ_BYTES, last - at), at)
            found = block.find(b"\n")
            at += found + 1 if found >= 0 else len(block)
            if found >= 0:
                break
    begins = at  # of the line in ``held``
    while begins < end and at < last:
        block = file.read_at(min(READ_BYTES, last - at), at)
        at += len(block)
        *whole, rest = block.split(b"\n")
        if whole:
            whole[0] = held + whole[0]
            out = []
            for line in whole:
                if begins >= end:
                    break
                out.append(line)
                begins += len(line) + 1
            held = rest
            yield out
        else:
            held += rest
    if begins < end and held:
        yield [held]  # the end of a file that has ended without a line end


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root = options["path"]
        self.name = options.get("filename", "*")
        zones = options.get("zones")
        self.zones = set(zones.split(",")) if zones else None
        self.zone_pattern = re.compile(options["zonepattern"]) if zones else None
        self.max_bytes = int(options.get("maxbytes", MAX_BYTES))
        self.piece = int(options.get("piecebytes", PIECE_BYTES))
        self.idle = float(options["idle"]) if "idle" in options else None
        self.at: dict[str, dict] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def wanted(self, path: str) -> bool:
        if not fnmatch.fnmatch(posixpath.basename(path), self.name):
            return False
        found = self.zones and self.zone_pattern.search(path)
        return not self.zones or bool(found) and found.group(1) in self.zones

    def latestOffset(self) -> dict:
        """Where a batch that starts at the last planned one would end."""
        store, root = opened_store(self.root)
        listed = {
            i.path: (i.size, i.mtime_ns // 1000) for i in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
            if i.is_file and not posixpath.basename(i.path).startswith((".", "_"))}
        starts, lost = self.placed(store, listed)
        budget, files, news = self.max_bytes, {}, False
        for path, (size, modified, start) in sorted(starts.items(), key=lambda x: (x[1][1], x[0])):
            to = start
            if start < size and budget > 0:
                with store.open_input_file(path) as f:
                    limit = min(size, start + budget)
                    # Only a batch that has nothing yet goes beyond its bound for a long line.
                    to = line_end(f, start, limit, limit if news else size)
                    if to < size == limit and self.idle is not None and time.time() - modified / 1e6 > self.idle:
                        to = size
                    if to > start:
                        head = min(to, HEAD_BYTES)
                        files[path] = Entry(start, to, head, head_hash(f, head), modified)
                        budget, news = budget - (to - start), True
                if limit < size:  # younger files wait for this one
                    budget = 0
                if to > start:
                    continue
            if path in self.at and path not in lost and self.at[path]["to"] == start:
                files[path] = {**self.at[path], "done": start}
            elif start:  # moved, nothing new yet
                before = next(e for p, e in lost.items() if e["to"] == start and same_beginning(store, path, size, e))
                files[path] = Entry(start, start, before["head"], before["hash"], modified)
        if not news:
            return {"files": self.at}
        for path, entry in lost.items():
            if path not in files and path not in listed and time.time() - entry["modified"] / 1e6 < REMEMBERED:
                files[path] = {**entry, "done": entry["to"]}
        return {"files": files}

    def placed(self, store: fs.FileSystem, listed: dict[str, tuple[int, int]]) -> tuple[dict[str, tuple[int, int, int]], dict[str, dict]]:
        """path -> (size, modified, byte to go on from) of the files to follow; entries whose path is gone or holds another file."""
        starts, lost, unknown = {}, {}, []
        for path, entry in self.at.items():
            size, modified = listed.get(path, (-1, 0))
            if size >= 0 and ((size, modified) == (entry["to"], entry["modified"]) or same_beginning(store, path, size, entry)):
                starts[path] = (size, modified, entry["to"])
            else:
                lost[path] = entry
        for path, (size, modified) in listed.items():
            if path in starts:
                continue
            # Under any name of the folder there may be what is left of a file that was moved.
            folder = posixpath.dirname(path)
            moved = next((p for p, e in lost.items() if posixpath.dirname(p) == folder and p not in unknown and p != path
                          and same_beginning(store, path, size, e)), None)
            if moved is not None:
                starts[path] = (size, modified, lost[moved]["to"])
                unknown.append(moved)
            elif size and self.wanted(path):
                starts[path] = (size, modified, 0)
        return starts, lost

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # The engine plans the last batch again after a restart, so this is where the reader learns how far it is.
        self.at = end["files"]
        if start == end:
            return []
        pieces = []
        for path, e in end["files"].items():
            for at in range(e["done"], e["to"], self.piece):
                pieces.append(InputPartition((path, at, min(at + self.piece, e["to"]), e)))
        return pieces

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end, entry = partition.value
        store, _ = opened_store(self.root)
        with self.found(store, path, entry) as f:
            for lines in lines_between(f, start, end, entry["done"], entry["to"]):
                if lines:
                    values = pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines], pa.string())
                    yield pa.RecordBatch.from_arrays([
                        values, pa.array([path] * len(lines)), pa.array([entry["modified"]] * len(lines), pa.int64()),
                        pa.array([start] * len(lines), pa.int64())], names=["value", "path", "modified", "block"])

    def found(self, store: fs.FileSystem, path: str, entry: dict):
        """The file of an entry, which may have been rotated since the batch was planned."""
        folder = posixpath.dirname(path)
        others = [i for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if i.is_file]
        for i in sorted(others, key=lambda i: i.path != path):
            if same_beginning(store, i.path, i.size, entry):
                return store.open_input_file(i.path)
        raise FileNotFoundError(f"{path} was removed before its bytes {entry['done']} to {entry['to']} were read")


class GrowingLines(DataSource):
    """Format ``growing_lines``."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options)


def read_growing(
    spark: SparkSession, root: str, file_name: str = "*", zones: Iterable[str] | None = None, zone_pattern: str = "",
    max_bytes: int = MAX_BYTES, idle: float | None = None, piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Lines appended to the files called ``file_name`` (a glob) below ``root``: value, path, modified and block.

    ``zone_pattern`` is a regular expression whose first group is the zone in a path. ``block`` is where in the
    file the piece of a line begins; the rows of a piece are in line order.
    """
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream.format("growing_lines").option("path", root).option("filename", file_name).option(
        "maxbytes", max_bytes).option("piecebytes", piece_bytes)
    if zones is not None:
        reader = reader.option("zones", ",".join(zones)).option("zonepattern", zone_pattern)
    return (reader if idle is None else reader.option("idle", idle)).load()

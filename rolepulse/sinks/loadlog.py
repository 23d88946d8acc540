"""The log of a table's loads: which runs there are, the numbers they own, and which of them are in place.

A load is a run with a name. It stages its rows in a folder of its own, reserves the next numbers
of every zone by a log entry, writes the numbered rows aside, and commits by one rename to
``<table>/run=<name>``. A run that failed and is repeated under its name gets the numbers it had
reserved; a run that is in place is not loaded again. Runs at the same time reserve one after the
other: an entry is a file whose name, its number, can be taken once. What a run staged goes with it.

Taking a name needs a file system that renames as one step and not over an existing file (HDFS
does). On a local file system, where Hadoop checks first and renames then, loads of one process
wait for each other.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

_one_at_a_time = threading.Lock()


class Folder:
    """A folder of a Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._store = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def names(self, below: str = "") -> list[str]:
        where = self._new(self.at(below) if below else self.path)
        return sorted(s.getPath().getName() for s in self._store.listStatus(where)) if self._store.exists(where) else []

    def exists(self, name: str) -> bool:
        return self._store.exists(self._new(self.at(name)))

    def read(self, name: str) -> str:
        stream = self._store.open(self._new(self.at(name)))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._store.create(self._new(self.at(name)), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def move(self, old: str, new: str) -> bool:
        """Rename; False if the new name is taken."""
        target = self._new(self.at(new))
        with _one_at_a_time:
            if self._store.exists(target):
                return False
            self._store.mkdirs(target.getParent())
            return self._store.rename(self._new(self.at(old)), target)

    def delete(self, name: str) -> None:
        self._store.delete(self._new(self.at(name)), True)


@dataclass(frozen=True)
class Entry:
    """Numbers ``first`` … ``first + count - 1`` of each zone, reserved for a run."""

    run: str
    first: dict[str, int]
    count: dict[str, int]


class LoadLog:
    """The loads of one table. Its own files lie in ``_loads``, which readers of the table pass over."""

    def __init__(self, spark: SparkSession, table: str):
        self.folder = Folder(spark, table)

    def entries(self) -> list[Entry]:
        """All reservations, in their order."""
        out = []
        for name in sorted((n for n in self.folder.names("_loads/log") if n.isdigit()), key=int):
            e = json.loads(self.folder.read(f"_loads/log/{name}"))
            out.append(Entry(e["run"], e["first"], e["count"]))
        return out

    def in_place(self, run: str) -> bool:
        return self.folder.exists(f"run={run}")

    def reserve(self, run: str, count: dict[str, int], start: dict[str, int]) -> Entry:
        """The numbers of a run: those it has reserved before, or the next ones (``start``: the last ones in use before the log began)."""
        while True:
            known = self.entries()
            mine = next((e for e in known if e.run == run), None)
            if mine is not None:
                if mine.count != count:
                    raise ValueError(f"run {run} was reserved for {mine.count} rows per zone and has {count} now")
                return mine
            last = dict(start)
            for e in known:
                for zone, first in e.first.items():
                    last[zone] = max(last.get(zone, 0), first + e.count[zone] - 1)
            entry = Entry(run, {z: last.get(z, 0) + 1 for z in count}, count)
            draft = f"_loads/drafts/{uuid.uuid4().hex}"
            self.folder.write(draft, json.dumps({"run": run, "first": entry.first, "count": entry.count}))
            if self.folder.move(draft, f"_loads/log/{len(known)}"):
                return entry
            self.folder.delete(draft)

    def commit(self, staged: str, run: str) -> None:
        """Put the folder ``staged`` (below the table) in place, unless the run is there already."""
        if not self.folder.move(staged, f"run={run}") and not self.in_place(run):
            raise OSError(f"could not move {staged} into place")

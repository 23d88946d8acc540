"""Tables kept in buckets of their key, with a manifest for each version.

A bucket is a folder; a version is a list of the folder of each bucket. Replacing rows by key
writes the buckets that hold one of these keys anew, under the number of the next version, and lists the
folders of all others as they were. Version ``n`` appears by one rename of its manifest, so readers
see a version as a whole, old versions stay readable, and of two writers one has to start again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rolepulse.operators.tableops import replace_into
from rolepulse.sinks.loadlog import Folder

# Where buckets lie below a table's folder, and the column that names them in paths.
_BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    """Bucket -> folder below ``data``, of version ``number``."""

    number: int
    folders: dict[int, str]


class BucketedTable:
    """A table in ``buckets`` folders by the hash of ``keys``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int = 256):
        self.spark, self.folder, self.schema, self.keys, self.buckets = spark, Folder(spark, path), schema, keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def version(self) -> Version:
        """The newest version; number -1 without any."""
        numbers = [int(n) for n in self.folder.names("versions") if n.isdigit()]
        if not numbers:
            return Version(-1, {})
        told = json.loads(self.folder.read(f"versions/{max(numbers)}"))
        if (told["keys"], told["buckets"]) != (self.keys, self.buckets):
            raise ValueError(f"the table has {told['buckets']} buckets by {told['keys']}")
        return Version(max(numbers), {int(b): f for b, f in told["folders"].items()})

    def read(self, version: Version | None = None, only: set[int] | None = None) -> DataFrame:
        """The rows of a version (of some buckets)."""
        folders = [f for b, f in (version or self.version()).folders.items() if only is None or b in only]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.folder.at(f"data/{f}") for f in folders])

    def _write(self, rows: DataFrame) -> dict[int, str]:
        """New folders of the buckets that ``rows`` fall into."""
        name = uuid.uuid4().hex
        rows.withColumn(_BUCKET, self.bucket()).hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(self.folder.at(f"data/{name}"))
        found = [f for f in self.folder.names(f"data/{name}") if f.startswith(f"{_BUCKET}=")]
        return {int(f.removeprefix(f"{_BUCKET}=")): f"{name}/{f}" for f in found}

    def _publish(self, after: Version, folders: dict[int, str]) -> Version:
        number = after.number + 1
        draft = f"drafts/{uuid.uuid4().hex}"
        self.folder.write(draft, json.dumps({"keys": self.keys, "buckets": self.buckets, "folders": {str(b): f for b, f in sorted(folders.items())}}))
        if not self.folder.move(draft, f"versions/{number}"):
            self.folder.delete(draft)
            raise FileExistsError(f"version {number} was written by somebody else")
        return Version(number, folders)

    def create(self, rows: DataFrame) -> Version:
        """Version 0."""
        return self._publish(Version(-1, {}), self._write(rows.select(self.schema.names)))

    def replace(self, source: DataFrame, order: list[str] | None = None, defaults: dict[str, Column] | None = None, tries: int = 5) -> Version:
        """The next version, after replacing rows by key as :func:`replace_into` does; buckets without a key of ``source`` are not read or written."""
        # At most as many numbers as there are buckets.
        touched = {r[0] for r in source.select(self.bucket()).distinct().collect()}
        for left in reversed(range(tries)):
            old = self.version()
            if not touched:
                return old
            new = replace_into(self.read(old, touched), source, self.keys, order, defaults)
            folders = {b: f for b, f in old.folders.items() if b not in touched} | self._write(new)
            try:
                return self._publish(old, folders)
            except FileExistsError:
                if not left:
                    raise
        return old

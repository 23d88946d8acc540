"""Helpers shared by the operators: words, Arrow batches, tables of the shared folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Documents handled between two results of a task; bounds the memory of a Python worker.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a UTF-8 text; none of a null."""
    return text.split() if text else []


def utf8(column: pa.Array) -> list[bytes | None]:
    """The strings of a column as UTF-8, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def by_rows(rows: Callable[[pa.RecordBatch], Iterable[tuple]], schema: pa.Schema) -> Callable:
    """A ``mapInArrow`` function from one that yields tuples for a batch; at most ROWS_AT_ONCE input rows are in work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                out = list(rows(batch.slice(at, ROWS_AT_ONCE)))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each uint64 (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sequence_hash(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` hashed words; order counts."""
    count = max(0, len(ids) - n + 1)
    with np.errstate(over="ignore"):
        h = np.zeros(count, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9DDFEA08EB382D69) + ids[j:j + count]
    return mix(h)


class WordHashes(dict):
    """64-bit hashes of words, kept for the frequent ones; at most ``limit`` stay."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def shared(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    from rolepulse.session import work_path

    return work_path(spark, os.path.join("llm", name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and a lost executor takes nothing with it."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)

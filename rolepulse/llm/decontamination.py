"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them.

A passage of a text is aligned with an item, word by word: a match counts 1, a replaced,
added or missing word -1. The score is the best local alignment divided by the words of the
item; from 0.5 on the text leaks the item. Words are compared in lower case without ASCII
punctuation.

The seeds lose no leak. An alignment of m matches and e errors has at most e + 1 runs of
matches, so that at least m - e - 1 of its two-word grams are whole: one less than the least
score in words. An item of g grams of which t have to be whole has at least k of them among
any g - t + k; its seeds are the rarest g - t + k, by the counts of all documents. A passage
that holds k seeds, at distances that differ from those in the item by no more than the errors
that the score allows, is aligned. This holds for every least score above 1 / 3.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words (a longer item is a block of
its own); a block travels to the tasks, which go through all documents. No row is shuffled
but the counts of a block's grams.

Defined cases: a null or empty text, and an item of fewer than three words, match nothing.
Items of equal text, or of one id, are judged each. Repeated documents get rows each; rows
with a null id are judged too. Other columns are ignored, or kept by :func:`decontaminated`.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.texts import ROWS_AT_ONCE, WordHashes, by_rows, sequence_hash, table, utf8

SEED = 2
LEAST_WORDS = 3
LEAST_SCORE = 0.5
#: Seeds that a passage has to hold, if that many grams of the item have to be whole.
HELD = 4
BLOCK_WORDS = 1_000_000

_PUNCTUATION = string.punctuation.encode()
_hashes = WordHashes()


def plain_words(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text in lower case, without ASCII punctuation."""
    if not text:
        return np.zeros(0, np.uint64)
    return _hashes.of(text.decode().lower().encode().translate(None, _PUNCTUATION).split())


def best_end(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment, and where it ends in the item and in the passage."""
    steps = np.arange(len(passage) + 1)
    above, best = np.zeros(len(passage) + 1, np.int64), (0, 0, 0)
    for i, word in enumerate(item):
        row = np.maximum(above - 1, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(passage == word, 1, -1))
        above = np.maximum.accumulate(row + steps) - steps  # words of the passage that the item lacks
        at = int(above.argmax())
        if above[at] > best[0]:
            best = (int(above[at]), i + 1, at)
    return best


def aligned(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment, and the part of the passage that it covers."""
    score, end_item, end = best_end(item, passage)
    if not score:
        return 0, 0, 0
    _, _, back = best_end(item[:end_item][::-1], passage[:end][::-1])
    return score, end - back, end


class Block:
    """Some items: their words, and the grams that may be seeds, sorted by hash."""

    def __init__(self, ids: list, items: list[np.ndarray]):
        self.ids, self.items = ids, items
        grams = [sequence_hash(w, SEED) for w in items]
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner, self.place = flat[order], owner[order], place[order]
        self.unique = np.unique(self.flat)

    def hits(self, grams: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of ``grams`` that are in the sorted ``known``, and where in it."""
        if not len(known) or not len(grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        found = np.flatnonzero(known[at] == grams)
        return found, at[found]

    def keep_rare(self, counts: np.ndarray, least: float = LEAST_SCORE) -> None:
        """Leave of each item its rarest grams, so many that a leak holds ``needed`` of them."""
        times = counts[np.searchsorted(self.unique, self.flat)]
        rare = np.zeros(len(times), bool)
        self.needed, self.spread = np.ones(len(self.items), np.int64), np.zeros(len(self.items), np.int64)
        for i, at in enumerate(np.split(np.argsort(self.owner, kind="stable"), np.cumsum(np.bincount(self.owner, minlength=len(self.items)))[:-1])):
            score = int(np.ceil(least * len(self.items[i]) - 1e-9))  # matches less errors
            whole = max(1, score - 1)
            self.needed[i], self.spread[i] = min(HELD, whole), max(0, len(self.items[i]) - score)
            rare[at[np.lexsort((self.place[at], times[at]))[:len(at) - whole + self.needed[i]]]] = True
        self.flat, self.owner, self.place = self.flat[rare], self.owner[rare], self.place[rare]
        self.unique = np.unique(self.flat)
        self.first, self.last = np.searchsorted(self.flat, self.unique, "left"), np.searchsorted(self.flat, self.unique, "right")

    def passages(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of the passages that hold enough seeds of the item."""
        at, gram = self.hits(sequence_hash(words, SEED), self.unique)
        if not len(at):
            return
        many = self.last[gram] - self.first[gram]
        entry = np.repeat(self.first[gram], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(at, many)
        item, begins = self.owner[entry], at - self.place[entry]
        order = np.lexsort((begins, item))
        item, begins = item[order], begins[order]
        ends = np.arange(len(item)) + self.needed[item] - 1
        held = np.flatnonzero(ends < len(item))
        held = held[(item[ends[held]] == item[held]) & (begins[ends[held]] - begins[held] <= self.spread[item[held]])]
        if not len(held):
            return
        item, begins = item[held], begins[held]
        length = np.array([len(self.items[i]) for i in item])
        cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(begins) > length[1:])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(item)]):
            i, n = int(item[lo]), int(length[lo])
            yield i, max(0, int(begins[lo]) - n), min(len(words), int(begins[hi - 1]) + 2 * n)


def blocks(benchmark: DataFrame, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items of the benchmark that have a seed, some at a time."""
    ids, items, size = [], [], 0
    for r in benchmark.where("text IS NOT NULL").select("item_id", "text").toLocalIterator():
        found = plain_words(r["text"].encode())
        if len(found) < LEAST_WORDS:
            continue
        if ids and size + len(found) > most:
            yield Block(ids, items)
            ids, items, size = [], [], 0
        ids.append(r["item_id"])
        items.append(found)
        size += len(found)
    if ids:
        yield Block(ids, items)


def counted(docs: DataFrame, block: Block) -> np.ndarray:
    """How often the corpus holds each gram of a block: at most one number a word of the block reaches the driver."""
    def count(batches):
        times = np.zeros(len(block.unique), np.int64)
        for batch in batches:
            for text in utf8(batch.column(0)):
                np.add.at(times, block.hits(sequence_hash(plain_words(text), SEED), block.unique)[1], 1)
        some = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(times[some])], ["gram", "times"])

    rows = docs.select("text").mapInArrow(count, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times")).toArrow()
    out = np.zeros(len(block.unique), np.int64)
    out[rows["gram"].to_numpy()] = rows["times"].to_numpy()
    return out


def leaks_of(text: bytes | None, block: Block, least: float = LEAST_SCORE) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, first word, words) of each item that a text leaks: its best passage."""
    words, best = plain_words(text), {}
    for i, start, end in block.passages(words):
        score, a, b = aligned(block.items[i], words[start:end])
        share = score / len(block.items[i])
        if share >= least and share > best.get(i, (0.0,))[0]:
            best[i] = (share, start + a, b - a)
    for i, found in best.items():
        yield (i, *found)


_LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("n_words", pa.int64())])


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """A row for each row and item that it leaks: the score, and the words of the best passage."""
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, start long, n_words long")
    for block in blocks(benchmark):
        block.keep_rare(counted(docs, block), least)

        def judge(batch, block=block):
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for i, *found in leaks_of(text, block, least):
                    yield doc_id, block.ids[i], *found

        out = out.union(docs.select("doc_id", "text").mapInArrow(by_rows(judge, _LEAK), out.schema))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that leak no item."""
    at, out = docs.columns.index("text"), docs
    for block in blocks(benchmark):
        block.keep_rare(counted(docs, block), least)

        def keep(batches, block=block):
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(lo, ROWS_AT_ONCE)
                    yield part.filter(pa.array([next(leaks_of(t, block, least), None) is None for t in utf8(part.column(at))], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

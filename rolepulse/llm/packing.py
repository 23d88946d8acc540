"""Packing: documents into sequences of at most 2048 tokens, by cutting stock.

A text is cut into whole sequences and a remainder. Remainders fall into classes of
their length (a class is ``GRAIN`` tokens wide, rounded up); the histogram of the classes,
at most 256 numbers, goes to the driver, where column generation solves the linear program
over its patterns. A remainder of more than half a sequence may be cut once more, into a half
and the rest, where the program finds that this saves padding. Rounded-down patterns are assigned to the remainders by their rank in
their class: rank = rows of the class in earlier chunks + place in the own chunk, so that a
class with a third of all documents is ranked without gathering it.

What rounding leaves, at most the items of one copy of each pattern, is cut into powers of
two by the binary digits of its length. Sorted by size these fill sequences without a gap,
and the last one is split at the digits of its own length: sequences of a power of two are
not padded.

Defined cases: a null or empty text is the one end id. Repeated rows, and rows with a null
id, are documents of their own. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolepulse.llm.cutting_stock import rounded
from rolepulse.llm.texts import by_rows, shared, table, utf8

SEQUENCE = 2048
HALF = SEQUENCE // 2
#: Width of a length class in tokens.
GRAIN = 8
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker keeps.
KEPT_WORDS = 250_000

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_CUT = f"{_PIECE}, chunk long, class long, place long, rest_crc long, parts array<struct<start: long, length: long, crc: long>>"
_PARTS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))
_CUT_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "chunk", "class", "place", "rest_crc")]
                       + [("parts", _PARTS)])
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

#: Letters that lowering and composing leave as they are, then ASCII signs: always two pieces of a word.
_LETTERS_SIGNS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")


class WordIds(dict):
    """Ids of a word as unsigned little-endian 32-bit numbers.

    The vocabulary's rules never look across white space, so a text's ids are those of its words.
    Words of plain letters go to the vocabulary's merges at once, others through all its rules.
    The last ``limit`` to 2 * ``limit`` words stay known.
    """

    def __init__(self, vocabulary: str, limit: int = KEPT_WORDS):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        if not os.path.isabs(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer, self.limit, self.older = Tokenizer.from_file(vocabulary), limit, {}
        self.merges, self.as_signs = self.tokenizer.model.tokenize, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            plain = _LETTERS_SIGNS.fullmatch(word)
            if plain and plain[2]:
                ids = self[plain[1]] + self[plain[2]]
            elif plain:
                text = word.decode()
                found = self.merges(text if text.isascii() else self.as_signs(text)[0][0])
                ids = b"".join([t.id.to_bytes(4, "little") for t in found])
            else:
                ids = b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(word.decode(), add_special_tokens=False).ids])
        self[word] = ids
        return ids

    def of(self, text: bytes | None) -> bytes:
        """Ids of a whole text and the end id."""
        text = text or b""
        if b"<|" not in text:  # else a special token might appear by lowering
            text = text.lower()  # ASCII letters only; the vocabulary lowers every letter
        return b"".join(map(self.__getitem__, text.split())) + END.to_bytes(4, "little")


@lru_cache(maxsize=2)
def word_ids(vocabulary: str) -> WordIds:
    return WordIds(vocabulary)


def powers(length: int) -> list[tuple[int, int]]:
    """(start, length) of the parts of a power of two, by the binary digits, largest first."""
    out, at = [], 0
    for bit in range(length.bit_length() - 1, -1, -1):
        if length >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def cut(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of each row with chunk, class and place; a remainder also has its parts of powers of two, and the checksum beyond half a sequence."""

    def pieces(batches):
        chunk, seen = TaskContext.get().partitionId(), {}

        def rows(batch):
            ids_of = word_ids(vocabulary)
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids = ids_of.of(text)
                total = len(ids) // 4
                for start in range(0, total, SEQUENCE):
                    own = memoryview(ids)[4 * start:4 * (start + SEQUENCE)]
                    n = len(own) // 4
                    size = -(-n // GRAIN) if n < SEQUENCE else 0  # class 0: whole sequences
                    seen[size] = place = seen.get(size, -1) + 1
                    parts = [{"start": start + a, "length": k, "crc": zlib.crc32(own[4 * a:4 * (a + k)])} for a, k in powers(n)] if size else None
                    rest = zlib.crc32(own[4 * HALF:]) if size and n > HALF else None
                    yield doc_id, start, n, zlib.crc32(own), total, chunk, size, place, rest, parts

        yield from by_rows(rows, _CUT_ARROW)(batches)

    return docs.select("doc_id", "text").mapInArrow(pieces, _CUT)


def plan(counts: np.ndarray, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Slots of the rounded patterns, cuts and first unassigned rank of each class, first free sequence.

    A slot row: class, first rank, copies of the class in a sequence, first sequence, first position.
    """
    cuts, used, _ = rounded(counts, SEQUENCE // GRAIN)
    rank, sequence, slots = np.zeros(len(counts), np.int64), whole, [(0, 0, 1, 0, 0)]
    for column, times in used:
        position = 0
        for size in np.flatnonzero(column)[::-1]:
            copies = int(column[size])
            slots.append((size, rank[size], copies, sequence, position))
            rank[size] += copies * times
            position += copies
        sequence += times
    return np.array(sorted(slots), np.int64), cuts, rank, sequence


_PLACED = f"{_PIECE}, class long, rank long, sequence_id long, position long, parts array<struct<start: long, length: long, crc: long>>"


def items(ranked: DataFrame, slots: np.ndarray, counts: np.ndarray, cuts: np.ndarray, assigned: np.ndarray) -> DataFrame:
    """Pieces after the further cuts, with sequence and position, or with their parts where no pattern has a place for them.

    The tables of all classes go to the tasks with the function: as literals they would weigh on the driver.
    """
    half, cut_before = HALF // GRAIN, np.cumsum(cuts) - cuts
    # a class has a list of its assigned ranks' slots: find the last one that starts at or before the rank
    keys = slots[:, 0] << 48 | slots[:, 1]

    def place(batches):
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            start, length, crc, size, rank = (column[n].to_numpy() for n in ("start", "length", "ids_crc32", "class", "rank"))
            again = rank < cuts[size]
            own, two = np.flatnonzero(~again), np.flatnonzero(again)
            rows = np.concatenate([own, two, two])
            heads = pc.struct_field(pc.list_element(column["parts"].take(pa.array(two)), 0), "crc").to_numpy(zero_copy_only=False)
            tails = column["rest_crc"].take(pa.array(two)).to_numpy(zero_copy_only=False)
            start, length, crc = (np.concatenate([a[own], b, c]).astype(np.int64) for a, b, c in (
                (start, start[two], start[two] + HALF), (length, np.full(len(two), HALF), length[two] - HALF), (crc, heads, tails)))
            old, size = size, np.concatenate([size[own], np.full(len(two), half), size[two] - half])
            rank = np.concatenate([rank[own] - cuts[old[own]], counts[half] - cuts[half] + cut_before[old[two]] + rank[two], counts[old[two] - half] + rank[two]])
            left = (size > 0) & (rank >= assigned[size])
            s = slots[np.searchsorted(keys, size << 48 | rank, "right") - 1]
            ahead = rank - s[:, 1]
            parts: list[list[dict] | None] = [None] * len(rows)
            at = np.flatnonzero(left)
            for i, whole in zip(at.tolist(), column["parts"].take(pa.array(rows[at])).to_pylist()):
                parts[i] = whole if i < len(own) else whole[:1] if i < len(own) + len(two) else whole[1:]
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [column["doc_id"].take(taken), pa.array(start), pa.array(length), pa.array(crc), column["doc_tokens"].take(taken), pa.array(size), pa.array(rank),
                 pa.array(s[:, 3] + ahead // s[:, 2], mask=left), pa.array(s[:, 4] + ahead % s[:, 2], mask=left), pa.array(parts, _PARTS)],
                [*RESULT[:5], "class", "rank", "sequence_id", "position", "parts"])

    return ranked.mapInArrow(place, _PLACED)


def packed(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark, path = docs.sparkSession, shared(docs.sparkSession, "pieces")
    cut(docs, vocabulary).write.parquet(path)
    pieces = spark.read.schema(_CUT).parquet(path)

    in_chunks = pieces.groupBy("class", "chunk").agg(F.count("*").alias("rows"))
    counts, whole = np.zeros(SEQUENCE // GRAIN + 1, np.int64), 0
    for r in in_chunks.groupBy("class").agg(F.sum("rows").alias("rows")).collect():  # at most 257 rows
        if r["class"]:
            counts[r["class"]] = r["rows"]
        else:
            whole = r["rows"]
    slots, cuts, assigned, first_free = plan(counts, whole)

    earlier = Window.partitionBy("class").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = in_chunks.select("class", "chunk", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["class", "chunk"]).select(*RESULT[:5], "class", (F.col("before") + F.col("place")).alias("rank"), "rest_crc", "parts")
    found = items(ranked, slots, counts, cuts, assigned)

    placed = found.where("sequence_id IS NOT NULL").select(*RESULT[:6], "position")
    inside = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    one = F.col("length") == SEQUENCE
    fitted = (placed.where(one).select(*RESULT[:6], F.lit(0).cast("long").alias("offset"))
              .union(placed.where(~one).select(*RESULT[:6], F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))))

    # what is left, at most one copy of each pattern, in parts of powers of two: the larger ones first fill without a gap
    part = (found.where("sequence_id IS NULL").select("doc_id", "doc_tokens", "class", "rank", F.explode("parts").alias("part"))
            .select("doc_id", "part.start", "part.length", F.col("part.crc").alias("ids_crc32"), "doc_tokens", "class", "rank"))
    sizes = {r["length"]: r["rows"] for r in part.groupBy("length").agg(F.count("*").alias("rows")).collect()}  # at most 11 rows
    base, tokens = {}, 0
    for size in sorted(sizes, reverse=True):
        base[size] = tokens
        tokens += size * sizes[size]
    starts = F.create_map(*[F.lit(x).cast("long") for kv in base.items() for x in kv]) if base else F.create_map(F.lit(0).cast("long"), F.lit(0).cast("long"))
    by_size = Window.partitionBy("length").orderBy("class", "rank", "start")
    at = F.element_at(starts, F.col("length")) + (F.row_number().over(by_size) - 1) * F.col("length")
    tail = tokens // SEQUENCE * SEQUENCE
    ends = [(tail + a, k) for a, k in powers(tokens - tail)]
    sequence, offset = F.floor(F.col("at") / SEQUENCE), F.col("at") % SEQUENCE
    for i, (a, k) in enumerate(ends):
        mine = (F.col("at") >= a) & (F.col("at") < a + k)
        sequence, offset = F.when(mine, tail // SEQUENCE + i).otherwise(sequence), F.when(mine, F.col("at") - a).otherwise(offset)
    rest = part.withColumn("at", at).select(*RESULT[:5], (sequence + first_free).cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
    return fitted.union(rest)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))

"""Repeated passages: recurring phrases are confirmed, compiled into sharded automata, and located in all documents.

A window is ``WINDOW`` consecutive words. Each window has an anchor, its ten-word gram of the
least hash by 32 bits (the first of equals), so that equal windows have equal anchors. Consecutive windows
of one anchor are a context. What recurs is confirmed by counts over all documents: a context
that is there twice makes its span a phrase; where an anchor recurs and one of its contexts
does not, its windows are counted, and those there twice are phrases.

Phrases lie in shards by a text that their anchor occurs in, the same for all contexts of a
copied text. A shard of many phrases is cut into pieces of at most ``PHRASES``, one of many
segments into salts of about ``SEGMENT_WORDS`` words, by counts. A task compiles the phrases of
a piece with pyahocorasick, a word a character, and streams the segments of the documents that
hold an anchor of the shard; what it reports is checked by a 64-bit hash of the words. Every
recurring window is in a phrase and every phrase consists of recurring windows, so that the
words located are those to remove.

Copies of a text recur whole, so that one of them goes through the automata; the others, which
still count, are settled by its key.

Defined cases: null, empty and short texts have no window and lose nothing; equal texts lose
every word if they have a window. Repeated rows and null ids get rows each. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from rolepulse.llm.texts import ROWS_AT_ONCE, by_rows, mix, sequence_hash, stored, table, utf8, words

WINDOW, ANCHOR = 35, 10
#: Text handled at once in a task.
BYTES_AT_ONCE = 2_000_000
#: Phrases of one automaton at most, and words streamed through one copy of it, about.
PHRASES, SEGMENT_WORDS = 20_000, 20_000_000
#: Contexts of one shard, about: 2000 phrases compile five times as fast as a tenth of 20,000.
SHARD = 2_000

_BASE = 0x9DDFEA08EB382D69


class Sums:
    """Hashes of any run of a text's words, by prefix sums."""

    _powers = _inverse = np.ones(1, np.uint64)

    def __init__(self, ids: np.ndarray):
        if len(Sums._powers) <= len(ids):
            size = 2 * len(ids) + 1
            Sums._powers, Sums._inverse = (np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * Sums._powers[:len(ids)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Sums._inverse[start])


def hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and how many each has."""
    found = [words(t) for t in texts]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(found)), np.uint64, int(sizes.sum())), sizes


def contexts_of(ids: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Text, first window there, number of windows, anchor and hash of each context of the texts."""
    count = len(ids) - window + 1
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    # a window lies in one text
    inside = np.flatnonzero(text[:max(count, 0)] == text[window - 1:]) if count > 0 else np.zeros(0, np.int64)
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    grams, sums = sequence_hash(ids, ANCHOR), Sums(ids)
    # the minimum over a window by doubling; the lower half of a key is the position, so that the first of equals wins
    low, reach, wanted = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), 1, window - ANCHOR + 1
    while 2 * reach <= wanted:
        low, reach = np.minimum(low[:-reach], low[reach:]), 2 * reach
    low = np.minimum(low[:count], low[wanted - reach:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)[inside]
    begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # an anchor lies in one text too
    start, many, at = inside[begins], np.diff(np.r_[begins, len(at)]), at[begins]
    shape = (at - start).astype(np.uint64) << np.uint64(32) | many.astype(np.uint64)
    context = mix(sums.of(start, start + many + window - 1) ^ mix(shape))
    return text[start], start - first[text[start]], many, grams[at].view(np.int64), context.view(np.int64)


_CONTEXT = "d0 long, d1 long, start int, many int, anchor long, context long"


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ROWS_AT_ONCE rows and, beyond one row, BYTES_AT_ONCE of text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy())
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = min(lo + ROWS_AT_ONCE, max(lo + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, "right"))))
            yield batch.slice(lo, hi - lo)
            lo = hi


def contexts(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """The contexts of all texts (d0, d1, text)."""
    def find(batches):
        for part in _slices(batches, 2):
            which, start, many, anchor, context = contexts_of(*hashed(utf8(part.column(2))), window)
            yield pa.RecordBatch.from_arrays(
                [part.column(i).take(pa.array(which)) for i in (0, 1)]
                + [pa.array(start.astype(np.int32)), pa.array(many.astype(np.int32)), pa.array(anchor), pa.array(context)],
                ["d0", "d1", "start", "many", "anchor", "context"])

    return texts.mapInArrow(find, _CONTEXT)


def _joined_hot(found: DataFrame, known: DataFrame, key: list[str], n: str) -> DataFrame:
    """``found`` joined with ``known``. Keys that hold a thousandth of all rows are a thousand at most: they are broadcast, so that no task gets all rows of one."""
    hot = F.broadcast(known.where(F.col(n) * 1000 >= found.count()))
    cold = found.join(hot.select(*key), key, "left_anti")
    return found.join(hot, key).unionByName(cold.join(known, key))


def recurring(found: DataFrame) -> DataFrame:
    """The contexts whose anchor recurs, with home, the least text that holds the anchor."""
    anchors = found.groupBy("anchor").agg(F.count("*").alias("total"), F.min("d0").alias("home")).where("total > 1")
    return _joined_hot(found, stored(anchors, "anchors"), ["anchor"], "total").drop("total")


def counted(near: DataFrame) -> DataFrame:
    """Each context (anchor, context) of an anchor that recurs: is it sure, has its anchor one that isn't, and the least text that holds it."""
    each = near.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min("d0").alias("rep"))
    least = each.groupBy("anchor").agg((F.min("n") == 1).alias("mixed"))
    return each.join(least, "anchor").selectExpr("anchor", "context", "n", "n > 1 AS sure", "mixed", "rep")


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


_TOUCHED = "doc_id long, d0 long, d1 long, row long, copy boolean, n_words long, text string, kept_sha256 string"


def touched(keyed: DataFrame, near: DataFrame, marks: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each row with its recurring contexts. A row without any keeps all its words, a further row of an equal text none; both are left without text and contexts."""
    hits = (_joined_hot(near, marks, ["anchor", "context"], "n")
            .select("d0", "d1", "start", "many", "anchor", "context", "sure", "mixed", "home", (F.col("rep") == F.col("d0")).alias("speaks")).distinct())
    lists = hits.groupBy("d0", "d1").agg(F.collect_list(F.struct("start", "many", "anchor", "context", "sure", "mixed", "home", "speaks")).alias("hits"))
    rows = keyed.join(lists, ["d0", "d1"], "left").select("doc_id", "d0", "d1", "text", "hits").sortWithinPartitions("d0", "d1")
    hit_type = rows.schema["hits"].dataType.simpleString()

    def summarise(batches):
        row, last = TaskContext.get().partitionId() << 33, None
        for part in _slices(batches, 3):
            all_words = [words(t) for t in utf8(part.column(3))]
            keys = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
            again = [k == before and len(w) >= window for k, before, w in zip(keys, [last, *keys], all_words)]
            last = keys[-1]
            plain = part.column(4).is_null().to_numpy(zero_copy_only=False) | np.array(again)
            kept = pa.array(np.arange(part.num_rows), mask=plain)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(row + np.arange(part.num_rows)), pa.array(again), pa.array([len(w) for w in all_words], pa.int64()),
                 part.column(3).cast(pa.string()).take(kept),
                 pa.array([(_digest([] if a else w) if p else None) for w, a, p in zip(all_words, again, plain)], pa.string()),
                 part.column(4).take(kept)],
                ["doc_id", "d0", "d1", "row", "copy", "n_words", "text", "kept_sha256", "hits"])
            row += part.num_rows

    return rows.mapInArrow(summarise, f"{_TOUCHED}, hits {hit_type}")


def mixed_windows(texts: pa.Array, hits: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context (its place in all ``hits``), first word and hash of each window of the contexts."""
    fields = dict(zip((f.name for f in hits.type.value_type), hits.flatten().flatten()))
    start, many = (fields[n].to_numpy().astype(np.int64) for n in ("start", "many"))
    ids, sizes = hashed(utf8(texts))
    hit = np.repeat(np.arange(len(many)), many)
    at = np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())
    first = np.repeat(np.cumsum(sizes) - sizes, hits.value_lengths().to_numpy())[hit]
    return hit, at, Sums(ids).of(first + at, first + at + window).view(np.int64)


def window_phrases(mixed: DataFrame, window: int = WINDOW) -> DataFrame:
    """The recurring windows that a context which isn't sure holds: hash, home, and the row to take it from."""
    def find(batches):
        for part in _slices(batches, 1):
            hits = part.column(2)
            hit, _, found = mixed_windows(part.column(1), hits, window)
            fields = dict(zip((f.name for f in hits.type.value_type), hits.flatten().flatten()))
            rows = np.repeat(part.column(0).to_numpy(), hits.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(fields["anchor"].to_numpy()[hit]), pa.array(found), pa.array(fields["sure"].to_numpy(zero_copy_only=False)[hit]), pa.array(rows[hit]),
                 pa.array(fields["home"].to_numpy()[hit])], ["anchor", "window", "sure", "row", "home"])

    seen = mixed.mapInArrow(find, "anchor long, window long, sure boolean, row long, home long")
    return (seen.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("sure").alias("sure"), F.min("row").alias("row"), F.min("home").alias("home"))
            .where("n > 1 AND NOT sure").select("row", "window", "home"))


def _joined(found: list[bytes]) -> str:
    return b" ".join(found).decode()


_PHRASE = "home long, phrase string, hash long"


def phrases(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """All phrases, a character for each word, with the hash of their words and the home of their shard."""
    def spoken(batches):
        for part in _slices(batches, 0):
            out = []
            for text, hits in zip(utf8(part.column(0)), part.column(1).to_pylist()):
                ids, _ = hashed([text])
                once = list({(x["anchor"], x["context"]): x for x in hits}.values())
                start = np.array([x["start"] for x in once])
                end = start + np.array([x["many"] for x in once]) + window - 1
                whole = spelled(ids)
                out += zip([x["home"] for x in once], [whole[a:b] for a, b in zip(start.tolist(), end.tolist())], Sums(ids).of(start, end).view(np.int64).tolist())
            yield _phrase_batch(out)

    def taken(batches):
        for part in _slices(batches, 0):
            hit, at, found = mixed_windows(part.column(0), part.column(1), window)
            wanted = part.column(2)
            home, hashes = (x.to_numpy() for x in wanted.flatten().flatten()[::-1])
            # the first place of each wanted window in its text: pairs of text and hash, looked up by one sort
            own = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy())[hit]
            text = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy())
            known = np.lexsort((at, found, own))
            code, asked = (mix(mix(t.astype(np.uint64)) ^ h.view(np.uint64)) for t, h in ((own[known], found[known]), (text, hashes)))
            code, place = np.unique(code, return_index=True)
            ids, sizes = hashed(utf8(part.column(0)))
            start = ((np.cumsum(sizes) - sizes)[text] + at[known[place[np.searchsorted(code, asked)]]]).tolist()
            whole = spelled(ids)
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array([whole[a:a + window] for a in start], pa.string()), pa.array(hashes)], ["home", "phrase", "hash"])

    sure = rows.select("text", F.filter("hits", lambda x: x["sure"] & x["speaks"]).alias("hits")).where(F.size("hits") > 0)
    mixed = rows.select("row", "text", F.filter("hits", lambda x: x["mixed"]).alias("hits")).where(F.size("hits") > 0)
    wanted = window_phrases(mixed, window).groupBy("row").agg(F.collect_list(F.struct("window", "home")).alias("wanted"))
    single = mixed.join(wanted, "row").select("text", "hits", "wanted")
    return sure.mapInArrow(spoken, _PHRASE).union(single.mapInArrow(taken, _PHRASE))


def _phrase_batch(out: list[tuple[int, str, int]]) -> pa.RecordBatch:
    home, phrase, known = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(home, pa.int64()), pa.array(phrase, pa.string()), pa.array(known, pa.int64())], ["home", "phrase", "hash"])


_SEGMENT = pa.schema([("shard", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("text", pa.string())])


def segments(rows: DataFrame, shards: int, window: int = WINDOW) -> DataFrame:
    """The parts of each text that contexts of a shard cover, for each shard."""
    def cut(batch):
        for d0, d1, text, hits in zip(*(batch.column(i).to_pylist() for i in (0, 1)), utf8(batch.column(2)), batch.column(3).to_pylist()):
            found, spans = words(text), {}
            for x in sorted(hits, key=lambda x: x["start"]):
                own, end = spans.setdefault(x["shard"], []), x["start"] + x["many"] + window - 1
                if own and x["start"] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([x["start"], end])
            for shard, own in spans.items():
                for start, end in own:
                    yield shard, d0, d1, start, end - start, _joined(found[start:end])

    of_shard = F.transform("hits", lambda x: F.struct(x["start"], x["many"], F.pmod(F.xxhash64(x["home"]), F.lit(shards)).alias("shard")))
    return rows.select("d0", "d1", "text", of_shard.alias("hits")).mapInArrow(by_rows(cut, _SEGMENT), "shard long, d0 long, d1 long, at long, size long, text string")


def spelled(ids: np.ndarray) -> str:
    """A character for each word, of the 2 ** 20 beyond the basic plane."""
    return ((ids & np.uint64(0xFFFFF)) + np.uint64(0x10000)).astype("<u4").tobytes().decode("utf-32-le")


class Automaton:
    """The phrases of a piece, compiled once the first segments come."""

    def __init__(self):
        self.trie, self.known, self.ready = ahocorasick.Automaton(ahocorasick.STORE_INTS), {}, False

    def add(self, phrase: bytes) -> None:
        ids, _ = hashed([phrase])
        self.learn(spelled(ids), int(Sums(ids).of(np.array([0]), np.array([len(ids)])).view(np.int64)[0]))

    def learn(self, key: str, known: int) -> None:
        self.known.setdefault(key, set()).add(known)

    def _compile(self) -> None:
        for number, key in enumerate(self.known):
            self.trie.add_word(key, number)
        self.lengths = np.fromiter(map(len, self.known), np.int64, len(self.known))
        self.hashes = np.fromiter((next(iter(x)) for x in self.known.values()), np.int64, len(self.known))
        self.more = {i: x for i, x in enumerate(self.known.values()) if len(x) > 1}
        self.known, self.ready = {}, True
        self.trie.make_automaton()

    def occurrences(self, segment: bytes) -> Iterator[tuple[int, int]]:
        """Merged (start, end) of the words that phrases cover."""
        _, start, end = self.across([segment])
        yield from zip(start.tolist(), end.tolist())

    def across(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of many segments at once: segment, start, end."""
        if not self.ready:
            self._compile()
        none = np.zeros(0, np.int64)
        if not len(self.lengths):
            return none, none, none
        ids, sizes = hashed(segments)
        first, whole = np.cumsum(sizes) - sizes, spelled(ids)
        # no phrase holds the character between two segments
        line = "\0".join(whole[a:a + n] for a, n in zip(first.tolist(), sizes.tolist()))
        found = np.fromiter(chain.from_iterable(self.trie.iter(line)), np.int64).reshape(-1, 2)
        if not len(found):
            return none, none, none
        end, number = found[:, 0] + 1, found[:, 1]
        begins = first + np.arange(len(sizes))
        start, segment = end - self.lengths[number], np.searchsorted(begins, end - 1, "right") - 1
        hashes = Sums(ids).of(start - segment, end - segment).view(np.int64)
        right = hashes == self.hashes[number]
        if self.more:
            for i in np.flatnonzero(~right).tolist():
                right[i] = int(hashes[i]) in self.more.get(int(number[i]), ())
        start, end, segment = start[right], end[right], segment[right]
        if not len(start):
            return none, none, none
        order = np.argsort(start, kind="stable")
        start, end, segment = start[order], np.maximum.accumulate(end[order]), segment[order]
        new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
        last = np.r_[new[1:] - 1, len(end) - 1]
        at = begins[segment[new]]
        return segment[new], start[new] - at, end[last] - at


def located(parts: DataFrame, known: DataFrame, shards: int, most: int = PHRASES, most_words: int = SEGMENT_WORDS) -> DataFrame:
    """Every occurrence of the phrases: d0, d1, start, end of the words covered."""
    sharded = known.select(F.pmod(F.xxhash64("home"), F.lit(shards)).alias("shard"), "phrase", "hash")
    sizes = (sharded.groupBy("shard").agg(F.ceil(F.count("*") / most).alias("pieces"))
             .join(parts.groupBy("shard").agg(F.ceil(F.sum("size") / most_words).alias("salts")), "shard"))
    sizes = stored(sizes, "shards")
    steps = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    null = F.lit(None).cast("long")
    taught = (sharded.join(sizes, "shard").withColumn("piece", F.pmod(F.xxhash64("phrase"), F.col("pieces"))).withColumn("salt", steps("salts"))
              .select("shard", "piece", "salt", F.lit(0).alias("kind"), F.col("hash").alias("d0"), null.alias("d1"), null.alias("at"), F.col("phrase").alias("text")))
    read = (parts.join(sizes, "shard").withColumn("salt", F.pmod(F.xxhash64("d0", "d1", "at"), F.col("salts"))).withColumn("piece", steps("pieces"))
            .select("shard", "piece", "salt", F.lit(1).alias("kind"), "d0", "d1", "at", "text"))
    key = ["shard", "piece", "salt"]
    rows = taught.union(read).repartition(*key).sortWithinPartitions(*key, "kind")

    def stream(batches):
        last, automaton = None, None
        for batch in batches:
            group, d0 = np.stack([batch.column(c).to_numpy() for c in range(4)]), batch.column(4).to_numpy()
            edges = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(axis=0), True])
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if (key := tuple(group[:3, lo])) != last:
                    last, automaton = key, Automaton()
                if group[3, lo] == 0:
                    for phrase, known in zip(batch.column(7).slice(lo, hi - lo).to_pylist(), d0[lo:hi].tolist()):
                        automaton.learn(phrase, known)
                    continue
                for part in _slices([batch.slice(lo, hi - lo)], 7):
                    which, start, end = automaton.across(utf8(part.column(7)))
                    if len(which):
                        before = part.column(6).to_numpy()[which]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(c).take(pa.array(which)) for c in (4, 5)] + [pa.array(before + start), pa.array(before + end)], ["d0", "d1", "start", "end"])

    return rows.mapInArrow(stream, "d0 long, d1 long, start long, end long")


def without_repeats(docs: DataFrame, window: int = WINDOW, most: int = PHRASES, most_words: int = SEGMENT_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (null where nothing is removed) and kept_sha256 of each row."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(text).alias("d0"), F.xxhash64(F.lit(1), text).alias("d1"), text.alias("text"))
    found = stored(contexts(keyed.select("d0", "d1", "text"), window), "contexts")
    near = stored(recurring(found), "recurring")
    marks = stored(counted(near), "counted")
    rows = stored(touched(keyed, near, marks, window), "touched")
    hit = rows.where("hits IS NOT NULL")
    shards = max(1, -(-marks.count() // min(most, SHARD)))
    known, parts = stored(phrases(hit, window), "phrases"), stored(segments(hit, shards, window), "segments")
    covered = located(parts, known, shards, most, most_words).distinct().groupBy("d0", "d1").agg(F.collect_list(F.struct("start", "end")).alias("covered"))

    def remove(batch):
        for doc_id, n, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist()):
            found, gone = words(text), np.zeros(n + 1, np.int64)
            for s in spans or ():
                gone[s["start"]] += 1
                gone[s["end"]] -= 1
            stays = np.cumsum(gone)[:n] == 0
            kept = [w for w, k in zip(found, stays.tolist()) if k]
            yield doc_id, n, n - len(kept), _joined(kept), _digest(kept)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])
    changed = (hit.select("doc_id", "d0", "d1", "n_words", "text").join(covered, ["d0", "d1"], "left").select("doc_id", "n_words", "text", "covered")
               .mapInArrow(by_rows(remove, schema), "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"))
    same = rows.where("hits IS NULL").select("doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(0).cast("long").alias("n_removed"),
                                             F.when(F.col("copy"), "").alias("kept_text"), "kept_sha256")
    return changed.union(same)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")

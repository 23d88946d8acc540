"""Near-duplicates: ProbMinHash signatures of weighted shingles, banding, verification.

A text is the set of its five-word shingles, weighted 1 + ln(times). Every shingle is a
Poisson process whose arrivals fall on random registers; a register keeps the shingle that
arrives first, so that two signatures agree in a register with the probability Jaccard
similarity. A process ends once it is later than every register. Signatures are cut into
bands; documents that share a band are candidates, and candidates are linked if the exact
probability Jaccard (or the plain Jaccard of the shingle sets) is at least 0.8. A class is a
connected component of the links; its id is its least doc_id.

Documents of one word sequence are collapsed first. In a bucket of a band every member is
compared with one centre, not with every other. Buckets whose members the links leave in
different classes are gone through again. Members of a bucket's largest class need no comparison
with each other, so all that lie outside it become centres, and meet the others once, in blocks;
a block gives links only. If there are too many outside, the members are dealt out by their
rarest shingles, so many that similar texts share one of them, after that centres are taken from
outside the largest class, twice as many a round, until few are left. No pair that shares a band
is lost, and none is written but links. Texts are hashed once before they meet; a block counts
what each two texts share by products of matrices, which decides for texts without repeated
shingles, and rules out most of the others. Hot buckets are only ever aggregated with partial
sums, cut into blocks, or joined on a key that adaptive execution splits.

Defined cases: a text without a word (null, empty) and a row with a null id are linked to
nothing; the first is its own class, the second has the class null. A text of fewer than five
words is one shingle. Rows of one doc_id are one record. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolepulse.llm.graphs import components
from rolepulse.llm.texts import ROWS_AT_ONCE, by_rows, mix, sequence_hash, stored, table, utf8, words

SHINGLE = 5
SIMILAR = 0.8
REGISTERS, BANDS = 64, 16
#: Members of a bucket outside its largest class up to which all of them are centres in one round.
SMALL = 1 << 14
#: Centres, and members, of a bucket that meet in one task, and their shingles; about.
CHUNK, VOLUME = 1024, 1 << 20
#: Larger buckets are dealt out by shingles, unless this is 0.
LEVELS = 1
#: Counters that tell rare shingles from frequent ones; a power of two.
COUNTERS = 1 << 16
#: Bytes of texts that are hashed at once, unless one text is longer; their arrays stay in a core's cache.
BYTES_AT_ONCE = 1 << 18
#: Shingles in a product of matrices.
WIDTH = 2048


def shingles(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles in order, and their weights."""
    h, times, _ = all_shingles([found])
    return h, 1 + np.log(times)


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    """(doc_id, texts) of a few rows at once, from batches of doc_id and text."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            ids, texts = batch.column(0).slice(at, ROWS_AT_ONCE), utf8(batch.column(1).slice(at, ROWS_AT_ONCE))
            begin, size = 0, 0
            for end, text in enumerate(texts):
                if end > begin and size + len(text or b"") > BYTES_AT_ONCE:
                    yield ids.slice(begin, end - begin), texts[begin:end]
                    begin, size = end, 0
                size += len(text or b"")
            yield ids.slice(begin), texts[begin:]


def all_shingles(found: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`shingles` hashes of each text, one after the other: the hashes, how often each is there, and how many each text has."""
    length = np.fromiter(map(len, found), np.int64, len(found))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(found)), np.uint64, length.sum())
    runs = sequence_hash(hashes, SHINGLE)
    size = np.where(length < SHINGLE, np.minimum(length, 1), length - SHINGLE + 1)
    first, word = np.cumsum(size) - size, np.cumsum(length) - length
    h = np.empty(size.sum(), np.uint64)
    for n, many, at, begin in zip(length.tolist(), size.tolist(), first.tolist(), word.tolist()):
        one = h[at:at + many]
        one[:] = runs[begin:begin + many] if n >= SHINGLE else sequence_hash(hashes[begin:begin + n], n)
        one.sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[first[size > 0]] = True
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), np.diff(np.searchsorted(at, np.append(first, len(h))))


def signature(h: np.ndarray, weight: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first at each register."""
    return signatures(h, weight, np.array([len(h)]), registers)[0]


def signatures(h: np.ndarray, weight: np.ndarray, size: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The signature of each text; the shingles lie one after the other, ``size`` of each text."""
    texts = len(size)
    first, who = np.full(texts * registers, np.inf), np.zeros(texts * registers, np.uint64)
    text, at, last, drawn = np.repeat(np.arange(texts), size), np.zeros(len(h)), np.full(texts, np.inf), 0
    while len(h):
        # the next arrivals of every process that may still be early, several at once if few are left
        many = max(1, min(512, 8 * registers * (1 + np.count_nonzero(np.diff(text))) // len(h)))
        seeds = mix(np.arange(drawn, drawn + many, dtype=np.uint64))
        bits = mix(h[:, None] ^ seeds[None, :])
        wait = -np.log(((bits >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)) / weight[:, None]
        when = at[:, None] + (np.cumsum(wait, axis=1) if many > 1 else wait)
        at = when[:, -1]
        row, column = np.nonzero(when < last[text][:, None])
        w, e = when[row, column], h[row]
        r = text[row] * registers + (bits[row, column] & np.uint64(registers - 1)).astype(np.int64)
        np.minimum.at(first, r, w)
        won = first[r] == w
        who[r[won]] = e[won]
        last = first.reshape(texts, registers).max(axis=1)
        alive = at < last[text]
        h, weight, text, at, drawn = h[alive], weight[alive], text[alive], at[alive], drawn + many
    return who.reshape(texts, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of probability Jaccard and plain Jaccard."""
    (ha, wa), (hb, wb) = a, b
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(ha) + len(hb) - len(both))
    u, v = wa[ia], wb[ib]
    if (u == v).all() and np.ptp(wa) == 0 and np.ptp(wb) == 0:
        return plain
    # sum over d of 1 / sum over e of max(u_e / u_d, v_e / v_d); the larger side of e depends on its ratio alone
    order = np.argsort(u / v)
    u, v, ratio = u[order], v[order], (u / v)[order]
    lower = np.searchsorted(ratio, ratio, "left")
    v_below = np.append(0, np.cumsum(v))[lower] + (wb.sum() - v.sum())
    u_above = wa.sum() - np.append(0, np.cumsum(u))[lower]
    return max(plain, float((1 / (u_above / u + v_below / v)).sum()))


def likeness(h: np.ndarray, times: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the texts ``a`` with each of ``b``: the plain Jaccard, and what their similarity is at most.

    A text x of weight X and a text y of weight Y share the shingles d. The term of d in the
    probability Jaccard is at most the harmonic sum of x_d / X and y_d / (Y - shared weight of y).
    Such sums are concave, so all terms together are at most that of the sums: with p and q, the
    shared parts of X and Y, 1 / (1 / p + 1 / q - 1). Without repeated shingles that is the plain Jaccard.
    """
    text, weight = np.repeat(np.arange(len(size)), size), 1 + np.log(times)
    total = np.maximum(np.bincount(text, weight, len(size)), 1)
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    place = np.cumsum(new) - 1
    some = np.bincount(place) > 1
    order, place = order[some[place]], (np.cumsum(some) - 1)[place[some[place]]]  # of shingles in several texts
    plain, repeats = np.zeros((len(a), len(b))), bool((times > 1).any())
    p, q = np.zeros_like(plain), np.zeros_like(plain)
    for at in range(0, int(some.sum()), WIDTH):
        few = slice(*np.searchsorted(place, (at, at + WIDTH)))
        there = np.zeros((len(size), min(WIDTH, int(some.sum()) - at)), np.float32)
        there[text[order[few]], place[few] - at] = 1
        plain += there[a] @ there[b].T
        if repeats:
            heavy = np.zeros_like(there)
            heavy[text[order[few]], place[few] - at] = weight[order[few]]
            p += heavy[a] @ there[b].T
            q += there[a] @ heavy[b].T
    plain /= np.maximum(size[a][:, None] + size[b][None, :] - plain, 1)
    if not repeats:
        return plain, plain
    p, q = p / total[a][:, None], q / total[b][None, :]
    return plain, np.maximum(plain, p * q / np.maximum(p + q - p * q, 1e-300))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64())] + [(f"b{i}", pa.int64()) for i in range(BANDS)])


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the words and a hash for each band, of rows with an id; the digest is null without a word."""
    def sign(batches):
        for ids, texts in portions(batches):
            found = [words(t) for t in texts]
            h, times, size = all_shingles(found)
            bands = sequence_hash_rows(signatures(h, 1 + np.log(times), size).reshape(len(size), BANDS, -1)).view(np.int64)
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(f)) for f in found), np.int64).reshape(-1, 2)
            columns = np.hstack([digests, bands]).T
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), *(pa.array(np.ascontiguousarray(c), mask=size == 0) for c in columns)], schema=_SIGNED)

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(sign, ", ".join(f"{n} long" for n in _SIGNED.names))


def sequence_hash_rows(rows: np.ndarray) -> np.ndarray:
    """A hash of each band's registers and the band's number; bands and registers are the last two axes."""
    with np.errstate(over="ignore"):
        h = np.arange(rows.shape[-2], dtype=np.uint64)
        for j in range(rows.shape[-1]):
            h = mix(h * np.uint64(0x9DDFEA08EB382D69) + rows[..., j])
    return h


def hashed(texts: DataFrame) -> DataFrame:
    """doc_id, the number of shingles of a text (doc_id, text), the shingles, and how often each is there; the last is empty if each is there once."""
    def split(batches):
        for ids, found in portions(batches):
            h, times, size = all_shingles([words(t) for t in found])
            end = np.cumsum(size).tolist()
            shingled = [h[i - n:i].tobytes() for i, n in zip(end, size.tolist())]
            often = [times[i - n:i].astype(np.uint32).tobytes() if n and times[i - n:i].max() > 1 else b"" for i, n in zip(end, size.tolist())]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(size), pa.array(shingled, pa.binary()), pa.array(often, pa.binary())], ["doc_id", "size", "shingles", "times"])

    return texts.select("doc_id", "text").mapInArrow(split, "doc_id long, size long, shingles binary, times binary")


def repeated(shingled: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a row of :func:`hashed`, and how often each is there."""
    h = np.frombuffer(shingled, np.uint64)
    return h, np.frombuffer(times, np.uint32) if times else np.ones(len(h), np.uint32)


def weighted(shingled: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a row of :func:`hashed`, and their weights."""
    h, often = repeated(shingled, times)
    return h, 1 + np.log(often)


def verified(pairs: DataFrame, own: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The (u, v) of ``pairs`` whose texts are similar; a node is in ``own`` (as of :func:`hashed`) once."""
    def named(node):
        return own.select(F.col("doc_id").alias(node), F.col("shingles").alias(f"shingles_{node}"), F.col("times").alias(f"times_{node}"))

    both = pairs.join(named("v"), "v").join(named("u"), "u").select("u", "v", "shingles_u", "times_u", "shingles_v", "times_v")

    def judge(batch):
        last, mine = None, None
        for u, v, a, m, b, n in zip(*(c.to_pylist() for c in batch.columns)):
            if not m and not n and min(len(a), len(b)) < least * max(len(a), len(b)):
                continue  # each shingle once: the smaller set is too small
            if u != last:
                last, mine = u, weighted(a, m)
            if similarity(mine, weighted(b, n)) >= least:
                yield u, v

    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    return both.mapInArrow(by_rows(judge, schema), "u long, v long")


def compared(groups: DataFrame, own: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(u, v): labels whose members in ``groups`` (key, block, doc_id, label, centre, row, column) are linked, enough of them to join all classes that are linked there.

    The centres in the row of a block are compared with all that are in its column, unless labels or
    links found before have put the two in one class.
    """
    def judge(keys, rows):
        ids, up, found = rows.column("doc_id").to_numpy(), {}, []
        label, centre = rows.column("label").to_numpy(), rows.column("centre").to_numpy()
        a, b = np.flatnonzero(rows.column("row").to_numpy()), np.flatnonzero(rows.column("column").to_numpy())
        # two centres meet in two blocks
        apart = (label[a][:, None] != label[b][None, :]) & (~centre[b][None, :] | (ids[a][:, None] < ids[b][None, :]))
        if apart.any():
            both = [repeated(s, t) for s, t in zip(rows.column("shingles").to_pylist(), rows.column("times").to_pylist())]
            size = np.array([len(h) for h, _ in both])
            once = np.array([len(h) == 0 or t.max() == 1 for h, t in both])
            plain, most = likeness(np.concatenate([h for h, _ in both]), np.concatenate([t for _, t in both]), size, a, b)
            sure = plain >= least
            # what is not sure is judged by itself, unless it can't be similar; matrices are of 32 bits
            maybe = apart & (sure | ~(once[a][:, None] & once[b][None, :]) & (most >= least - 1e-4))

            def root(x):
                while (y := up.setdefault(x, x)) != x:
                    up[x] = x = up[y]
                return x

            for i, j in np.argwhere(maybe).tolist():
                x, y = root(int(label[a[i]])), root(int(label[b[j]]))
                if x != y and (sure[i, j] or similarity(*((both[k][0], 1 + np.log(both[k][1])) for k in (a[i], b[j]))) >= least):
                    up[max(x, y)] = min(x, y)
                    found.append((min(x, y), max(x, y)))
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return groups.join(own.drop("size"), "doc_id").groupBy("key", "block").applyInArrow(judge, "u long, v long")


def blocks(members: DataFrame) -> DataFrame:
    """The rows of ``compared``, of ``members`` (key, doc_id, label, centre, n, volume, centres, centres_volume).

    A bucket has n members of ``volume`` shingles; about CHUNK of its centres and CHUNK of its
    members meet in a block, fewer if they are long.
    """
    def parts(n, volume):
        return F.greatest(F.ceil(F.col(n) / CHUNK), F.ceil(F.col(volume) / VOLUME)).cast("int")

    placed = members.withColumns({"rows": parts("centres", "centres_volume"), "columns": parts("n", "volume")}).withColumns({
        "own_row": F.pmod(F.xxhash64("doc_id", F.lit(-2)), "rows").cast("int"), "own_column": F.pmod(F.xxhash64("doc_id", F.lit(-1)), "columns").cast("int")})
    in_row = "transform(sequence(0, columns - 1), x -> struct(own_row * columns + x AS block, true AS row, x = own_column AS column))"
    in_column = "transform(filter(sequence(0, rows - 1), x -> NOT centre OR x <> own_row), x -> struct(x * columns + own_column AS block, false AS row, true AS column))"
    met = placed.select("key", "doc_id", "label", "centre", F.explode(F.expr(f"IF(centre, concat({in_row}, {in_column}), {in_column})")).alias("met"))
    return met.select("key", "met.block", "doc_id", "label", "centre", "met.row", "met.column")


def one_row_each(docs: DataFrame) -> DataFrame:
    """One row for each doc_id that is not null: that of the least text, then of the least hash of its columns."""
    place = "place"
    while place in docs.columns:
        place += "_"
    order = Window.partitionBy("doc_id").orderBy("text", F.xxhash64(*docs.columns))
    return docs.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)


def counted(own: DataFrame, many: int) -> np.ndarray:
    """How many shingles of ``own`` (as of :func:`hashed`) fall on each counter: at most ``many`` numbers reach the driver."""
    def count(batches):
        times = np.zeros(many, np.int64)
        for batch in batches:
            for shingled in batch.column(0).to_pylist():
                np.add.at(times, counters(np.frombuffer(shingled, np.uint64), many), 1)
        some = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(times[some])], ["counter", "times"])

    rows = own.select("shingles").mapInArrow(count, "counter long, times long").groupBy("counter").agg(F.sum("times").alias("times")).toArrow()
    out = np.zeros(many, np.int64)
    out[rows["counter"].to_numpy()] = rows["times"].to_numpy()
    return out


def counters(h: np.ndarray, many: int) -> np.ndarray:
    return (h & np.uint64(many - 1)).astype(np.int64)


def dealt(members: DataFrame, texts: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(key, doc_id): a bucket for each shingle; any two similar texts of ``members`` (doc_id) are in one together.

    ``texts`` are (doc_id, text), or what :func:`hashed` made of them.

    What a text holds besides the shingles of a similar one is at most 1 - ``least`` of its weight
    (or of their number). So the first shingle that both have, in one order for all texts, comes in
    either before more than that. Counters put rare shingles first, which keeps buckets small; a
    shingle that its counter has seen once is in one text only.
    """
    own = (hashed(texts) if "text" in texts.columns else texts).join(members.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "shingles", "times")
    times = counted(own, COUNTERS)

    def split(batch):
        for doc_id, *own_shingles in zip(*(c.to_pylist() for c in batch.columns)):
            h, weight = weighted(*own_shingles)
            n = times[counters(h, len(times))]
            order = np.lexsort((h, n))
            weight = (weight / weight.sum())[order]
            before = np.minimum(np.cumsum(weight) - weight, np.arange(len(h)) / max(1, len(h)))
            for key in h[order[(before <= 1 - least + 1e-9) & (n[order] > 1)]].view(np.int64).tolist():
                yield key, doc_id

    return own.mapInArrow(by_rows(split, pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])), "key long, doc_id long")


def links(nodes: DataFrame, docs: DataFrame, least: float = SIMILAR, known: DataFrame | None = None) -> DataFrame:
    """(node, least node) of all nodes that the links of ``nodes`` (doc_id and bands), and those that are ``known`` (u, v), put in a class of a smaller one."""
    bands = nodes.select("doc_id", F.array(*[f"b{i}" for i in range(BANDS)]).alias("bands"))
    keys = bands.select("doc_id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("u")).where("n > 1")
    live = stored(keys.join(buckets, "key").select("key", "doc_id", "u"), "buckets")
    pairs = live.where("doc_id <> u").select("u", F.col("doc_id").alias("v")).distinct()
    needed = live.select("doc_id").distinct()
    own = stored(hashed(one_row_each(docs.select("doc_id", "text").join(needed, "doc_id", "left_semi"))), "candidate-shingles")
    found = stored(verified(pairs, own, least), "links")
    labels, level, centres = components(found if known is None else found.union(known)), 0, SMALL

    def named(members):
        with_size = members.select("key", "doc_id").join(own.select("doc_id", "size"), "doc_id")
        return with_size.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", "size", F.coalesce("least", "doc_id").alias("label"))

    live = named(live.where("doc_id <> u"))  # the centre has met all the others
    while True:
        sizes = live.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("size").alias("volume"), F.min("doc_id").alias("one"))
        open_keys = (sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum("volume").alias("volume"), F.max(F.struct("n", "label", "volume")).alias("largest"),
                                              F.min(F.struct("n", "one")).alias("rarest"))
                     .select("key", "n", "volume", (F.col("n") - F.col("largest.n")).alias("outside"), (F.col("volume") - F.col("largest.volume")).alias("outside_volume"),
                             F.col("largest.label").alias("largest"), F.col("rarest.one").alias("u"))
                     .where("outside > 0"))
        left = stored(live.join(open_keys, "key"), "open-buckets")
        if left.isEmpty():
            return labels
        few, many = left.where(F.col("outside") <= SMALL), left.where(F.col("outside") > SMALL)
        met = few.withColumns({"centre": F.col("label") != F.col("largest"), "centres": F.col("outside"), "centres_volume": F.col("outside_volume")})
        level += 1
        finer = level == 1 and LEVELS
        if finer:
            live = stored(dealt(many, own, least), "finer-buckets")
        else:
            # the one of the rarest class, and about `centres` others outside the largest
            chosen = (F.col("label") != F.col("largest")) & (F.pmod(F.xxhash64("doc_id", F.lit(level)), F.ceil(F.col("outside") / centres)) == 0) | (F.col("doc_id") == F.col("u"))
            share = F.least(F.lit(1.0), centres / F.col("outside"))
            met = met.union(many.withColumns({"centre": chosen, "centres": share * F.col("outside"), "centres_volume": share * F.col("outside_volume")}))
            live, centres = many.where(~chosen).select("key", "doc_id", "size", "label"), 2 * centres
        more = stored(compared(blocks(met), own, least), "links")
        moved = None if more.isEmpty() else components(more)
        if moved is not None:
            # only labels were joined: a class moves as a whole
            to = moved.select(F.col("node").alias("label"), F.col("least").alias("to"))
            labels = stored(labels.withColumnRenamed("least", "label").join(to, "label", "left").select("node", F.coalesce("to", "label").alias("least")).union(moved), "labels")
            if not finer:
                live = live.join(to, "label", "left").select("key", "doc_id", "size", F.coalesce("to", "label").alias("label"))
        if finer:
            live = named(live)


def classes(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """doc_id and class_id of each row."""
    rows = stored(signed(docs), "signatures")
    copies = (rows.where("d0 IS NOT NULL").groupBy("d0", "d1")
              .agg(F.min("doc_id").alias("doc_id"), *[F.first(f"b{i}").alias(f"b{i}") for i in range(BANDS)]))
    copies = stored(copies, "word-sequences")
    # a word sequence is seen through its least id; an id with several sequences links theirs
    seen = rows.where("d0 IS NOT NULL").join(copies.select("d0", "d1", F.col("doc_id").alias("seen")), ["d0", "d1"]).select("doc_id", "seen")
    seen = stored(seen, "seen-through")
    least_seen = seen.groupBy("doc_id").agg(F.min("seen").alias("least"), F.max("seen").alias("most"))
    several = seen.join(least_seen.where("least < most"), "doc_id").where("seen <> least").select(F.col("least").alias("u"), F.col("seen").alias("v"))
    linked = links(copies, docs, least, several)
    named = least_seen.select("doc_id", F.col("least").alias("node")).join(linked, "node", "left").select("doc_id", F.coalesce("least", "node").alias("class"))
    out = rows.select("doc_id").join(named, "doc_id", "left").select("doc_id", F.coalesce("class", "doc_id").alias("class_id"))
    return out.union(docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id")))


def deduplicated(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their class; one row of each class stays."""
    gone = classes(docs, least).where("doc_id <> class_id").select("doc_id").distinct()
    kept = one_row_each(docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti"))
    return kept.select(docs.columns).union(docs.where("doc_id IS NULL"))


def op5_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))

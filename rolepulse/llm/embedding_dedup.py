"""Embedding near-duplicates by an epsilon grid order join.

Equal vectors of one label are collapsed first, so that copies are a count and not pairs. What is
left is turned to its principal axes and sorted by label, length and the cells of an epsilon grid on
the leading axes; epsilon is the distance of two unit vectors whose cosine is the threshold. The
sequence is cut into tiles, and a tree of intervals of the sequence, each with the box of its
coordinates, is laid over them. The join goes down this tree from the pair (root, root): a pair of
intervals is replaced by the pairs of their children, and pairs whose boxes are more than epsilon
apart, or whose labels do not overlap, are dropped. Every level is one Spark join on the parents'
numbers. What remains are pairs of tiles; a task goes on in the same way inside a pair, halving the
intervals, and compares what is left by one matrix product in double precision.

No pairs of vectors leave a task: of each pair of tiles come, for each vector with a link, how many
vectors it is linked with there, and one vector that stands for its part of the links. Counts are
summed; the parts are edges whose connected components are the components of all links.

Defined cases: vectors that are null, empty, zero, of a null label, or hold a null or non-finite
component link with nothing: no link, a component of their own. Vectors of different lengths do not
link. Repeated rows are rows of their own, linked to each other. Rows of one vec_id with different
vectors are nodes of their own; ``kept`` is true for each of them if the id is the least of their
components. A null vec_id is never the least; the component of null ids alone is null, its rows are
kept. Without rows there are none in the result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rolepulse.llm.graphs import components
from rolepulse.llm.texts import stored, table
from rolepulse.llm.vectors import binaries, matrices, packed

SIMILAR = 0.98
#: Leading principal axes that the grid and the boxes use.
AXES = 8
#: Vectors in a tile, children of an interval, vectors of an interval that is compared as a whole.
TILE = 512
FAN = 16
STRIP = 64
#: Pairs of tiles that are in a Python worker at once.
PAIRS_AT_ONCE = 16
#: Cosines this near to the threshold are computed again with exactly rounded sums.
_CLOSE = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their norms; first by a power of two, so that no square overflows."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def keyed_rows(embeddings: DataFrame) -> tuple[DataFrame, str]:
    """vec_id, label, length, digest and vector (packed) of each row, and how vectors are packed; digest is null for rows that link with nothing."""
    dtype = "<f4" if isinstance(embeddings.schema["embedding"].dataType.elementType, FloatType) else "<f8"
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("length", pa.int32()), ("digest", pa.binary()), ("vector", pa.binary())])

    def run(batches):
        for batch in batches:
            digest, vector, length = [None] * batch.num_rows, [None] * batch.num_rows, np.zeros(batch.num_rows, np.int32)
            labelled = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            for rows, values in matrices(batch.column(1)):
                if not values.shape[1]:
                    continue
                good = labelled[rows] & np.isfinite(values).all(1) & (values != 0).any(1)
                length[rows] = values.shape[1]
                for i, x in zip(rows[good], packed((values[good] + 0.0).astype(dtype))):  # + 0.0: there is one zero
                    digest[i], vector[i] = hashlib.blake2b(x, digest_size=16).digest(), x
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(length), pa.array(digest, pa.binary()), pa.array(vector, pa.binary())], schema=schema)

    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("long"))
    return rows.mapInArrow(run, "vec_id long, label long, length int, digest binary, vector binary"), dtype


def principal_axes(points: DataFrame, dtype: str) -> tuple[int, np.ndarray]:
    """The commonest length, and the leading principal axes of the unit vectors of that length, as columns.

    A task sends the sums of its products; the sums of all tasks, one for each pair of components,
    are what the driver gets.
    """
    commonest = points.groupBy("length").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").first()
    n = commonest["length"]
    schema = pa.schema([("place", pa.int32()), ("total", pa.float64())])

    def run(batches):
        total = np.zeros((n + 1, n))
        for batch in batches:
            if batch.num_rows:
                x = unit(binaries(batch.column(0), dtype, n).astype(np.float64))
                total[:n] += x.T @ x
                total[n] += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], schema=schema)

    sums = points.where(F.col("length") == n).select("vector").mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    total = np.zeros((n + 1) * n)
    for r in sums.collect():
        total[r["place"]] = r["total"]
    total = total.reshape(n + 1, n) / commonest["n"]
    values, axes = np.linalg.eigh(total[:n] - np.outer(total[n], total[n]))
    return n, np.ascontiguousarray(axes[:, np.argsort(-values)][:, :AXES])


def coordinates(x: np.ndarray, length: int, axes: np.ndarray) -> np.ndarray:
    """AXES coordinates of unit vectors in an orthonormal frame: the principal one, or for other lengths the given one."""
    if x.shape[1] == length:
        x = x @ axes
    out = np.zeros((len(x), AXES))
    out[:, :x.shape[1]] = x[:, :AXES]
    return out


_BOX = [f"{end}{i}" for end in ("lo", "hi") for i in range(AXES)] + ["label_lo", "label_hi", "length_lo", "length_hi"]


def tiles_of(points: DataFrame, dtype: str, length: int, axes: np.ndarray, epsilon: float) -> DataFrame:
    """The points in epsilon grid order as tiles: tile (0, 1, 2, ... in this order), box, and packed vectors, labels, copies, ids and digests."""
    keyed_schema = pa.schema([("key", pa.binary()), ("label", pa.int64()), ("length", pa.int32()), ("digest", pa.binary()), ("vector", pa.binary()),
                              ("copies", pa.int64()), ("least", pa.int64())])

    def keyed(batches):
        for batch in batches:
            n = batch.column("length").to_numpy()
            for width in np.unique(n):
                rows = batch.take(pa.array(np.flatnonzero(n == width)))
                cells = np.floor(coordinates(unit(binaries(rows.column("vector"), dtype, width).astype(np.float64)), length, axes) / epsilon)
                head = np.stack([rows.column("label").to_numpy() ^ -(1 << 63), rows.column("length").to_numpy().astype(np.int64)], axis=1).astype(">i8")
                ends = (np.clip(cells, -(1 << 15), (1 << 15) - 1).astype(np.int32) + (1 << 15)).astype(">u2")
                keys = [a + b + c for a, b, c in zip(packed(head), packed(ends), rows.column("digest").to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[rows.column(f.name) for f in list(keyed_schema)[1:]]], schema=keyed_schema)

    tile_schema = pa.schema([
        ("part", pa.int32()), ("place", pa.int64()), *[(c, pa.float64()) for c in _BOX[:2 * AXES]], *[(c, pa.int64()) for c in _BOX[2 * AXES:]],
        *[(c, pa.binary()) for c in ("vectors", "labels", "copies", "digests")], ("ids", pa.list_(pa.int64()))])

    def cut(batches):
        from pyspark import TaskContext

        part, place, rows = TaskContext.get().partitionId(), 0, []

        def one():
            label, width, digest, vector, copies, least = zip(*rows)
            x = coordinates(unit(np.frombuffer(b"".join(vector), dtype).reshape(len(rows), -1).astype(np.float64)), length, axes)
            box = dict(zip(_BOX, [*x.min(0).tolist(), *x.max(0).tolist(), min(label), max(label), width[0], width[0]]))
            return pa.RecordBatch.from_pylist([box | {
                "part": part, "place": place, "vectors": b"".join(vector), "labels": np.array(label, "<i8").tobytes(),
                "copies": np.array(copies, "<i8").tobytes(), "digests": b"".join(digest), "ids": list(least)}], schema=tile_schema)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("label", "length", "digest", "vector", "copies", "least")]):
                if rows and (len(rows) == TILE or row[1] != rows[0][1]):
                    yield one()
                    place, rows = place + 1, []
                rows.append(row)
        if rows:
            yield one()

    columns = ("label", "length", "digest", "vector", "copies", "least")
    ordered = points.mapInArrow(keyed, "key binary, label long, length int, digest binary, vector binary, copies long, least long")
    ordered = ordered.repartitionByRange("key").sortWithinPartitions("key").select(*columns)
    shape = ("part int, place long, " + ", ".join(f"{c} double" for c in _BOX[:2 * AXES]) + ", " + ", ".join(f"{c} long" for c in _BOX[2 * AXES:])
             + ", vectors binary, labels binary, copies binary, digests binary, ids array<long>")
    tiles = stored(ordered.mapInArrow(cut, shape), "tiles")
    # A row for each partition.
    before, starts = 0, []
    for r in tiles.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["n"]
    start = tiles.sparkSession.createDataFrame(starts, "part int, start long")
    return tiles.join(F.broadcast(start), "part").withColumn("tile", F.col("start") + F.col("place")).drop("part", "place", "start")


def apart(epsilon: float) -> str:
    """SQL: whether no vector of the interval a can link with one of b."""
    gaps = [f"greatest(a.lo{i} - b.hi{i}, b.lo{i} - a.hi{i}, 0)" for i in range(AXES)]
    far = " + ".join(f"{g} * {g}" for g in gaps)
    no_overlap = [f"a.{c}_lo > b.{c}_hi OR b.{c}_lo > a.{c}_hi" for c in ("label", "length")]
    return f"{' OR '.join(no_overlap)} OR {far} > {epsilon * epsilon}"


def near_pairs(tiles: DataFrame, epsilon: float) -> DataFrame:
    """(a, b), a <= b: the pairs of tiles that the recursive join of the sequence with itself leaves."""
    levels = [stored(tiles.select(F.col("tile").alias("node"), *_BOX), "intervals")]
    nodes = levels[0].count()
    while nodes > 1:
        ends = [F.min(c).alias(c) if c.startswith("lo") or c.endswith("_lo") else F.max(c).alias(c) for c in _BOX]
        above = levels[-1].groupBy(F.expr(f"node div {FAN}").alias("node")).agg(*ends)
        levels.append(stored(above, "intervals"))
        nodes = -(-nodes // FAN)
    pairs = levels.pop().select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels):
        children = level.withColumn("parent", F.expr(f"node div {FAN}"))
        a, b = children.alias("a"), children.alias("b")
        both = pairs.alias("p").join(a, F.expr("a.parent = p.a")).join(b, F.expr("b.parent = p.b"))
        pairs = stored(both.where(F.expr(f"a.node <= b.node AND NOT ({apart(epsilon)})")).select(F.expr("a.node AS a"), F.expr("b.node AS b")), "near-pairs")
    return pairs


def joined(xa, xb, epsilon: float):
    """Index ranges (i0, i1, j0, j1) that remain of two sequences of coordinates; halves that are more than epsilon apart are skipped."""
    todo = [(0, len(xa), 0, len(xb))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        a, b = xa[i0:i1], xb[j0:j1]
        gap = np.maximum(np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)), 0)
        if (gap * gap).sum() > epsilon * epsilon:
            continue
        if max(i1 - i0, j1 - j0) <= STRIP:
            yield i0, i1, j0, j1
        elif i1 - i0 >= j1 - j0:
            half = (i0 + i1) // 2
            todo += [(i0, half, j0, j1), (half, i1, j0, j1)]
        else:
            half = (j0 + j1) // 2
            todo += [(i0, i1, j0, half), (i0, i1, half, j1)]


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine from exactly rounded sums of products."""
    x, y = (np.ldexp(v, -np.frexp(np.abs(v).max())[1]) for v in (x, y))
    dot, xx, yy = (math.fsum((a * b).tolist()) for a, b in ((x, y), (x, x), (y, y)))
    return dot / math.sqrt(xx * yy)


def linked(raw_a, raw_b, label_a, label_b, xa, xb, same: bool, least: float, epsilon: float) -> np.ndarray:
    """Matrix of the links between two tiles; with itself, not on the diagonal."""
    a, b = unit(raw_a), unit(raw_b)
    out = np.zeros((len(a), len(b)), bool)
    for i0, i1, j0, j1 in joined(xa, xb, epsilon):
        s = a[i0:i1] @ b[j0:j1].T
        hit = s >= least
        for i, j in zip(*np.nonzero(np.abs(s - least) < _CLOSE)):
            hit[i, j] = cosine(raw_a[i0 + i], raw_b[j0 + j]) >= least
        out[i0:i1, j0:j1] = hit & (label_a[i0:i1, None] == label_b[j0:j1])
    if same:
        out |= out.T
        np.fill_diagonal(out, False)
    return out


def parts(links: np.ndarray, name_a: np.ndarray, name_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and the columns of a matrix of links the least name among those connected with them."""
    most = np.iinfo(np.int64).max
    name_a, name_b = name_a.copy(), name_b.copy()
    while True:
        new_b = np.minimum(name_b, np.where(links, name_a[:, None], most).min(0, initial=most))
        new_a = np.minimum(name_a, np.where(links, new_b, most).min(1, initial=most))
        if (new_a == name_a).all() and (new_b == name_b).all():
            return new_a, new_b
        name_a, name_b = new_a, new_b


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Jobs started inside send ``n`` rows at once to a Python worker, since a row holds two tiles."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tile_links(tiles: DataFrame, pairs: DataFrame, dtype: str, length: int, axes: np.ndarray, least: float, epsilon: float) -> DataFrame:
    """node, n, other: how many vectors the node is linked with in a pair of tiles, and a node of the same component of links."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])

    def run(batches):
        for batch in batches:
            for ta, tb, width, *data in zip(*[batch.column(c).to_pylist() for c in (
                    "a", "b", "length_lo", "vectors_a", "vectors_b", "labels_a", "labels_b", "copies_a", "copies_b")]):
                raw_a, raw_b = (np.frombuffer(x, dtype).reshape(-1, width).astype(np.float64) for x in data[:2])
                label_a, label_b, copies_a, copies_b = (np.frombuffer(x, "<i8") for x in data[2:])
                xa, xb = (coordinates(unit(x), length, axes) for x in (raw_a, raw_b))
                links = linked(raw_a, raw_b, label_a, label_b, xa, xb, ta == tb, least, epsilon)
                ia, jb = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
                links = links[np.ix_(ia, jb)]
                part_a, part_b = parts(links, ta * TILE + ia, tb * TILE + jb)
                yield pa.RecordBatch.from_arrays([pa.array(ta * TILE + ia), pa.array(links @ copies_b[jb]), pa.array(part_a)], schema=schema)
                if ta != tb:
                    yield pa.RecordBatch.from_arrays([pa.array(tb * TILE + jb), pa.array(copies_a[ia] @ links), pa.array(part_b)], schema=schema)

    columns = ("vectors", "labels", "copies")
    side = lambda s: tiles.select(F.col("tile").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns], *([F.col("length_lo")] if s == "a" else []))
    # The length of tile b is that of a: other pairs are not near.
    rows = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "node long, n long, other long")
    with arrow_rows(tiles.sparkSession, PAIRS_AT_ONCE):
        return stored(rows, "tile-links")


def nodes_of(tiles: DataFrame) -> DataFrame:
    """node, digest, label, length, copies and least id of each point."""
    schema = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("label", pa.int64()), ("length", pa.int32()), ("copies", pa.int64()), ("least_id", pa.int64())])

    def run(batches):
        for batch in batches:
            for tile, length, labels, copies, digests, ids in zip(*[c.to_pylist() for c in batch.columns]):
                n = len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array(tile * TILE + np.arange(n)), pa.array([digests[16 * i:16 * i + 16] for i in range(n)], pa.binary()), pa.array(np.frombuffer(labels, "<i8")),
                    pa.array(np.full(n, length, np.int32)), pa.array(np.frombuffer(copies, "<i8")), pa.array(ids, pa.int64())], schema=schema)

    return tiles.select("tile", "length_lo", "labels", "copies", "digests", "ids").mapInArrow(
        run, "node long, digest binary, label long, length int, copies long, least_id long")


def near_duplicates(embeddings: DataFrame, least: float = SIMILAR) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row."""
    # What rounding may add to a coordinate is far below the margin.
    epsilon = math.sqrt(2 - 2 * least) + 1e-6
    rows, dtype = keyed_rows(embeddings)
    same = ["label", "length", "digest"]
    points = stored(rows.where("digest IS NOT NULL").groupBy(*same).agg(
        F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "points")
    alone = F.col("vec_id").alias("component_id")
    if points.isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), alone, F.lit(True).alias("kept"))
    length, axes = principal_axes(points, dtype)
    tiles = tiles_of(points, dtype, length, axes, epsilon)
    found = tile_links(tiles, near_pairs(tiles, epsilon), dtype, length, axes, least, epsilon)
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    classes = components(found.where("node <> other").select(F.col("node").alias("u"), F.col("other").alias("v")).distinct(), "vector-classes")
    named = (nodes_of(tiles).join(counts, "node", "left").join(classes, "node", "left")
             .select(*same, "least_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("least", "node").alias("class")))
    ids = named.groupBy("class").agg(F.min("least_id").alias("component"))
    told = named.join(ids, "class").select(*same, "n_links", "component")
    both = rows.drop("vector").join(told, same, "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return both.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                       F.col("vec_id").eqNullSafe(component).alias("kept"))


def op12_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs of a label; the components by going on from link to link.
OP12_SQL = f"""
WITH RECURSIVE good AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {SIMILAR}),
reached AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reached r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS component_id FROM reached GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.u = e.vec_id LEFT JOIN counts c ON c.u = e.vec_id
"""

"""Centroid clustering of vectors that lie in Hilbert order in blocks with min/max boxes.

Vectors become whole numbers, floor(64 x) of each component. They are sorted once along a Hilbert
curve over a grid of all components and cut into blocks, each with the least and largest value of
every component (a zone map). In a round a block first compares its box with the centroids: no
centroid whose least possible distance exceeds another one's largest possible distance can be the
nearest of any vector of the block. The exact comparison, vectorised over the block, is with the
centroids that are left. All arithmetic is exact: int64, or float64 where every intermediate value is
a whole number below 2^53.

Per round a task sends one sum for each centroid and component; what returns to the driver are the
centroids. Equal vectors are dealt over several partitions by their place in the input, so a vector
that a third of all rows share is no hot key.

Defined cases: a null vector, one of another length than DIMS, or with a null or non-finite component
is left out; so is one with a component beyond +-2^27 after scaling, whose squared distances would
not fit a long. Fewer vectors than CENTROIDS give as many centroids as there are vectors; without
vectors there are no rows. Repeated rows are rows of their own; of rows of one vec_id the least
components come first among the initial centroids; a null vec_id is hashed as ``1:null``. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.texts import stored, table
from rolepulse.llm.vectors import binaries, matrices, packed

DIMS = 64
CENTROIDS = 16
ROUNDS = 3
SEED = "1"
SCALE = 64
#: Bits of the Hilbert grid per component; vectors in a block.
GRID_BITS = 4
BLOCK = 256

MOST = 1 << 27
#: Squared distances of components up to this are exact in float64.
_FLOAT_SAFE = 1 << 22


def whole_vectors(embeddings: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and components (``dims`` int32 as a binary) of the vectors that are kept."""
    schema = pa.schema([("vec_id", pa.int64()), ("components", pa.binary())])

    def run(batches):
        for batch in batches:
            for rows, values in matrices(batch.column(1)):
                if values.shape[1] != dims:
                    continue
                with np.errstate(invalid="ignore", over="ignore"):
                    scaled = np.floor(values * SCALE)
                    good = (np.abs(scaled) <= MOST).all(axis=1)  # false for what is not finite, too
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[good])), pa.array(packed(scaled[good].astype("<i4")), pa.binary())], schema=schema)

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, components binary")


def first_centroids(vectors: DataFrame, count: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The ``count`` vectors of the smallest hashes of seed and vec_id, as the rows of a matrix."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    first = vectors.select(F.sha2(name, 256).alias("hash"), "components").orderBy("hash", "components").limit(count).collect()
    return np.array([np.frombuffer(r["components"], "<i4") for r in first], np.int64)


def extent(vectors: DataFrame, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest value of each component."""
    schema = pa.schema([("component", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])

    def run(batches):
        lo, hi = np.full(dims, MOST, np.int32), np.full(dims, -MOST, np.int32)
        for batch in batches:
            x = binaries(batch.column(0), "<i4", dims)
            if len(x):
                lo, hi = np.minimum(lo, x.min(0)), np.maximum(hi, x.max(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(lo), pa.array(hi)], schema=schema)

    ends = vectors.select("components").mapInArrow(run, "component int, lo int, hi int")
    rows = ends.groupBy("component").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("component").collect()  # a row each
    return np.array([r["lo"] for r in rows], np.int64), np.array([r["hi"] for r in rows], np.int64)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Where each row of ``cells`` (whole numbers below 2^bits) lies on the Hilbert curve: rows of big-endian bytes.

    Rows are turned back along the curve axis by axis, all rows of the matrix at once.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(n):
            turned = (x[i] & np.uint32(q)) != 0
            swap = np.where(turned, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros(x.shape[1], np.uint32)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flips ^= np.where((x[n - 1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
    x ^= flips
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def blocks_of(vectors: DataFrame, dims: int = DIMS, bits: int = GRID_BITS, block: int = BLOCK) -> DataFrame:
    """The vectors in Hilbert order as blocks: ids, vectors, and the box ``lo`` ... ``hi``, all of them packed."""
    lo, hi = extent(vectors, dims)
    width = np.maximum(hi - lo + 1, 1)
    keyed_schema = pa.schema([("vec_id", pa.int64()), ("components", pa.binary()), ("key", pa.binary())])

    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                x = binaries(batch.column(1), "<i4", dims).astype(np.int64)
                keys = hilbert_keys(((x - lo) << bits) // width, bits)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary()), pa.array(packed(keys), pa.binary())], schema=keyed_schema)

    block_schema = pa.schema([("ids", pa.list_(pa.int64())), ("vectors", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary())])

    def cut(batches):
        ids, rows = [], []

        def one():
            x = np.frombuffer(b"".join(rows[:block]), "<i4").reshape(-1, dims)
            return pa.RecordBatch.from_pylist([{"ids": ids[:block], "vectors": x.tobytes(), "lo": x.min(0).tobytes(), "hi": x.max(0).tobytes()}], schema=block_schema)

        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += batch.column(1).to_pylist()
            while len(rows) >= block:
                yield one()
                del ids[:block], rows[:block]
        if rows:
            yield one()

    # The place in the input parts equal vectors.
    sort = ["key", "row"]
    ordered = (vectors.mapInArrow(keyed, "vec_id long, components binary, key binary").withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange(*sort).sortWithinPartitions(*sort).select("vec_id", "components"))
    return stored(ordered.mapInArrow(cut, "ids array<long>, vectors binary, lo binary, hi binary"), "hilbert-blocks")


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector of the box."""
    near = np.maximum(np.maximum(lo - centroids, centroids - hi), 0)
    far = np.maximum(np.abs(lo - centroids), np.abs(hi - centroids))
    return np.flatnonzero((near * near).sum(1) <= (far * far).sum(1).min())


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers, one column for each centroid."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _FLOAT_SAFE:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def nearest(batch: pa.RecordBatch, centroids: np.ndarray):
    """For each block (vectors, lo, hi) of a batch: its vectors, the number of the nearest centroid and the squared distance."""
    dims = centroids.shape[1]
    for vectors, lo, hi in zip(*[batch.column(c).to_pylist() for c in ("vectors", "lo", "hi")]):
        x = np.frombuffer(vectors, "<i4").reshape(-1, dims).astype(np.int64)
        left = candidates(np.frombuffer(lo, "<i4").astype(np.int64), np.frombuffer(hi, "<i4").astype(np.int64), centroids)
        distance = squared_distances(x, centroids[left])
        best = distance.argmin(1)  # the first, so the smaller number, of equal ones
        yield x, left[best], distance[np.arange(len(x)), best]


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of their vectors, or as before without any."""
    schema = pa.schema([("cluster", pa.int32()), ("component", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])
    count, dims = centroids.shape

    def run(batches):
        n, total = np.zeros(count, np.int64), np.zeros((count, dims), np.int64)
        for batch in batches:
            for x, cluster, _ in nearest(batch, centroids):
                n += np.bincount(cluster, minlength=count)
                for c in np.unique(cluster):
                    total[c] += x[cluster == c].sum(0)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(has, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(has))),
            pa.array(np.repeat(n[has], dims)), pa.array(total[has].ravel())], schema=schema)

    sums = blocks.select("vectors", "lo", "hi").mapInArrow(run, "cluster int, component int, n long, total long").groupBy("cluster", "component").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in sums.collect():  # a row for each centroid and component
        out[r["cluster"], r["component"]] = int(r["total"]) // r["n"]
    return out


def clustered(embeddings: DataFrame, dims: int = DIMS, count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that is kept."""
    vectors = whole_vectors(embeddings, dims)
    centroids = first_centroids(vectors, count, seed)
    result = "vec_id long, cluster int, distance long"
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], f"{result}, cluster_inertia long, inertia long, centroid_sha256 string")
    blocks = blocks_of(vectors, dims)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def run(batches):
        for batch in batches:
            for ids, (_, cluster, distance) in zip(batch.column("ids").to_pylist(), nearest(batch, centroids)):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)], schema=schema)

    told = stored(blocks.mapInArrow(run, result), "assigned-vectors")
    inertia = defaultdict(int, {r["cluster"]: int(r["d"]) for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()})
    each = [(i, inertia[i], sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    of_cluster = told.sparkSession.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # a row for each centroid
    return told.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    parts = [f"""
comp AS MATERIALIZED (
  SELECT r, vec_id, i, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT row_number() OVER () AS r, vec_id, unnest(embedding) AS x, unnest(range({DIMS})) AS i FROM embeddings
        WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS})),
first AS (SELECT DISTINCT r, vec_id FROM comp),
c0 AS MATERIALIZED (
  SELECT k, i, v FROM (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM first) f JOIN comp USING (r) WHERE k < {CENTROIDS})"""]
    for t in range(ROUNDS + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (
  SELECT r, vec_id, k, d FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS place FROM (
      SELECT comp.r, comp.vec_id, c.k, CAST(sum((comp.v - c.v) * (comp.v - c.v)) AS BIGINT) AS d FROM comp JOIN c{t} c ON c.i = comp.i GROUP BY ALL))
  WHERE place = 1)""")
        if t < ROUNDS:
            parts.append(f"""
c{t + 1} AS MATERIALIZED (
  SELECT c.k, c.i, CASE WHEN m.n IS NULL THEN c.v ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v
  FROM c{t} c LEFT JOIN (SELECT a.k, comp.i, CAST(sum(comp.v) AS BIGINT) AS s, count(*) AS n FROM a{t} a JOIN comp USING (r) GROUP BY ALL) m
    ON m.k = c.k AND m.i = c.i)""")
    return "WITH" + ",".join(parts) + f""",
shas AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN shas USING (k)"""


OP11_SQL = _sql()

"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax on top.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``sample`` rows of the smallest hash of the id, never of the held-out remainder). What the
driver gets is one histogram of at most 2 ** 16 buckets a sampled row. Since the average and
the softmax's logits are linear in the vectors, scoring needs one number a bucket.

Defined cases: a null or empty text has no n-grams and gets the prior, as has every text if
no labels can be learned from; the prior of no labels at all is 0.8, so that nothing is
rejected without evidence. Repeated rows get a row each. A null id is not held out. A
quality other than 0 or 1, or null, is no label. Other columns never reach the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.ngrams import BUCKETS, grams
from rolepulse.llm.texts import ROWS_AT_ONCE, by_rows, table, utf8

#: Labelled rows learned from, at most.
SAMPLE = 4_000
#: Documents with a score of at least this are accepted.
ACCEPT = 0.7
DIMENSIONS, EPOCHS, RATE, VECTOR_RATE = 8, 6, 2.0, 100.0
#: Ones and rows that the prior starts from.
PRIOR = (4.0, 5.0)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: bytes | None) -> float:
        g = grams(text)
        z = self.bias + (float(self.weights[g].mean(dtype=np.float64)) if len(g) else 0.0)
        return float(1 / (1 + np.exp(-min(max(z, -700.0), 700.0))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_arrays(found: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, seed: int = 7) -> Model:
    """Gradient descent over (buckets, counts) histograms with labels 0 and 1."""
    rng, d = np.random.default_rng(seed), DIMENSIONS
    share = (good.sum() + PRIOR[0]) / (len(good) + PRIOR[1])
    vectors, top, bias = rng.uniform(-1 / d, 1 / d, (BUCKETS, d)), np.zeros((d, 2)), np.array([0.0, np.log(share / (1 - share))])
    start, steps, k = bias[1], EPOCHS * len(found), 0
    if len(set(good.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(start))
    for _ in range(EPOCHS):
        for j in rng.permutation(len(found)):
            at, x = found[j]
            x = x / max(1, x.sum())
            h = x @ vectors[at]
            z = h @ top + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[good[j]] -= 1
            rate = RATE * (1 - k / steps)
            back = top @ g
            top -= rate * np.outer(h, g)
            bias -= 0.1 * rate * g
            vectors[at] -= VECTOR_RATE * (1 - k / steps) * np.outer(x, back)
            k += 1
    return Model((vectors @ (top[:, 1] - top[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def narrow(times: np.ndarray) -> bytes:
    """Counts in the fewest bytes each that hold the largest of them: 1, 2 or 4."""
    most = int(times.max())
    return times.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def binaries(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The bytes of each value of a column of binaries, where they lie."""
    out = []
    for chunk in column.chunks:
        width = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
        _, at, data = chunk.buffers()
        ends = np.frombuffer(at, width)[chunk.offset:chunk.offset + len(chunk) + 1] if len(chunk) else ()
        whole = np.frombuffer(data or b"", np.uint8)
        out += [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return out


def views(buckets: pa.ChunkedArray, times: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The histograms as (buckets, counts); a count is as wide as the number of buckets tells."""
    found = ((b.view("<u2"), t) for b, t in zip(binaries(buckets), binaries(times)))
    return [(b, t.view(f"<u{len(t) // len(b)}")) for b, t in found]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    chosen = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
              .select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample))

    def histograms(batch):
        for label, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            at, times = np.unique(grams(text), return_counts=True)
            if len(at):
                yield label, at.astype("<u2").tobytes(), narrow(times)

    schema = pa.schema([("good", pa.int32()), ("buckets", pa.binary()), ("times", pa.binary())])
    # at most `sample` labels are broadcast; a sampled id that is repeated in docs is learned once for each row, within the limit
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.crc32("text"), "quality")
            .limit(sample).select(F.col("quality").cast("int"), "text")
            .mapInArrow(by_rows(histograms, schema), "good int, buckets binary, times binary").toArrow())
    return fit_arrays(views(rows["buckets"], rows["times"]), rows["good"].to_numpy().astype(np.int64))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    def score(batch):
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            yield doc_id, model.score(text)

    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    return (docs.select("doc_id", "text").mapInArrow(by_rows(score, schema), "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model accepts."""
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                yield part.filter(pa.array([model.score(t) >= ACCEPT for t in utf8(part.column(at))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fit(docs, table(spark, sf_dir, "labels")))

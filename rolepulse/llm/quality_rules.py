r"""Quality rules: counts of a text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are counted: the raw corpus (every text) and the
trusted target (every text labelled good). A text's ratio is the mean over its n-grams
of log p_target - log p_raw; it is kept when its counts pass and the ratio is at least
a threshold that follows the ratios of the trusted documents: as far below their first
percentile as that is below their median, and further by ``MARGIN`` over the root of their number,
so that few trusted documents give a wide threshold and many a sharp one.

The raw corpus is counted without a join. For the target, ids are tested against a bitmap of fixed
size of the trusted ids' hashes, and only rows that pass it are shuffled to the exact join. While the
trusted ids are few against its bits, that is little more than their own rows; far beyond that,
nearly all texts pass, and the join shuffles at most every text once.

Defined cases: a null or empty text has no words and fails the base rules; a text of fewer
than three bytes and no word has ratio 0. Without labelled documents the target equals the
raw corpus, so that every ratio is 0 and only the base rules decide; so do they where no trusted
one passes them. Each row is judged by itself: repeated rows, and rows with a null id, get a row each. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.ngrams import BUCKETS, grams
from rolepulse.llm.texts import by_rows, stored, table, utf8, words

#: What one trusted row alone adds to the width of the threshold, in nats per n-gram.
MARGIN = 1.0
#: Counts of neighbouring buckets that travel in one row.
WIDTH = 16
#: Bits of the map of trusted ids.
MAP_BITS = 1 << 23
#: Steps a nat in which the ratios of the trusted documents are counted.
STEPS = 1000
#: Added to each bucket of both multinomials.
SMOOTHING = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_WORD_CHAR = np.zeros(256, np.int64)
_WORD_CHAR[[b for b in range(256) if b & 0xC0 != 0x80 and b != 0x20 and not 9 <= b <= 13]] = 1

RULED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("ratio", pa.float64()),
])


def repeated_words(found: list[bytes]) -> int:
    """Words in 3-word windows that the text has twice or more, the first of them included."""
    if len(found) < 4:
        return 0
    seen: dict[bytes, int] = {}
    w = np.fromiter((seen.setdefault(x, len(seen)) for x in found), np.int64, len(found))
    n = len(seen)
    pair = w[:-2] * n + w[1:-1]
    if n > 1_000_000:  # else a triple fits 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, which, times = np.unique(pair * n + w[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(w), bool)
    for j in range(3):
        covered[j:len(w) - 2 + j] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    r"""\n-split lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    found, times = words(text), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return (len(found), int(times @ _WORD_CHAR), int(times @ _SYMBOLS), repeated_lines(text), repeated_words(found))


def trusted(labels: DataFrame) -> DataFrame:
    """The ids that are labelled good."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def target_texts(docs: DataFrame, good: DataFrame) -> DataFrame:
    """The text of each row whose id is in ``good``."""
    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(MAP_BITS))
    word, inside = F.expr("bit div 64").alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))")
    # At most MAP_BITS / 64 rows.
    bitmap = good.select(bit.alias("bit")).select(word, inside.alias("set")).groupBy("word").agg(F.bit_or("set").alias("set"))
    near = docs.select("doc_id", "text", bit.alias("bit")).select("doc_id", "text", word, inside.alias("own"))
    passing = near.join(F.broadcast(bitmap), "word").where(F.col("set").bitwiseAND(F.col("own")) != 0).select("doc_id", "text")
    # The same join whatever the sizes are. The ids are distinct; a semi join would be moved before the bitmap.
    return passing.join(good.hint("merge"), "doc_id").select("text")


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many n-grams fall into each bucket; 2 ** 16 sums, WIDTH in a row, are all that a task sends and the driver gets."""
    sums = [f"c{i}" for i in range(WIDTH)]
    schema = pa.schema([("block", pa.int32()), *[(c, pa.int64()) for c in sums]])

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in utf8(batch.column(0)):
                g = grams(text)
                if len(g) > BUCKETS:
                    total += np.bincount(g, minlength=BUCKETS)
                else:
                    np.add.at(total, g, 1)
        rows = total.reshape(-1, WIDTH)
        at = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *[pa.array(c) for c in np.ascontiguousarray(rows[at].T)]], schema=schema)

    found = (texts.mapInArrow(count, "block int, " + ", ".join(f"{c} long" for c in sums))
             .groupBy("block").agg(*[F.sum(c).alias(c) for c in sums]).toArrow())
    out = np.zeros((BUCKETS // WIDTH, WIDTH))
    out[found["block"].to_numpy()] = np.stack([found[c].to_numpy() for c in sums], axis=1)
    return out.ravel()


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket."""
    target = bucket_counts(target_texts(docs, trusted(labels)))
    if not target.any():
        return np.zeros(BUCKETS)
    raw, target = bucket_counts(docs.select("text")) + SMOOTHING, target + SMOOTHING
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def ruled(docs: DataFrame, ratios: np.ndarray, least_ratio: float = float("-inf")) -> DataFrame:
    """Counts, ratio and verdict of each row of ``docs``."""
    packed = ratios.astype(np.float32)

    def judge(batch):
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            n, chars, symbols, lines, repeated = counts(text)
            failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * n
            g = grams(text)
            ratio = float(packed[g].mean(dtype=np.float64)) if len(g) else 0.0
            yield doc_id, n, chars, symbols, lines, repeated, failed, not failed and ratio >= least_ratio, ratio

    fields = ", ".join(f"{f.name} {({'int64': 'long', 'bool': 'boolean', 'double': 'double'})[str(f.type)]}" for f in RULED)
    return docs.select("doc_id", "text").mapInArrow(by_rows(judge, RULED), fields)


def least_ratio(rows: DataFrame, labels: DataFrame) -> float:
    """The threshold by the ratios in ``rows``; a count for each step of the ratio is all that reaches the driver."""
    good = rows.where("NOT base_failed").join(trusted(labels), "doc_id")
    bins = good.groupBy(F.floor(F.col("ratio") * STEPS).alias("step")).agg(F.count("*").alias("n")).toArrow().sort_by("step")
    step, upto = bins["step"].to_numpy(), np.cumsum(bins["n"].to_numpy())
    if not len(upto):
        return float("-inf")
    low, mid = (int(step[np.searchsorted(upto, share * upto[-1])]) for share in (0.01, 0.5))
    return (2 * low - mid) / STEPS - MARGIN / float(np.sqrt(upto[-1]))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = stored(ruled(docs, log_ratios(docs, labels)), "ratios")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least_ratio(rows, labels)))

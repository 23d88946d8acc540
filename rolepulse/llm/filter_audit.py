r"""Filter interaction audit: what each of five filters removes, alone, in every order, and in Shapley's sense.

Filters A to E fail a text: A: fewer than 200 words; B: distinct words under half of all words;
C: more than 2 % of the code points are ``[A-Z]``; D: holds any of ``[#$%&*|]``; E: some smaller
doc_id has the same text. Each row becomes five bits, its failures. Per part (source) the removals
of all 32 coalitions of filters are tabulated from counts of these bits. Differences of two
coalitions give what a step of an order removes. The Shapley values are the solution of the
least-squares problem with Shapley's kernel weights under the constraint that they sum to what all
filters remove: its normal equations are solved once, in rationals, for every game on five filters,
and the solution is applied to each part's table in whole numbers.

Texts are never shuffled: a row leaves its task as an id, a SHA-256 of its text, its part and its
bits. Rows are joined with ``labels`` by id, then counted per (text, part, labels) with partial sums,
so that a text that a third of all rows share is a few rows per task. Only these counts meet the
least id of their text.

Defined cases: a null text is empty, so that null and empty texts are copies of each other; a null
source is the part ''. A row without an id is a copy of nothing, has no label, and is no original of
others. Rows of one id and one text are copies of the smaller ids' text, not of each other. Several
labels of one id count as 1 if any is 1. Without rows there are no parts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from fractions import Fraction
from itertools import permutations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.texts import by_rows, table, utf8, words

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
COPY = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]

LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
_SIGNS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def failures(text: bytes) -> int:
    """The bits of the filters A to D that a UTF-8 text fails."""
    found = words(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    fails = (len(found) < LEAST_WORDS, 100 * len(set(found)) < LEAST_DISTINCT * len(found), 100 * capitals > MOST_CAPITALS * points,
             _SIGNS.search(text) is not None)
    return sum(1 << i for i, bad in enumerate(fails) if bad)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and bits of the filters A to D of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("fails", pa.int32())])

    def rows(batch):
        for doc_id, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
            yield doc_id, part, hashlib.sha256(text).digest(), failures(text)

    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInArrow(by_rows(rows, schema), "doc_id long, part string, digest binary, fails int")


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (bits of all five filters), good, toxic, n: how many rows are alike in these."""
    named = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    same = ["digest", "part", "fails", "good", "toxic"]
    rows = judged(docs).join(named, "doc_id", "left").select("doc_id", *[F.coalesce(c, F.lit(False)).alias(c) if c in ("good", "toxic") else F.col(c) for c in same])
    each = rows.groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    nameless = F.col("doc_id").isNull()
    groups = each.groupBy(*same).agg(
        F.sum("n").alias("n"), F.sum(F.when(nameless, F.col("n")).otherwise(0)).alias("nameless"),
        F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"))
    least = groups.groupBy("digest").agg(F.min("first").alias("least"))
    originals = F.col("nameless") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    told = groups.join(least, "digest").select("part", "fails", "good", "toxic", originals.alias("originals"), (F.col("n") - originals).alias("copies"))
    both = told.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("fails"), F.col("originals").alias("n")), F.struct((F.col("fails").bitwiseOR(F.lit(COPY))).alias("fails"), F.col("copies").alias("n")))))
    return both.where("n > 0").groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def coalition_removals(counts: DataFrame) -> DataFrame:
    """One row per part: n, and arrays of what each of the 32 coalitions removes: removed, good, toxic."""
    def all_removals(kind: Column) -> Column:
        return F.array(*[F.sum(F.when((F.col("fails").bitwiseAND(F.lit(s)) != 0) & kind, F.col("n")).otherwise(0)) for s in range(COALITIONS)])

    return counts.groupBy("part").agg(
        F.sum("n").alias("n"), all_removals(F.lit(True)).alias("removed"), all_removals(F.col("good")).alias("good"), all_removals(F.col("toxic")).alias("toxic"))


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix`` X = ``right``, by elimination in rationals."""
    n = len(matrix)
    rows = [list(map(Fraction, a)) + list(map(Fraction, b)) for a, b in zip(matrix, right)]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [r[n:] for r in rows]


def shapley_weights(filters: int = len(FILTERS)) -> list[list[Fraction]]:
    """For each filter the weights of all coalitions' removals in its Shapley value.

    Least squares over the coalitions S that are neither empty nor whole: sum of
    kernel(S) * (removed(S) - sum of phi over S)^2, with sum of phi = removed(all). The normal
    equations with a Lagrange multiplier are linear in the removals, so they are solved for all
    unit tables at once.
    """
    n, whole = filters, (1 << filters) - 1
    member = [[s >> i & 1 for i in range(n)] for s in range(whole + 1)]
    size = [sum(m) for m in member]
    kernel = [Fraction(0) if s in (0, whole) else Fraction(n - 1, comb(n, size[s]) * size[s] * (n - size[s])) for s in range(whole + 1)]
    matrix = [[sum(kernel[s] * member[s][i] * member[s][j] for s in range(whole + 1)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    matrix.append([Fraction(1)] * n + [Fraction(0)])
    right = [[kernel[s] * member[s][i] for s in range(whole + 1)] for i in range(n)]
    right.append([Fraction(int(s == whole)) for s in range(whole + 1)])
    return solved(matrix, right)[:n]


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of each step: 600 rows for each part."""
    parts = coalition_removals(counted(docs, labels))
    whole = COALITIONS - 1
    weights = [[w * len(ORDERS) for w in ws] for ws in shapley_weights()]
    if any(w.denominator != 1 for ws in weights for w in ws):
        raise ArithmeticError("the summed weights are not whole")
    whole_weights = [[int(w) for w in ws] for ws in weights]
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[
        (c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])

    def rows(batch):
        for part, n, removed, good, toxic in zip(*[c.to_pylist() for c in batch.columns]):
            shapley = [sum(w * x for w, x in zip(ws, removed)) for ws in whole_weights]
            for order in ORDERS:
                before = 0
                for step, letter in enumerate(order, 1):
                    i = FILTERS.index(letter)
                    after, now = before | 1 << i, removed[before | 1 << i] - removed[before]
                    yield (part, order, step, n - removed[after], now, removed[1 << i] - now, removed[whole] - removed[whole ^ 1 << i],
                           good[after] - good[before], toxic[after] - toxic[before], shapley[i])
                    before = after

    return parts.mapInArrow(by_rows(rows, schema), "part string, filter_order string, step int, " + ", ".join(f"{f.name} long" for f in list(schema)[3:]))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The same counts, order by order, from every row's failures.
OP13_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
told AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM base),
least AS (SELECT text, min(doc_id) AS least FROM base GROUP BY text),
named AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
  SELECT t.part, coalesce(n.good, 0) AS good, coalesce(n.toxic, 0) AS toxic,
         CASE WHEN len(t.w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(t.w)) < 50 * len(t.w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 2 * length(t.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN t.doc_id > l.least THEN 'E' ELSE '' END AS f
  FROM told t JOIN least l ON l.text = t.text LEFT JOIN named n ON n.doc_id = t.doc_id),
kinds AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, s, 1) AS x, substr(filter_order, 1, s - 1) AS before
          FROM orders, range(1, 6) r(s)),
counted AS (
  SELECT k.part, s.filter_order, s.step, s.x,
    sum(CASE WHEN regexp_matches(k.f, '[' || s.before || s.x || ']') THEN 0 ELSE k.n END) AS kept,
    sum(CASE WHEN contains(k.f, s.x) AND (s.before = '' OR NOT regexp_matches(k.f, '[' || s.before || '.]')) THEN k.n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(k.f, s.x) AND s.before <> '' AND regexp_matches(k.f, '[' || s.before || '.]') THEN k.n ELSE 0 END) AS redundant,
    sum(CASE WHEN k.f = s.x THEN k.n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(k.f, s.x) AND (s.before = '' OR NOT regexp_matches(k.f, '[' || s.before || '.]')) THEN k.good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(k.f, s.x) AND (s.before = '' OR NOT regexp_matches(k.f, '[' || s.before || '.]')) THEN k.toxic ELSE 0 END) AS toxic_lost
  FROM kinds k, steps s GROUP BY k.part, s.filter_order, s.step, s.x)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted
"""

import re
import zlib

import numpy as np
import pytest

from rolepulse.llm import quality_classifier as qc
from rolepulse.llm import quality_rules as qr
from rolepulse.llm.ngrams import BUCKETS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, " \n\t", "one", "a b c a b c", "x\nx\n \n \nx", "é ü ß é ü ß é", "# * $ % & | < > ok", "w " * 60,
       "long" * 30_000, " ".join(f"t{i}" for i in range(20_000)), "a\r\nb\r\na\r\nb\r\n", "same line\nsame line"]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    marked = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in range(i, i + 3)} if len(w) < 2000 else set()
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(marked))


@pytest.mark.parametrize("text", ODD)
def test_counts_equal_brute_force(text):
    assert qr.counts(None if text is None else text.encode()) == brute(text)


def test_rules_on_odd_rows(spark, docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(ODD)] + [(None, "x y z"), (1, None), (1, None)])
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    got = qr.ruled(docs, qr.log_ratios(docs, labels)).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        if r.doc_id not in (None, 1):
            want = brute(ODD[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)


def test_rules_on_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert qr.ruled(docs_of([]), qr.log_ratios(docs_of([]), labels)).count() == 0
    one = docs_of([(1, " ".join(f"w{i}" for i in range(80)))])
    assert qr.ruled(one, qr.log_ratios(one, labels)).first().kept  # no target: only the base rules


def test_ratio_is_the_mean_of_log_ratios(spark, docs_of):
    rows = [(i, "plain words of good prose " * 3) for i in range(8)] + [(100 + i, "$$$ ### ***") for i in range(8)]
    docs, labels = docs_of(rows), spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    raw, target = np.full(BUCKETS, qr.SMOOTHING), np.full(BUCKETS, qr.SMOOTHING)
    for i, t in rows:
        for b in qr.grams(t.encode()):
            raw[b] += 1
            target[b] += i < 100
    want = np.log(target / target.sum()) - np.log(raw / raw.sum())
    assert np.allclose(qr.log_ratios(docs, labels), want)


def test_every_good_text_counts_for_the_target(spark, docs_of):
    docs = docs_of([(i, f"word{i} of {i % 7}") for i in range(20_400)])
    labels = spark.range(20_400).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert not qr.log_ratios(docs, labels.union(labels)).any()  # all are good: the target is the corpus


def test_verdicts_part_good_from_bad(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rules = qr.op1_quality_rules(spark, sf).join(labels, "doc_id").where("n_words >= 50").collect()
    good, bad = [r.kept for r in rules if r.quality == 1 and not r.base_failed], [r.kept for r in rules if r.quality == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.02
    held = qc.op7_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.97


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_shares_kept_at_two_sizes(spark, sf_dir, sf):
    sf = sf_dir.replace("sf0.001", sf)
    rules = qr.op1_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("n_words >= 50").collect()
    good, bad = [r.kept for r in rules if r.quality == 1 and not r.base_failed], [r.kept for r in rules if r.quality == 0]
    assert np.mean(good) >= 0.999 and not any(bad)


def test_threshold_follows_the_trusted_ratios(spark, docs_of, tmp_path):
    rng = np.random.default_rng(2)
    prose = lambda n: [f"word{i}" for i in rng.integers(0, 900, n)]
    junk = lambda n: ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n)]
    rows = [(i, " ".join(prose(200))) for i in range(600)] + [(1000 + i, " ".join(prose(175) + junk(25))) for i in range(60)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(400)] + [(1000 + i, 0, 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in qr.op1_quality_rules(spark, str(tmp_path)).collect()}
    assert np.mean([got[i].kept for i in range(600)]) >= 0.99
    bad = [got[1000 + i] for i in range(60)]
    assert all(r.ratio > -0.4 and not r.base_failed for r in bad) and not any(r.kept for r in bad)


def test_classifier_on_odd_rows(spark, docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (2, "dup"), (2, "dup")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 1), (5, None, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    got = qc.scored(docs, qc.fit(docs, labels)).collect()
    assert len(got) == len(ODD) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_classifier_without_labels_keeps_all(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None)])
    model = qc.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.predicted for r in qc.scored(docs, model).collect()} == {1}
    kept = qc.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == 2


def test_held_out_rows_are_not_learned(spark, docs_of):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = docs_of([(i, f"word{i} text") for i in ids])
    model = qc.fit(docs, spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int"))
    assert not model.weights.any()


def test_only_texts_that_pass_the_bitmap_are_shuffled(spark, docs_of):
    docs = docs_of([(i, f"text {i}") for i in range(5000)] + [(None, "x"), (3, "text 3")])
    good = qr.trusted(spark.createDataFrame([(3, 1, 0), (8, 1, 0), (3, 1, 1), (9, 0, 0), (None, 1, 0), (99999, 1, 0)], "doc_id long, quality int, toxic int"))
    found = qr.target_texts(docs, good)
    assert sorted(r.text for r in found.collect()) == ["text 3", "text 3", "text 8"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("Exchange") < plan.index("BroadcastHashJoin")


def test_histograms_come_to_the_driver_in_few_bytes(spark, docs_of, monkeypatch):
    """At most three bytes a bucket for texts of usual length, and counts of any size are whole."""
    texts = ["good text here", "bad bad bad text", "ab " * 100, "c" * 70_000]
    rows = [(i, t) for i, t in enumerate(texts * 5)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    got = []
    monkeypatch.setattr(qc, "fit_arrays", lambda found, good: got.extend(found))
    qc.fit(docs_of(rows), labels)
    want = {tuple(map(tuple, np.unique(qc.grams(t.encode()), return_counts=True))) for t in texts}
    assert {(tuple(b), tuple(n)) for b, n in got} == want
    assert all(b.itemsize == 2 and n.itemsize == (1 if n.max() < 256 else 2 if n.max() < 65536 else 4) for b, n in got)

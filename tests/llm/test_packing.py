import collections
import re
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rolepulse.llm import cutting_stock as cs
from rolepulse.llm import packing as pk

ODD = ["", None, " \n", "The cat's here... it's'll 'tis!", "<|endoftext|> a<|startoftext|>b", "<|ENDOFTEXT|> Ab,", "É é ſ İ ΑΣ,",
       "x" * 9_000, "word, " * 3_000, "a b c", "a b c", "1,234.5-6 (x)", "日本語 text。", "tab\tbell\x07\x0b vt", "é a ́b"]


def direct(text):
    return pk.word_ids(pk.VOCABULARY).tokenizer.encode(text or "", add_special_tokens=False).ids + [pk.END]


@pytest.mark.parametrize("text", ODD)
def test_ids_by_word_equal_the_tokenizer(text):
    ids = pk.word_ids(pk.VOCABULARY).of(None if text is None else text.encode())
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == direct(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé'ßs.,!<|>t \ńİΣ1日-_"), max_size=40))
def test_ids_of_any_text(text):
    ids = pk.word_ids(pk.VOCABULARY).of(text.encode())
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == direct(text)


def check(rows, texts):
    """Each id in one piece, right checksums, sequences without gaps; returns the padding."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids, at = direct(texts[doc_id]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= pk.SEQUENCE
        padding += 0 if at & (at - 1) == 0 else pk.SEQUENCE - at
    return padding


def test_odd_documents(spark, docs_of):
    texts = dict(enumerate(ODD))
    check(pk.packed(docs_of(list(texts.items()))).collect(), texts)


def test_repeated_rows_and_null_ids(spark, docs_of):
    rows = pk.packed(docs_of([(1, "a b"), (1, "a b"), (None, "c"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows if r.doc_id is None) == [(0, 1), (0, 2)]
    assert sum(r.length for r in rows if r.doc_id == 1) == 6
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_empty_table(spark, docs_of):
    assert pk.packed(docs_of([])).count() == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, texts = pk.packed(docs).collect(), {r.doc_id: r.text for r in docs.collect()}
    assert check(rows, texts) <= 0.005 * sum(r.length for r in rows)


def test_many_documents_of_one_length(spark):
    docs = spark.sql("SELECT id AS doc_id, repeat('same words here ', 150) AS text FROM range(2000)")
    padding = check(pk.packed(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert padding <= (pk.SEQUENCE - 4 * 451) * 500  # four fit


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 32), st.integers(1, 40)), min_size=1, max_size=12))
def test_rounded_patterns_balance(found):
    counts = np.zeros(33, np.int64)
    for size, n in found:
        counts[size] += n
    cuts, used, left = cs.rounded(counts, 32)
    total, sizes = left.copy(), np.arange(33)
    for column, times in used:
        assert column.min() >= 0 and column @ sizes <= 32 and times > 0
        total += column * times
    want = counts - cuts
    for s in np.flatnonzero(cuts):
        want[s - 16] += cuts[s]
        want[16] += cuts[s]
    assert (total == want).all() and left.min() >= 0


def test_pricing_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        duals = np.append(0, rng.uniform(-0.2, 1, 9))
        best = [0.0] * 10
        for c in range(1, 10):
            best[c] = max([best[c - 1]] + [duals[s] + best[c - s] for s in range(1, c + 1)])
        value, column = cs.price(duals, 9)
        assert np.isclose(value, best[9]) and np.isclose(value, column @ duals) and column @ np.arange(10) <= 9


def test_no_table_of_classes_in_the_plan(spark, docs_of):
    """257 literals, again and again, filled the driver of the pipeline."""
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        plan = pk.packed(docs_of([(i, "word " * (40 * i)) for i in range(60)]))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert not re.search(r"\[(\d+, ?){200}", plan)


def test_further_cuts_keep_every_id(spark):
    """Remainders of 75 % fill sequences only where some are cut at half a sequence."""
    docs = spark.sql("SELECT id AS doc_id, repeat('same words here ', 512) AS text FROM range(300)")
    rows, texts = pk.packed(docs).collect(), {r.doc_id: r.text for r in docs.collect()}
    check(rows, texts)
    assert any(r.length == pk.HALF for r in rows)

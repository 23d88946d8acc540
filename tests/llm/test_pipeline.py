"""The stages of the corpus pipeline one after the other, on odd rows and on none."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline as cp
from rolepulse.llm import near_dedup as nd
from rolepulse.llm.texts import words

LABELS, BENCHMARK = "doc_id long, quality int, toxic int", "item_id long, text string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """documents with nulls, repeats, copies, leaks, personal data and an extra column; labels; benchmark."""
    rng = random.Random(1)
    prose = lambda n: " ".join(f"word{rng.randrange(900)}" for _ in range(n))
    junk = lambda n: " ".join("".join(rng.choice("zxqj#$%") for _ in range(9)) for _ in range(n))
    rows = [(i, prose(150)) for i in range(60)] + [(100 + i, junk(120)) for i in range(40)]
    item = prose(30)
    copy = rows[3][1]
    rows += [(200, copy), (201, copy + " more"), (202, prose(60) + " " + item + " " + prose(60)), (203, prose(90) + " mail me@example.org now"),
             (204, prose(40_000)), (205, None), (206, ""), (None, prose(80)), (None, prose(80)), (207, " \n"), (5, rows[5][1])]
    root = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), n) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, score int")
    docs.repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(40)], LABELS).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], BENCHMARK).write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_in_sequence(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    after = {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, tables), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"], name
        after[name] = docs.collect()
    ids = {name: [r.doc_id for r in rows] for name, rows in after.items()}
    assert not [i for i in ids["quality"] if i is not None and 100 <= i < 140] and set(range(60)) <= set(ids["quality"])
    # one row for each id and class, by all pairs
    named = [(r.doc_id, r.text) for r in after["quality"] if r.doc_id is not None]
    own = {i: nd.shingles(words((t or "").encode())) for i, t in named}
    smaller = {i for i in own for j in own if j < i and len(own[i][0]) and len(own[j][0]) and nd.similarity(own[i], own[j]) >= nd.SIMILAR}
    assert sorted(i for i in ids["near_duplicates"] if i is not None) == sorted(set(own) - smaller) and {200, 201} & smaller
    assert ids["near_duplicates"].count(None) == ids["quality"].count(None)
    assert set(ids["near_duplicates"]) - set(ids["benchmark_leaks"]) == {202}
    texts = {r.doc_id: r.text for r in after["personal_data"]}
    assert ids["personal_data"].count(None) == ids["benchmark_leaks"].count(None) and "[EMAIL]" in texts[203] and "me@example.org" not in texts[203]
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in cp.STAGES[-1][1](spark, docs, tables).collect():
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids["personal_data"])
    for i, parts in pieces.items():
        if i is not None:
            assert sum(n for _, n, _ in parts) == parts[0][2] and sorted(s for s, *_ in parts)[0] == 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_and_an_empty_table(spark, tables, tmp_path):
    assert cp.run(spark, tables).count() > 60
    spark.read.parquet(f"{tables}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0

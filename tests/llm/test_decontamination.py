import random

import numpy as np
import pytest

from rolepulse.llm import decontamination as dc


def plain_alignment(a, b):
    """Best local alignment, cell by cell."""
    h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1][j + 1] = max(0, h[i][j] + (1 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
            best = max(best, h[i + 1][j + 1])
    return best


def test_alignment_equals_cell_by_cell():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        score, start, end = dc.aligned(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == plain_alignment(a, b) == plain_alignment(a, b[start:end])


def rows_and_items():
    rng = random.Random(5)
    fresh = lambda n: [f"W{rng.randrange(900)}" for _ in range(n)]
    items = [fresh(rng.randint(12, 60)) for _ in range(12)]
    docs, leaked = [], set()
    for n in range(120):
        body = fresh(rng.randint(0, 200))
        if n % 3 == 0:
            i = rng.randrange(len(items))
            copy = list(items[i])
            for _ in range(len(copy) // 12):
                copy[rng.randrange(len(copy))] = "edited"
            at = rng.randint(0, len(body))
            body[at:at] = [w.lower() + "," for w in copy]
            leaked.add((n, i))
        elif n % 3 == 1:  # a quarter of an item is no leak
            i = rng.randrange(len(items))
            body += items[i][:len(items[i]) // 4]
        docs.append((n, " ".join(body)))
    return docs, [(i, " ".join(w)) for i, w in enumerate(items)], leaked


def everything(docs, items):
    """All documents against all items, without seeds."""
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = dc.plain_words(item.encode()), dc.plain_words((text or "").encode())
            score = dc.best_end(a, b)[0] / max(1, len(a))
            if score >= dc.LEAST_SCORE:
                out[d, i] = score
    return out


@pytest.mark.parametrize("most", [dc.BLOCK_WORDS, 50])
def test_leaks_equal_all_alignments(spark, docs_of, monkeypatch, most):
    docs, items, leaked = rows_and_items()
    monkeypatch.setattr(dc.blocks, "__defaults__", (most,))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.leaks(docs_of(docs), bench).collect()}
    assert found == everything(docs, items)
    assert set(found) == leaked
    kept = dc.decontaminated(docs_of(docs), bench)
    assert kept.columns == docs_of(docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in leaked}


def test_nulls_ties_empty_tables(spark, docs_of):
    item = "one two three four five six seven eight"
    bench = spark.createDataFrame([(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "one two")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item.upper()), (4, "one two"), (5, "x " * 60000 + item)]
    found = sorted((str(r["doc_id"]), str(r["item_id"]), r["score"], r["n_words"]) for r in dc.leaks(docs_of(rows), bench).collect())
    assert found == sorted((d, i, 1.0, 8) for d in ("3", "3", "None", "5") for i in ("1", "1", "None"))
    assert dc.leaks(docs_of(rows), bench.limit(0)).isEmpty()
    assert dc.decontaminated(docs_of(rows), bench.limit(0)).count() == 7
    assert dc.leaks(docs_of(rows).limit(0), bench).isEmpty()
    assert sorted(str(r["doc_id"]) for r in dc.decontaminated(docs_of(rows), bench).collect()) == ["1", "2", "4"]


def test_evenly_edited_copies_are_found(spark, docs_of):
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items, docs = [], []
    for n in (3, 4, 5, 8, 13, 24, 40, 60):
        for every in (4, 5, 6):
            for verbatim in (False, True):
                item = fresh(n)
                copies = [[f"x{rng.random()}" if j % every == every - 1 else w for j, w in enumerate(item)],
                          [x for j, w in enumerate(item) for x in ([w, "added"] if j % every == every - 1 else [w])],
                          [x for j, w in enumerate(item) for x in ([w, "added"] if j % 2 and j < n - 2 else [w])],  # no three words in a row
                          [w for j, w in enumerate(item) if j % every != every - 1]]
                for copy in [*copies, *[item] * verbatim]:
                    docs.append((len(docs), " ".join(fresh(40) + copy + fresh(40))))
                items.append((len(items), " ".join(item)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.leaks(docs_of(docs), bench).collect()}
    assert found == everything(docs, items)
    assert len(found) > 150

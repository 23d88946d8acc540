import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rolepulse.llm import graphs
from rolepulse.llm import near_dedup as nd
from rolepulse.llm.graphs import components


def sets(text):
    w = (text or "").split()
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(rows):
    """Least id of the component of each id, by all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    items = [(i, sets(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(items):
        for j, b in items[:n]:
            if a and b and len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i in ids}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.random()}"
    return " ".join(w)


def corpus(seed=1):
    rng = random.Random(seed)
    fresh = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    texts = [fresh(rng.randint(30, 300)) for _ in range(60)]
    for t in texts[:25]:
        texts += [edited(rng, t, max(1, len(t.split()) // 60)) for _ in range(3)] + [t]
    passage = fresh(80)
    texts += [passage + " " + fresh(15) for _ in range(40)]  # about 0.6 alike: candidates, not links
    chain = fresh(200)
    for _ in range(12):
        texts.append(chain)
        chain = edited(rng, chain, 3)
    texts += ["one", "one", "one two", "", None, " \n", "a a a a a a a a a", "a a a a a a a a a a a"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_classes_equal_all_pairs(spark, docs_of, monkeypatch):
    rows = corpus() + [(None, "one"), (None, None), (7, "rows of one id"), (7, "rows of one id")]
    want = brute(rows)
    for small, levels in ((64, 2), (4, 2), (3, 0)):  # pair by pair, dealt out by further bands, centre by centre
        monkeypatch.setattr(nd, "SMALL", small)
        monkeypatch.setattr(nd, "LEVELS", levels)
        got = nd.classes(docs_of(rows)).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
        assert all(r.class_id is None for r in got if r.doc_id is None)


def test_pairs_of_one_shared_band_in_large_buckets(spark, docs_of, monkeypatch):
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passage, texts = fresh(60), []
    for _ in range(40):
        one = passage + " " + fresh(100)
        texts += [one, one + " " + fresh(35)]  # 156 of 191 shingles
    rows = list(enumerate([fresh(200), *texts]))  # the first centre is like none of them
    nodes = spark.createDataFrame([(i, 7, *(100 * i + j + 1000 for j in range(1, nd.BANDS))) for i, _ in rows],
                                  ", ".join(["doc_id long"] + [f"b{j} long" for j in range(nd.BANDS)]))
    want = {i: least for i, least in brute(rows).items() if i != least}
    assert len(want) == 40
    for small, levels in ((64, nd.LEVELS), (8, nd.LEVELS), (8, 0)):
        monkeypatch.setattr(nd, "SMALL", small)
        monkeypatch.setattr(nd, "LEVELS", levels)
        assert {r.node: r.least for r in nd.links(nodes, docs_of(rows)).collect()} == want


def test_similar_texts_are_dealt_a_shingle_in_common(spark, docs_of, monkeypatch):
    rows = [r for r in corpus(3) if (r[1] or "").split()]
    docs, own = docs_of(rows), {i: nd.shingles(nd.words(t.encode())) for i, t in rows}
    similar = {(i, j) for i in own for j in own if i < j and nd.similarity(own[i], own[j]) >= nd.SIMILAR}
    for many in (1 << 16, 64):  # no two shingles of a text on one counter, or most of them
        monkeypatch.setattr(nd, "COUNTERS", many)
        found = nd.dealt(docs.select("doc_id"), docs.select("doc_id", "text"))
        members = {}
        for r in found.collect():
            members.setdefault(r.key, set()).add(r.doc_id)
        assert not [p for p in similar if not any(set(p) <= m for m in members.values())]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Inner" not in plan  # a row for each shingle of each text is neither joined nor sorted
        assert sum(map(len, members.values())) < 0.4 * sum(len(h) for h, _ in own.values())


def test_a_large_class_is_compared_with_what_lies_outside_it_once(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    one = " ".join(f"w{rng.randrange(5000)}" for _ in range(100))
    rows = list(enumerate([one] + [edited(rng, one, 1) for _ in range(250)] + [edited(rng, one, 8) for _ in range(60)]))
    nodes = spark.createDataFrame([(i, 7, *(100 * i + j + 1000 for j in range(1, nd.BANDS))) for i, _ in rows],
                                  ", ".join(["doc_id long"] + [f"b{j} long" for j in range(nd.BANDS)]))
    want = {i: least for i, least in brute(rows).items() if i != least}
    assert 250 <= len(want) < 310
    tables, store = [], nd.stored
    monkeypatch.setattr(nd, "stored", lambda df, name: tables.append((name, store(df, name))) or tables[-1][1])
    for chunk in (nd.CHUNK, 40):
        tables.clear()
        monkeypatch.setattr(nd, "CHUNK", chunk)
        assert {r.node: r.least for r in nd.links(nodes, docs_of(rows)).collect()} == want
        assert [df.count() > 0 for name, df in tables if name == "open-buckets"] == [True, False]
        assert not [name for name, df in tables if name == "finer-buckets" and df.count()]


def test_centres_meet_all_members_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "CHUNK", 8)
    monkeypatch.setattr(nd, "VOLUME", 400)
    sizes, long = {1: (70, 30), 2: (20, 3), 3: (5, 5), 4: (9, 1), 5: (40, 20)}, {5: 200}  # key: members, centres; shingles of each
    members = spark.createDataFrame([(key, 1000 * key + i, i, i < centres, n, n * long.get(key, 10), centres, centres * long.get(key, 10))
                                     for key, (n, centres) in sizes.items() for i in range(n)],
                                    "key long, doc_id long, label long, centre boolean, n long, volume long, centres long, centres_volume long")
    found = {}
    for r in nd.blocks(members).collect():
        assert r.row or r.column
        rows, columns = found.setdefault((r.key, r.block), ([], []))
        rows.extend([r.doc_id] * r.row)
        columns.extend([r.doc_id] * r.column)
    met = [(key, a, b) for (key, _), (rows, columns) in found.items() for a in rows for b in columns]
    assert sorted(met) == sorted((key, 1000 * key + a, 1000 * key + b) for key, (n, centres) in sizes.items() for a in range(centres) for b in range(n))
    assert max(max(map(len, x)) for x in found.values()) < 24
    assert max(max(map(len, x)) for (key, _), x in found.items() if key == 5) < 10  # of long texts fewer


def test_signatures_of_many_texts_are_those_of_each(monkeypatch):
    texts = [t.encode() if t is not None else None for _, t in corpus(5)] + ["a".encode(), b"a b c d", b"a b c d e", None]
    found = [nd.words(t) for t in texts]
    h, times, size = nd.all_shingles(found)
    whole, end = nd.signatures(h, 1 + np.log(times), size), np.cumsum(size)
    for f, n, e, s in zip(found, size, end, whole):
        own, weight = nd.shingles(f)
        runs = nd.sequence_hash(np.array([nd.xxhash.xxh3_64_intdigest(w) for w in f], np.uint64), min(5, len(f))) if f else []
        assert sorted(set(map(int, runs))) == own.tolist() == h[e - n:e].tolist()
        assert np.allclose(weight, [1 + np.log(list(runs).count(x)) for x in own])
        assert (nd.signature(own, weight) == s).all()
    cut = [t for size in (1, 700, 1 << 18) if not monkeypatch.setattr(nd, "BYTES_AT_ONCE", size)
           for _, some in nd.portions([nd.pa.record_batch([list(range(len(texts))), nd.pa.array(texts, nd.pa.binary())], ["doc_id", "text"])]) for t in some]
    assert cut == 3 * texts


def test_products_of_matrices_bound_the_similarity(monkeypatch):
    rng = np.random.default_rng(7)
    base, docs = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64)), []
    for share in (0.02, 0.1, 0.2, 0.5) * 5:
        own = np.unique(np.append(base[rng.random(len(base)) > share], rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)))
        docs.append((own, np.where(rng.random(len(own)) < rng.choice([0, 0.3]), 3, 1)))
    every, size = np.arange(len(docs)), np.array([len(h) for h, _ in docs])
    for width in (nd.WIDTH, 50):
        monkeypatch.setattr(nd, "WIDTH", width)
        plain, most = nd.likeness(np.concatenate([h for h, _ in docs]), np.concatenate([t for _, t in docs]), size, every, every)
        for i, (a, s) in enumerate(docs):
            for j, (b, t) in enumerate(docs[:i]):
                both = len(np.intersect1d(a, b))
                assert plain[i, j] == plain[j, i] == both / (len(a) + len(b) - both)
                exact = nd.similarity((a, 1 + np.log(s)), (b, 1 + np.log(t)))
                assert exact - 1e-5 < most[i, j] < exact + 0.1
                assert s.max() > 1 or t.max() > 1 or abs(most[i, j] - plain[i, j]) < 1e-5


def test_one_row_of_each_class_stays(spark, docs_of):
    rows = corpus(2) + [(None, "x"), (5, "again again"), (5, "again again")]
    docs = docs_of(rows)
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and sorted(i for i in ids if i is not None) == sorted(set(brute(rows).values()))


def test_ids_with_several_texts_link_them(spark, docs_of):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (2, b), (3, c), (9, a), (9, b), (9, c), (4, d), (5, d + " more"), (6, ""), (6, d), (7, None), (8, " "), (8, "x y z"), (10, "x y z")]
    want = {1: 1, 2: 1, 3: 1, 9: 1, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 10: 8}
    got = nd.classes(docs_of(rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    assert {(r.doc_id, r.class_id) for r in got} == set(want.items())


def written(monkeypatch):
    """The names of the tables that turns of components write from now on."""
    names, store = [], graphs.stored
    monkeypatch.setattr(graphs, "stored", lambda df, name: names.append(name) or store(df, name))
    return names


def test_stars_take_no_turn(spark, monkeypatch):
    names = written(monkeypatch)
    stars = spark.createDataFrame([(0, i) for i in range(1, 20)] + [(30 + i, 30) for i in range(1, 5)] + [(1, 0), (7, 7)], "u long, v long")
    assert {r.node: r.least for r in components(stars).collect()} == {i: 0 for i in range(1, 20)} | {30 + i: 30 for i in range(1, 5)}
    assert len(names) == 1  # the edges themselves


def test_copies_take_no_turn(spark, docs_of, monkeypatch):
    names = written(monkeypatch)
    rows = [(i, f"{i % 7} " + " ".join(f"w{i % 7}-{j}" for j in range(80))) for i in range(300)]
    got = {r.doc_id: r.class_id for r in nd.classes(docs_of(rows)).collect()}
    assert got == {i: i % 7 for i in range(300)}
    assert len(names) == 1


def test_empty_table(spark, docs_of):
    assert nd.classes(docs_of([])).count() == 0 and nd.deduplicated(docs_of([])).count() == 0


def test_registers_agree_as_often_as_the_probability_jaccard():
    rng = np.random.default_rng(4)
    for share in (0.2, 0.8):
        h = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
        w = rng.choice([1.0, 1.7, 2.4], len(h))
        cut = int(len(h) * (1 - share) / 2)
        a, b = (h[: len(h) - cut], w[: len(h) - cut]), (h[cut:], w[cut:] * rng.choice([1.0, 1.5], len(h) - cut))
        want = 0.0  # by the definition
        u, v = dict(zip(*a)), dict(zip(*b))
        for d in set(u) & set(v):
            want += 1 / sum(max(u.get(e, 0) / u[d], v.get(e, 0) / v[d]) for e in set(u) | set(v))
        agree = np.mean(nd.signature(*a, registers=4096) == nd.signature(*b, registers=4096))
        plain = len(set(u) & set(v)) / len(set(u) | set(v))
        assert abs(agree - want) < 0.035
        assert abs(nd.similarity(a, b) - max(want, plain)) < 1e-9


def test_signature_of_few_and_many_shingles():
    one = nd.signature(np.array([5], np.uint64), np.array([1.0]))
    assert (one == 5).all()
    h = np.arange(1, 50_000, dtype=np.uint64)
    assert len(set(nd.signature(h, np.ones(len(h))).tolist())) > 55


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    up = {i: i for i in range(31)}
    for _ in range(40):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = {r.node: r.least for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: up[i] for i in up if up[i] != i}

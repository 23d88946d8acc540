import hashlib
import random
from collections import Counter

import pytest

from rolepulse.llm import substring_dedup as sd


def plain(rows, window):
    texts = [[w for w in (t or "").split()] for _, t in rows]
    times = Counter(tuple(w[s:s + window]) for w in texts for s in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = {i for s in range(len(w) - window + 1) if times[tuple(w[s:s + window])] > 1 for i in range(s, s + window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(docs, **more):
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd.without_repeats(docs, **more).collect()], key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    fresh = lambda k: [f"w{rng.randrange(3000)}" for _ in range(k)]
    passages = [fresh(rng.choice([34, 35, 36, 50, 120])) for _ in range(8)]
    texts = []
    for _ in range(n):
        w = fresh(rng.randint(0, 150))
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages)
            lo = rng.choice([0, 0, 1, 7])
            at = rng.randint(0, len(w))
            w[at:at] = p[lo:]
        texts.append(w)
    for w in texts[:25]:
        copy = list(w)
        for _ in range(rng.choice([0, 1, 3])):
            if copy:
                copy[rng.randrange(len(copy))] = f"e{rng.random()}"
        texts.append(copy)
    own = fresh(70)
    texts += [own + fresh(5) + own, ["a"] * 200, ["a", "b"] * 60, ["a"] * 34, ["a"] * 35, fresh(40) + ["a"] * 36, ["ü€", "x"] * 30]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rows += [(0, rows[0][1]), (None, rows[1][1]), (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "x" * 100_000), (905, "\n".join(passages[4]) + " \t"),
             (906, " ".join(["z"] * 30_000))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, more", [(1, {}), (2, {"most": 5, "most_words": 100}), (3, {"window": 20})])
def test_equals_all_windows(spark, docs_of, seed, more):
    rows = corpus(seed)
    found = got(docs_of(rows), **more)
    assert found == plain(rows, more.get("window", sd.WINDOW))
    assert sum(r[2] for r in found) > 1000


def test_words_of_one_character_are_told_apart(monkeypatch):
    """Equal characters are not taken for equal words."""
    one = sd.Automaton()
    one.add(b" ".join(b"w%d" % i for i in range(35)))
    monkeypatch.setattr(sd, "spelled", lambda ids: "x" * len(ids))
    two = sd.Automaton()
    two.add(b" ".join(b"w%d" % i for i in range(35)))
    text = b" ".join(b"w%d" % i for i in range(-50, 60)).replace(b"w-", b"v")
    assert list(two.occurrences(text)) == [(50, 85)]
    assert list(two.occurrences(text.replace(b"w20", b"v20"))) == []


def test_nothing_repeated_and_empty(spark, docs_of):
    rows = [(1, " ".join(f"u{i}" for i in range(100))), (2, " ".join(f"v{i}" for i in range(100)))]
    assert got(docs_of(rows)) == plain(rows, sd.WINDOW)
    assert got(docs_of(rows).limit(0)) == []


def test_copies_are_streamed_once(spark, docs_of, monkeypatch):
    """All copies but one of a text are settled without phrases or segments; others that share a passage with it lose it."""
    text = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(text)) for i in range(40)] + [(None, " ".join(text)), (50, " ".join(["x"] + text[20:90] + ["y"])), (51, "c0 c1"), (52, "c0 c1"), (53, None), (54, None)]
    parts, segments = [], sd.segments
    monkeypatch.setattr(sd, "segments", lambda *args: parts.append(segments(*args)) or parts[-1])
    docs = docs_of(rows)
    found = got(docs)
    assert found == plain(rows, sd.WINDOW)
    texts = parts[0].select("d0", "d1", "at").collect()
    # equal texts lie in one partition, sorted; one is streamed for each task that reads them
    assert 0 < len({(r.d0, r.d1) for r in texts}) == 2 and len(texts) < 20
    assert {(r.kept_text, r.n_removed) for r in sd.without_repeats(docs).where("doc_id < 40").collect()} == {("", 200)}


def test_windows_of_many_texts_at_once(monkeypatch):
    """Contexts are those of each text alone, whatever text comes before it."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", f"t{i}"]) for i in range(n)).encode() for n in (0, 34, 35, 36, 90, 10, 300)] + [None, b"a " * 80]
    together = list(zip(*(x.tolist() for x in sd.contexts_of(*sd.hashed(texts)))))
    alone = [(i, *x[1:]) for i, t in enumerate(texts) for x in zip(*(x.tolist() for x in sd.contexts_of(*sd.hashed([t]))))]
    assert together == alone and sum(x[2] for x in alone) == sum(max(0, len((t or b"").split()) - 34) for t in texts)


def test_segments_are_streamed_together():
    """Many segments give what each gives alone; no match runs over their borders."""
    rng = random.Random(6)
    line = [b"w%d" % i for i in range(120)]
    one = sd.Automaton()
    for a in (0, 10, 11, 60):
        one.add(b" ".join(line[a:a + 35]))
    many = [b" ".join(line[a:b]) for a, b in ((0, 20), (20, 46), (5, 50), (0, 120), (50, 96), (60, 95), (95, 120))] + [b"", b"v"]
    rng.shuffle(many)
    found = list(zip(*(x.tolist() for x in one.across(many))))
    assert found == [(i, *x) for i, t in enumerate(many) for x in one.occurrences(t)] and len(found) > 3

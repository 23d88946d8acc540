import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

from rolepulse.llm import filter_audit as fa

DOCS = "doc_id long, text string, source string, part string, n string"
LABELS = "doc_id long, quality int, toxic int, source string"
NUMBERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """Each filter of each order applied to the rows that are left, one row after the other."""
    rows = []
    for doc_id, text, source, *_ in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in docs)}
        mine = [x for x in labels if doc_id is not None and x[0] == doc_id]
        rows.append((source or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in {r[0] for r in rows}:
        own, total = [r for r in rows if r[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone, left = [r for r in left if r[1][x]], [r for r in left if not r[1][x]]
                total[x] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(r[1][x] for r in own) - len(gone), sum(r[1][x] and sum(r[1].values()) == 1 for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), numbers in out.items():
            if p == part:
                numbers.append(total[order[step - 1]])
    return out


def audited(spark, docs, labels):
    rows = fa.audited(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in NUMBERS] for r in rows}
    assert len(out) == len(rows)
    return out


def text(rng):
    words = [rng.choice(["one", "Two", "three", "vier", "fünf", "日本"]) + str(rng.randrange(rng.choice([3, 900]))) for _ in range(rng.choice([3, 199, 200, 201, 260]))]
    return rng.choice([" ", "\n", "\t \x0b"]).join(words) + rng.choice(["", "", " # ", "|", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3])


def test_every_order_equals_brute_force(spark):
    rng = random.Random(3)
    texts = [text(rng) for _ in range(30)] + ["", None, "A" * 3 + "a" * 147, "A" * 3 + "a" * 146, " \n\x0c", "a" * 200_000]
    docs = [(rng.randrange(80), rng.choice(texts), rng.choice(["web", "news", "", None]), "clash", "clash") for _ in range(150)]
    docs += [(None, t, "web", None, None) for t in texts[:3] + ["", None]]  # without an id
    docs += docs[:6]  # repeated rows
    labels = [(rng.randrange(80), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for _ in range(70)] + [(None, 1, 1, "x")]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_one_text_and_no_rows(spark):
    docs = [(i, "same text", "s", None, None) for i in range(50)]
    found = audited(spark, docs, [])
    assert found == brute(docs, []) and found["s", "EABCD", 1][:2] == [1, 49]
    assert audited(spark, [], [(1, 1, 1, "x")]) == {}


def test_kernel_solution_is_the_mean_over_all_orders():
    rng = random.Random(5)
    for n in (2, 3, 5):
        game = [0] + [rng.randrange(-50, 50) for _ in range((1 << n) - 1)]
        mean = defaultdict(Fraction)
        for order in permutations(range(n)):
            s = 0
            for i in order:
                mean[i] += Fraction(game[s | 1 << i] - game[s], factorial(n))
                s |= 1 << i
        assert [sum(w * v for w, v in zip(ws, game)) for ws in fa.shapley_weights(n)] == [mean[i] for i in range(n)]

import hashlib
import random
import re
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rolepulse.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(reversed(d))) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    out = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if ok(k, m[0])]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def check(spark, texts):
    rows = pii.summarised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        got = [s for s in r.spans.split(",") if s.split(":")[0] in BASE]
        assert got == want, texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want) for k in BASE]


ODD = ["", None, "a@b.c_d@e.f", "a@b.c.d@e.f", "a@b@c.d", "x.a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.255.0", "1..2.3.4.5",
       "4111 1111 1111 1111", "4111-1111-1111-1111 4111 1111 1111 1112", "4111  1111 1111 1111", "12- 4111111111111111", "5 4111111111111111",
       "+1 (017) 555-7713 or +49 30 1234 5678-", "+1 2", "++12345678901", "é😀 a@b.co 😀 1.2.3.4 +1 (017) 555-7713", "0" * 12, "1" * 60_000,
       "1 " * 20_000, "a" * 60_000 + "@b.c", "1." * 20_000, "+" * 30_000, "+1" + " " * 30_000, "a@" * 20_000, "@b.c",
       "a@b.c " * 300, "+12345678901.2.3.4", "x\n1.2.3.4\ny@z.w\r\n"]


def test_base_spans_on_odd_texts(spark):
    check(spark, ODD)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab1203.-+@_ ()%5é", max_size=45), min_size=150, max_size=200))
def test_base_spans_on_any_text(spark, texts):
    check(spark, texts)


def test_base_spans_of_a_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").collect()
    got = {r.doc_id: r for r in pii.op9_pii(spark, sf_dir.replace("0.001", "0.01")).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(brute(r.text)).encode()).hexdigest()


def test_added_spans(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "GB82WEST12345698765432", "GB82WEST12345698765433", "my ssn is 123-45-6789", "part 123-45-6789",
             "token = 04dbebab91ab85687d33eeaaf9ac699e1188f962", "see 04dbebab91ab85687d33eeaaf9ac699e1188f962", "key " + "a" * 40]
    rows = pii.summarised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[s.split(":")[0] for s in r.spans.split(",") if s and s.split(":")[0] not in BASE] for r in rows] == [
        ["iban"], ["iban"], [], ["ssn"], [], ["secret"], [], []]
    assert rows[0].spans == "iban:5:32" and float(rows[0].scores) == 0.95 and float(rows[1].scores) == 0.6


def test_checksums(spark):
    rng = random.Random(5)
    numbers = ["".join(rng.choice("0123456789") for _ in range(rng.randint(1, 19))) for _ in range(300)]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select("n", pii.luhn(F.col("n")).alias("ok")).collect()
    assert all(r.ok == luhn(r.n) for r in got)


def test_redaction_keeps_all_other_columns(spark, docs_of):
    docs = docs_of([(1, "mail a@b.co, card 4111 1111 1111 1111!"), (2, None), (3, ""), (4, "clean é"), (None, "+1 (017) 555-7713 GB82WEST12345698765432"), (4, "clean é")])
    got = pii.redacted(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    texts = {r.doc_id: (r.text, r.n_chars, r.score) for r in got.collect()}
    assert got.count() == 6
    assert texts[1] == ("mail [EMAIL], card [CARD]!", 26, "clash") and texts[2][0] is None and texts[3][0] == "" and texts[4][:2] == ("clean é", 7)
    assert texts[None][0] == "[PHONE] [IBAN]"
    assert pii.redacted(docs_of([])).count() == 0 and pii.summarised(docs_of([])).count() == 0


def context_scores(text):
    """Base scores from the text itself."""
    out = []
    for i, kind in enumerate(pii.KINDS[:pii.BASE_KINDS]):
        for m in re.finditer(BASE[kind.name], text):
            if ok(kind.name, m[0]):
                near = re.search(kind.near, text[max(0, m.start() - pii.CONTEXT_CHARS):m.start()].lower())
                out.append((m.start(), i, round(min(kind.score + (pii.CONTEXT_BONUS if near else 0), 1), 2)))
    return [s for *_, s in sorted(out)]


def test_scores_see_the_words_before_a_span(spark):
    rng = random.Random(4)
    bits = ["a@b.c ", "1.2.3.4 ", "+12345678901 ", "mail ", "server", " é😀 ", "x" * 30, "call ", "4111 1111 1111 1111 ", "pay "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(150)]
    for r in pii.summarised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert [float(s) for s in r.scores.split(",") if s] == context_scores(texts[r.doc_id]), texts[r.doc_id]


def test_texts_of_many_labels_and_many_spans(spark):
    """A mail address of 100,000 labels, 100,000 spans in one text, a secret of any length: in seconds, without a stack overflow."""
    n = 100_000
    secret = "token " + "ab12" * 200
    texts = ["x@" + "a." * n + "com", "+12345678901 " * n, "x@" + "a." * n + "com ip 1.2.3.4", "a@b.c " * n, "1.2.3.4 " * 3000, secret]
    began = time.time()
    check(spark, texts)
    assert time.time() - began < 90
    assert pii.summarised(spark.createDataFrame([(1, secret)], "doc_id long, text string")).first().spans == "secret:6:806"


def test_running_sums(spark):
    rows = [(list(range(n)),) for n in (0, 1, 2, 5, 255, 256, 257, 700)]
    got = spark.createDataFrame(rows, "a array<int>").select("a", pii.running_sums(F.col("a")).alias("s")).collect()
    for r in got:
        assert r.s == [sum(r.a[:i + 1]) for i in range(len(r.a))]

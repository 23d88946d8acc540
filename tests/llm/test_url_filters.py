import math
import random
import re
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from rolepulse.llm import url_filters as uf


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fit = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def plain(rows):
    """The whole judgement with dictionaries, page by page."""
    pages = []
    for page, url in rows:
        host, path = parts(url)
        found = [s for s in path.split("/") if s]
        segments = [re.sub("[0-9]+", "{n}", re.sub("(?i)[0-9a-f]*[0-9][0-9a-f-]*[a-f][0-9a-f-]{6,}", "{h}", s)) for s in found]
        pages.append({"id": page, "host": host, "path": path, "rule": rule_of(host, path), "segments": segments, "t": ()})
    for depth in range(max((len(p["segments"]) for p in pages), default=0)):
        branches = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
        mixed = defaultdict(set)
        for p in pages:
            mixed[p["host"], p["t"]].add(p["rule"][1])
        here = [p for p in pages if len(p["segments"]) > depth == len(p["t"]) and (depth < uf.DEPTH or {"allow", "block"} <= mixed[p["host"], p["t"]])]
        if not here:
            break
        for p in here:
            c = branches[p["host"], p["t"]][p["segments"][depth]]
            c[0] += 1
            c[1] += p["rule"][1] is not None
            c[2] += p["rule"][1] == "block"
        for p in here:
            own = branches[p["host"], p["t"]]
            n, labelled, bad = (sum(c[i] for c in own.values()) for i in range(3))
            c, name = own[p["segments"][depth]], p["segments"][depth]
            if len(own) > uf.MANY and n < uf.FEW * len(own):
                name = "*"
            elif len(own) > 1 and c[1] >= uf.EVIDENCE:
                share = bad / labelled
                if abs(c[2] - c[1] * share) <= uf.Z * math.sqrt(c[1] * share * (1 - share)) + 1e-9:
                    name = "~"
            p["next"] = (*p["t"], name)
        for p in here:
            p["t"] = p["next"]
    for p in pages:
        p["t"] += ("**",) * (len(p["segments"]) > len(p["t"]))
    labels = [(p["host"], p["t"], p["rule"][1] == "block") for p in pages if p["rule"][1]]
    prior = (sum(x[2] for x in labels) + 1) / (len(labels) + 2)
    all_n, all_bad = Counter(t for _, t, _ in labels), Counter(t for _, t, b in labels if b)
    own_n, own_bad = Counter((h, t) for h, t, _ in labels), Counter((h, t) for h, t, b in labels if b)
    out = []
    for p in pages:
        k, t = uf.PRIOR_WEIGHT, p["t"]
        smooth = (all_bad[t] + k * prior) / (all_n[t] + k)
        share = (own_bad[p["host"], t] + k * smooth) / (own_n[p["host"], t] + k) if labels else 0.0
        out.append((p["id"], p["host"], p["path"], p["rule"][0], p["rule"][1] or ("block" if round(share, 9) >= uf.REJECT else "allow"), "/" + "/".join(t)))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("clash"), "n": F.lit(1), "template": F.lit(None).cast("int")})
    return sorted([(r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in uf.judged(df.repartition(3)).collect()], key=str)


def test_equals_plain(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "www.example.com", "x.net", "y.NET", "z.org", "net", "com:80"]
    rows = []
    for i in range(900):
        tail = rng.choice(["", "/", ".html", "?q=/es/", "#t"])
        slug = rng.choice([f"{i}", f"slug-{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x", "deadbeef0123abcd", f"v/{i}/w/x/y"])
        rows.append((i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'EN', 'de'])}/{slug}{tail}"))
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}
    assert any("*" in r[5].split("/") for r in got) and any("~" in r[5] for r in got)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a.com/en/"), (4, "http://example.com"), (5, "http://example.com/en/"), (6, "http://www.example.com/en/x"),
            (7, "http://A.b.NET/es/ü?://c"), (8, "://"), (9, "http:///en/"), (10, "http://Öcom/"), (11, "http://com/a#b"), (12, "http://net?/es/"),
            (5, "http://example.com/en/"), (None, "http://u.net/fr/"), (13, "http://x.com/a\nb/" + "s/" * 30000), (14, "http://notcom/"), (15, "a://b://c.net/es/")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, [(1, "http://a.org/x"), (2, None)]) == plain([(1, "http://a.org/x"), (2, None)])
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judged(empty).count() == 0


def test_a_later_segment_decides(spark, monkeypatch):
    """Labels that differ in the fifth or seventh segment only part the templates there; where they agree, the tree ends."""
    rules = (uf.Rule("block", "a.com", "/p/q/r/s/bad/"), uf.Rule("allow", "a.com", "/p/q/r/s/good/"),
             uf.Rule("block", "a.com", "/p/q/r/s/mixed/w/bad"), uf.Rule("allow", "a.com", "/p/q/r/s/mixed/w/good"))
    monkeypatch.setattr(uf, "RULES", rules)
    monkeypatch.setattr(uf.judged, "__defaults__", (rules,))
    rows = [(i, f"http://a.com/p/q/r/s/{('bad/y/z', 'good/y', 'mixed/w/bad', 'mixed/w/good', 'mixed/other')[i % 5]}") for i in range(60)]
    rows += [(100 + i, f"http://a.com/{p}") for i, p in enumerate(("p/q/r/s/bad", "p/q/r/s/new", "o/q/r/s/t", "p"))]
    got = found(spark, rows)
    assert got == plain(rows)
    for end in ("/s/bad/**", "/s/good/**", "/~/~/bad", "/~/~/good", "/o/q/r/s/**"):
        assert any(r[5].endswith(end) for r in got), end


def test_long_segments_take_linear_time(spark):
    """Seconds, not hours: 100,000 digits, letters, hyphens, and mixtures that nearly match."""
    n = 100_000
    odd = ["1" * n, "a" * n, "-" * n, "1-" * n, "a-" * n, "1" * n + "a", "1" * n + "abcdef0", "a-" * n + "1f234567", "1a" * n, "x1" * n]
    rows = [(i, f"http://a.com/{s}/b") for i, s in enumerate(odd)]
    began = time.time()
    got = found(spark, rows)
    assert time.time() - began < 60
    assert {r[0]: r[5].split("/")[1] for r in got}[0] == "{n}" and {r[0]: r[5].split("/")[1] for r in got}[7] == "a-" * n + "{h}"


def test_generalised_segments(spark):
    """As a pattern that backtracks says it."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("0a-fxB9") for _ in range(rng.randrange(24))) for _ in range(3000)] + ["", "deadbeef0123abcd", "2024-01-02", "a-1b-ABCDEF-0", "ab1c23456é1c234567"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [re.sub("[0-9]+", "{n}", re.sub("(?i)[0-9a-f]*[0-9][0-9a-f-]*[a-f][0-9a-f-]{6,}", "{h}", t)) for t in texts]
    assert [r.g for r in df.select(uf.generalised(F.col("t")).alias("g")).collect()] == want

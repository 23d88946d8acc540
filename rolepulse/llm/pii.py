r"""Personal data: patterns propose spans, checks confirm them, words nearby adjust the score.

DataFrame functions only. Each pattern is matched as ``\G(gap)(span)`` from the end of the last
match, so that the lengths of gaps and spans give the positions in code points; a pattern is
tried on a text only if a cheap test finds what every span of it holds. The base kinds (email,
ip, card, phone) stay whatever their score; iban, ssn and secret are added if their score, after
the words in the 48 code points before the span, reaches ``LEAST_SCORE``.

Defined cases: a null text is empty, an empty text has no spans (the hash is that of the empty
string). Repeated rows, and rows with a null id, get a row each; other columns are ignored, or
kept as they are by :func:`redacted`. Spans of different kinds may overlap; redaction replaces
what they cover together by the label of the first. Texts may be of any length and hold any number
of spans: no pattern recurses or goes back over what it took, and positions are running sums over
blocks of spans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.texts import table

LEAST_SCORE = 0.5
CONTEXT_CHARS = 48
CONTEXT_BONUS = 0.35

BASE_KINDS = 4


@dataclass(frozen=True)
class Kind:
    """``hint``: found in every text with such a span. ``near``: words that speak for it."""

    name: str
    hint: str
    pattern: str
    score: float
    near: str


_LOCAL = r"[A-Za-z0-9._%+-]"
# Possessive, and starting at the start of a run only, the patterns match what the plain ones match, in linear time.
KINDS = (
    Kind("email", "@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, r"mail|contact|write"),
    Kind("ip", r"[0-9]\.[0-9]+\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\bip\b|address|host|server|login"),
    Kind("card", r"[0-9](?:[ -]?[0-9]){11}", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}(?![ -]?[0-9])", 0.6, r"card|visa|credit|pay|konto"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, r"phone|call|tel|mobile|fax"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 0.6, r"iban|account|bank|konto"),
    Kind("ssn", r"[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, r"ssn|social"),
    Kind("secret", r"[A-Za-z0-9_]{32}", r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{32,}+(?![A-Za-z0-9_])", 0.2, r"token|key|secret|passw"),
)
#: A part of an address, at most 255, leading zeros allowed.
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right last digit by Luhn's rule."""
    backwards = F.transform(F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1))), lambda i: F.substring(F.reverse(number), i, F.lit(1)).cast("int"))
    doubled = F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number, with spaces or without, leaves 1 when divided by 97."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))
    value = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.conv(F.substring(turned, i, F.lit(1)), 36, 10).cast("int"))
    return F.aggregate(value, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def confirmed(name: str, found: Column) -> Column:
    if name == "ip":
        return found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if name == "card":
        return F.length(digits(found)).between(12, 19) & luhn(digits(found))
    if name == "phone":
        return F.length(digits(found)).between(9, 15)
    if name == "iban":
        return F.length(F.regexp_replace(found, " ", "")).between(15, 34) & mod97(found)
    if name == "secret":
        return found.rlike("[0-9]") & found.rlike("[A-Za-z]")
    return F.lit(True)


def _running(numbers: Column) -> Column:
    """Sums of the first one, two, three, ... of a short array."""
    return F.aggregate(numbers, F.array().cast("array<int>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x)))


def running_sums(numbers: Column, block: int = 256) -> Column:
    """Sums of the first one, two, three, ... of an array of any length: inside blocks, then over their sums."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(numbers) - 1, F.lit(0)), F.lit(block))
    blocks = F.transform(starts, lambda at: _running(F.slice(numbers, at + 1, F.lit(block))))
    before = F.concat(F.array(F.lit(0)), _running(F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0)))))
    # One-element transforms name what is computed once.
    return F.get(F.transform(F.array(F.struct(blocks.alias("b"), before.alias("s"))), lambda x: F.flatten(
        F.transform(x["b"], lambda b, i: F.transform(b, lambda v: v + F.get(x["s"], i))))), F.lit(0))


#: So many matches back, at least, lie the CONTEXT_CHARS before a span.
_BACK = 10


def proposed(text: Column, order: int, kind: Kind) -> Column:
    """Spans of a kind: start, order of the kind, end (code points, end exclusive), kind, found text, and what stands before it."""
    pattern = F.lit(rf"(?s)\G(.*?)({kind.pattern})")
    matched = F.struct(*[F.regexp_extract_all(text, pattern, F.lit(i)).alias(n) for i, n in enumerate(("whole", "gap", "found"))])

    def all_spans(m: Column) -> Column:
        ends = running_sums(F.transform(m["whole"], F.length))
        rows = F.arrays_zip(ends.alias("end"), m["gap"].alias("gap"), m["found"].alias("found"))

        def one(p: Column, i: Column) -> Column:
            last = F.greatest(i - _BACK, F.lit(0))
            ahead = F.when(F.length(p["gap"]) >= CONTEXT_CHARS, p["gap"]).otherwise(F.concat(F.array_join(F.slice(m["whole"], last + 1, i - last), ""), p["gap"]))
            return F.struct((p["end"] - F.length(p["found"])).alias("start"), F.lit(order).alias("order"), p["end"].alias("end"),
                            F.lit(kind.name).alias("kind"), p["found"].alias("found"), F.right(ahead, F.lit(CONTEXT_CHARS)).alias("ahead"))

        return F.transform(rows, one)

    spans = F.get(F.transform(F.array(matched), all_spans), F.lit(0))
    nothing = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,found:string,ahead:string>>")
    return F.when(F.contains(text, F.lit("@")) if kind.hint == "@" else text.rlike(kind.hint), spans).otherwise(nothing)


def scored(spans: Column, kind: Kind) -> Column:
    """Confirmed spans with a score between 0 and 1."""
    def with_score(s: Column) -> Column:
        score = F.least(F.lit(kind.score) + F.when(F.lower(s["ahead"]).rlike(kind.near), CONTEXT_BONUS).otherwise(0.0), F.lit(1.0))
        return F.struct(s["start"], s["order"], s["end"], s["kind"], F.round(score, 2).alias("score"))

    return F.transform(F.filter(spans, lambda s: confirmed(kind.name, s["found"])), with_score)


def found_in(docs: DataFrame, spans: str = "spans") -> DataFrame:
    """``docs`` with an array column of all spans, by start and then kind: start, order, end, kind, score."""
    text, own = F.coalesce(F.col("text"), F.lit("")), [f"{spans}__{k.name}" for k in KINDS]
    out = docs
    for i, (name, kind) in enumerate(zip(own, KINDS)):
        out = out.withColumn(name, proposed(text, i, kind))
    for i, (name, kind) in enumerate(zip(own, KINDS)):
        good = scored(F.col(name), kind)
        out = out.withColumn(name, good if i < BASE_KINDS else F.filter(good, lambda s: s["score"] >= LEAST_SCORE))
    return out.withColumn(spans, F.array_sort(F.concat(*own))).drop(*own)


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summarised(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, hash of the base spans, all spans and their scores, of each row."""
    found = found_in(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", *[count_of(k.name) for k in KINDS[:BASE_KINDS]],
        F.sha2(listed(F.filter("spans", lambda s: s["order"] < BASE_KINDS)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by [KIND], and ``n_chars``, where there is one, set to the new length."""
    spans = "__spans"
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        piece = F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["parts"], piece)).otherwise(a["parts"]).alias("parts"))

    def finish(a: Column) -> Column:
        return F.array_join(F.concat(a["parts"], F.array(F.substring(text, a["at"] + 1, F.length(text)))), "")

    new = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
    out = found_in(docs, spans).withColumn("text", new).drop(spans)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else out


def op9_pii(spark, sf_dir: str) -> DataFrame:
    return summarised(table(spark, sf_dir, "documents"))

r"""URL filter: rules first, then a path-template tree per host with smoothed labelled purity.

A url's host and path are those of the registered query's contract. The tree has ``DEPTH`` levels
everywhere, and goes on below every branch that still has labels of both kinds, as deep as its paths
are; one wildcard stands for what follows. Digits become ``{n}``, long hexadecimal runs ``{h}``. Going down the tree of a host, a segment with many values of few pages each becomes
the wildcard ``*``; of siblings with labels, those whose share of bad pages does not differ
from the share of all (two-sided test at 95 %) are merged into the branch ``~``. A template
is rejected if its share of bad pages, smoothed towards the share of the same template over
all hosts, and that towards the share of all labels, is at least ``REJECT``.

The tree is built from counts of (host, segments), never from pages; pages meet it in one join.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule.
Empty segments count for nothing, so that ``/a/`` and ``/a`` are alike. Rules of equal length
are tried in their order. Without a label everything is allowed. Repeated rows and null ids get
rows each; other columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolepulse.llm.texts import stored, table

#: Levels of the tree below branches whose labels agree.
DEPTH = 4
#: A segment varies if it has more values than MANY, of fewer than FEW pages on average.
MANY, FEW = 20, 4
#: Labels that a branch needs to be compared with its siblings; the z of the test.
EVIDENCE, Z = 5, 1.96
#: Labels that the prior counts for.
PRIOR_WEIGHT = 8.0
REJECT = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        at_host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit(f".{self.host}"))
        return at_host & F.startswith(F.col("path"), F.lit(self.path))


#: Fixed rules of the registered query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, host and path of each row."""
    rest = F.when(F.contains("url", F.lit("://")), F.expr("substring(url, locate('://', url) + 3)"))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def longest(rules: tuple[Rule, ...], value: str) -> Column:
    """The ``name`` or ``verdict`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        out = F.when(rule.fits(), getattr(rule, value)).otherwise(out)
    return out


#: A run of hexadecimal digits and hyphens; one that is an identifier, from its hyphen before the first digit on.
#: Without backtracking into what was taken, so that both are linear in the length of a segment.
_RUNS = r"[0-9A-Fa-f-]++|[^0-9A-Fa-f-]++"
_IDENTIFIER = r"^((?:[A-Fa-f-]*-)?)[A-Fa-f]*+[0-9][0-9-]*+[A-Fa-f][0-9A-Fa-f-]{6,}+$"


def generalised(segment: Column) -> Column:
    """A segment with ``{h}`` for runs that hold a digit, later a letter, and at least six more, and ``{n}`` for other digits."""
    runs = F.transform(F.regexp_extract_all(segment, F.lit(_RUNS), F.lit(0)), lambda r: F.regexp_replace(r, _IDENTIFIER, "$1{h}"))
    return F.regexp_replace(F.when(F.length(segment) < 8, segment).otherwise(F.array_join(runs, "")), "[0-9]+", "{n}")


def segments(path: Column) -> Column:
    """The generalised segments of a path."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), generalised)


_SUMS = ("n", "labelled", "bad")


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names or _SUMS]


def templates(keys: DataFrame) -> DataFrame:
    """``keys`` (host, segments, n, labelled, bad) with the ``template`` of each."""
    tree = stored(keys.withColumns({"template": F.array().cast("array<string>"), "goes_on": F.lit(True)}), "url-tree")
    depth = 0
    while True:
        depth += 1
        here = tree.withColumn("segment", F.when(F.col("goes_on"), F.get("segments", F.lit(depth - 1))))
        if depth > DEPTH and here.where("segment IS NOT NULL").isEmpty():
            break
        branches = stored(here.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(*_sums()), "url-branches")
        pool = branches.groupBy("host", "template").agg(
            F.count("*").alias("values"), F.sum("n").alias("pages"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
        share = F.col("all_bad") / F.nullif(F.col("all_labelled"), F.lit(0))
        varies = (F.col("values") > MANY) & (F.col("pages") < FEW * F.col("values"))
        off = F.abs(F.col("bad") - F.col("labelled") * share)
        alike = (F.col("values") > 1) & (F.col("labelled") >= EVIDENCE) & (off <= Z * F.sqrt(F.col("labelled") * share * (1 - share)) + 1e-9)
        named = branches.join(pool, ["host", "template"]).select(
            "host", "template", "segment", F.when(varies, "*").when(alike, "~").otherwise(F.col("segment")).alias("branch"))
        step = F.when(F.col("branch").isNull(), F.col("template")).otherwise(F.concat("template", F.array("branch")))
        tree = here.join(named, ["host", "template", "segment"], "left").select("host", "segments", *_SUMS, step.alias("template"))
        if depth < DEPTH:
            tree = stored(tree.withColumn("goes_on", F.lit(True)), "url-tree")
        else:
            tree = stored(tree, "url-tree")
            mixed = tree.groupBy("host", "template").agg((F.sum("bad").between(1, F.sum("labelled") - 1)).alias("goes_on"))
            tree = stored(tree.join(mixed, ["host", "template"]), "url-tree")
    beyond = F.size("segments") > F.size("template")
    return tree.drop("goes_on").withColumn("template", F.when(beyond, F.concat("template", F.array(F.lit("**")))).otherwise(F.col("template")))


def purity(tree: DataFrame) -> DataFrame:
    """host, template, and its smoothed share of bad pages."""
    whole = tree.agg(*_sums("labelled", "bad")).first()  # one row
    prior = ((whole["bad"] or 0) + 1) / ((whole["labelled"] or 0) + 2)
    own = tree.groupBy("host", "template").agg(*_sums())
    everywhere = own.groupBy("template").agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"))
    smooth = (F.col("all_bad") + PRIOR_WEIGHT * prior) / (F.col("all_labelled") + PRIOR_WEIGHT)
    share = F.when(F.lit(bool(whole["labelled"])), (F.col("bad") + PRIOR_WEIGHT * smooth) / (F.col("labelled") + PRIOR_WEIGHT)).otherwise(0.0)
    return own.join(everywhere, "template").select("host", "template", F.round(share, 9).alias("bad_share"))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and bad_share; the rules' verdicts are the labels of the tree."""
    rows = host_and_path(pages).withColumns({"rule": longest(rules, "name"), "by_rule": longest(rules, "verdict"), "segments": segments(F.col("path"))})
    keys = rows.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count("by_rule").alias("labelled"), F.count_if(F.col("by_rule") == "block").alias("bad"))
    tree = templates(keys)
    decided = tree.join(purity(tree), ["host", "template"]).select("host", "segments", "template", "bad_share")
    verdict = F.coalesce("by_rule", F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow"))
    return rows.join(decided, ["host", "segments"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "bad_share")


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))

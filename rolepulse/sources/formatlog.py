"""Raw game log: regular-expression extraction shared by batch and stream.

Every line is looked at with cheap substring tests first; only a line carrying a
type's marker pays for that type's regular expression, and all capture groups
come out of one further match.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.layouts import RAW_FILE, RAW_ZONES
from rolepulse.sources.growing import read_growing

# ---- fixed values: line patterns --------------------------------------------
TIMESTAMP = r"(?:\d\d){1,2}-(?:0?[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]|[1-9])[T ](?:2[0-3]|[01]?\d):?[0-5]\d(?::?(?:[0-5]?\d|60)(?:[:.,]\d+)?)?(?:Z|[+-](?:2[0-3]|[01]?\d)(?::?[0-5]\d))?"
NUMBER = r"(?<![0-9.+-])[+-]?(?:\d+(?:\.\d+)?|\.\d+)"
DAY = r"\d{4}-\d{2}-\d{2}"
TASK_ACTION = r"\w+"

LINE_PATTERNS = {
    "login": r"<time>.*?formatlog:rolelogin:\S+:roleid=<n>:\S+:lev=<n>",
    "logout": r"<time>.*?formatlog:rolelogout:\S+:roleid=<n>:\S+:lev=<n>:\S+:time=<n>",
    "task": r"<time>.*?formatlog:task_<action>:from=<_>:os=<_>:roleid=<n>:level=<n>:taskid=<n>",
    "createrole": r"<time>.*?formatlog:createrole:from\S+:roleid=<n>:\S+:profession=<n>:nation=<n>",
    "levelup": r"<time>.*?formatlog:levelup_lo:roleid=<n>:level=<n>:\S+:time_used=<n>:prof=<n>",
    "death": (
        r"<time>.*?formatlog:death:roleid=<n>:level=<n>:attacker_id=<n>:attacker_level=<n>"
        r":\S+:scene_tag=<n>:x=<n>:y=<n>:z=<n>"
    ),
}
# ---- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class LineKind:
    """One recognised kind of line: its marker, captured fields and constants."""

    log_type: str
    marker: str
    fields: tuple[str, ...]
    constants: tuple[tuple[str, str], ...] = ()


LINE_KINDS: dict[str, LineKind] = {
    "login": LineKind(
        "roleloginlogout", "formatlog:rolelogin:", ("log_time", "roleid", "level"),
        (("loginout", "login"), ("online_time", "0")),
    ),
    "logout": LineKind(
        "roleloginlogout", "formatlog:rolelogout:", ("log_time", "roleid", "level", "online_time"),
        (("loginout", "logout"),),
    ),
    "task": LineKind("taskflow", "formatlog:task_", ("log_time", "flow_type", "roleid", "level", "taskid")),
    "createrole": LineKind("createrole", "formatlog:createrole:", ("log_time", "roleid", "profession", "nation")),
    "levelup": LineKind(
        "levelup", "formatlog:levelup_lo:", ("log_time", "roleid", "level", "time_used", "profession")
    ),
    "death": LineKind(
        "death", "formatlog:death:",
        ("log_time", "roleid", "level", "attacker_id", "attacker_level", "scene_tag", "x", "y", "z"),
    ),
}

PARSED_FIELDS = (
    "log_time", "roleid", "level", "loginout", "online_time", "flow_type", "taskid", "profession", "nation",
    "time_used", "attacker_id", "attacker_level", "scene_tag", "x", "y", "z",
)

# Flow-line templates: the parsed fields of each type in output order.
LINE_TEMPLATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "roleloginlogout": ("%s %s %s %s %s", ("log_time", "roleid", "loginout", "level", "online_time")),
    "taskflow": ("%s %s %s %s %s", ("log_time", "roleid", "level", "taskid", "flow_type")),
    "createrole": ("%s %s %s %s", ("log_time", "roleid", "profession", "nation")),
    "levelup": ("%s %s %s %s %s", ("log_time", "roleid", "profession", "level", "time_used")),
    "death": (
        "%s %s %s %s %s %s (%s,%s,%s)",
        ("log_time", "roleid", "level", "attacker_id", "attacker_level", "scene_tag", "x", "y", "z"),
    ),
}

_SEP = "\u0001"


def line_regex(kind: str, task_action: str = TASK_ACTION) -> str:
    return (
        LINE_PATTERNS[kind]
        .replace("<time>", f"({TIMESTAMP})")
        .replace("<action>", f"({task_action})")
        .replace("<n>", f"({NUMBER})")
        .replace("<_>", NUMBER)
    )


def _candidates(line: Column, task_action: str) -> Column:
    """Array with the captures of the first pattern that matches, empty when none does.

    Each kind whose marker occurs gets one match attempt that rewrites the line to
    ``kind, group 1, group 2, …``; an unchanged line means no match (a rewritten one
    has lost its ``formatlog:``).
    """
    tries = []
    for kind, spec in LINE_KINDS.items():
        whole = rf"(?s)^.*?{line_regex(kind, task_action)}.*\z"
        groups = _SEP.join([kind, *[f"${i + 1}" for i in range(len(spec.fields))]])
        tries.append(F.when(line.contains(spec.marker), F.regexp_replace(line, whole, groups)))
    return F.slice(F.filter(F.array(*tries), lambda t: t.isNotNull() & (t != line)), 1, 1)


def _log_type(kind: Column) -> Column:
    out = None
    for name, spec in LINE_KINDS.items():
        out = F.when(kind == name, spec.log_type) if out is None else out.when(kind == name, spec.log_type)
    return out


ZONE_IN_PATH = f"(?:zone=)?({NUMBER})/(?:day=)?{DAY}"


def path_zone(path: Column) -> Column:
    """Zone of a ``…/<zone>/<day>…`` path (plain or ``zone=``/``day=`` folders); '' if it does not match."""
    return F.regexp_extract(path, ZONE_IN_PATH, 1)


def path_day(path: Column) -> Column:
    return F.regexp_extract(path, f"(?:zone=)?{NUMBER}/(?:day=)?({DAY})", 1)


# Where a raw line stands in its source, besides its place inside a split of the file.
SOURCE_ORDER = ("modified", "path", "block")


def _raw_lines(lines: DataFrame, zones: Iterable[str]) -> DataFrame:
    path = F.col("_metadata.file_path")
    # A filter on the path alone: files of other zones are not opened.
    return lines.where(path_zone(path).isin(list(zones))).select(
        "value", path.alias("path"), F.unix_micros(F.col("_metadata.file_modification_time")).alias("modified"),
        F.col("_metadata.file_block_start").alias("block"))


def read_raw(
    spark: SparkSession, path: str | list[str], file_name: str = RAW_FILE, zones: Iterable[str] = RAW_ZONES
) -> DataFrame:
    """Raw lines of the files called ``file_name`` (a glob) of some zones: ``value`` and the SOURCE_ORDER columns."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", file_name)
    return _raw_lines(reader.text(path), zones)


def read_raw_stream(
    spark: SparkSession, path: str, max_files: int | None = None, file_name: str = RAW_FILE,
    zones: Iterable[str] = RAW_ZONES,
) -> DataFrame:
    """The same as a stream of rolled files: a file is read once, as a whole."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", file_name)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _raw_lines(reader.load(path), zones)


def read_growing_stream(
    spark: SparkSession, path: str, file_name: str = RAW_FILE, zones: Iterable[str] = RAW_ZONES, **options,
) -> DataFrame:
    """The same as a stream of the lines appended to files that grow (options of :func:`read_growing`)."""
    return read_growing(spark, path, file_name, zones, ZONE_IN_PATH, **options)


def has_marker(line: Column) -> Column:
    """Whether some kind's marker occurs: a line without one matches no pattern."""
    out = F.lit(False)
    for spec in LINE_KINDS.values():
        out = out | line.contains(spec.marker)
    return out


def _hits(lines: DataFrame, task_action: str, keep_unmatched: bool) -> DataFrame:
    # The generator evaluates the patterns once per line: filters and columns that
    # look at the result cannot be pushed below it and repeat the matching.
    explode = F.explode_outer if keep_unmatched else F.explode
    hits = lines.select("*", explode(_candidates(F.col("value"), task_action)).alias("hit"))
    return hits.withColumn("kind", F.substring_index("hit", _SEP, 1)).withColumn("log_type", _log_type(F.col("kind")))


def classify(lines: DataFrame, task_action: str = TASK_ACTION) -> DataFrame:
    """Add ``kind`` and ``log_type`` (both NULL for a line no pattern matches)."""
    return _hits(lines, task_action, keep_unmatched=True).drop("hit")


def drop_unmatched(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("kind").isNotNull())


def parse(lines: DataFrame, task_action: str = TASK_ACTION) -> DataFrame:
    """Matched lines as one sparse record per line; every field is text, as in the log."""
    cut = _hits(lines, task_action, keep_unmatched=False).withColumn("_cut", F.split("hit", _SEP))

    def field(name: str) -> Column:
        out = None
        for kind, spec in LINE_KINDS.items():
            if name in spec.fields:
                value = F.get("_cut", F.lit(spec.fields.index(name) + 1))
            elif name in dict(spec.constants):
                value = F.lit(dict(spec.constants)[name])
            else:
                continue
            out = F.when(F.col("kind") == kind, value) if out is None else out.when(F.col("kind") == kind, value)
        return out.alias(name)

    carried = [c for c in lines.columns if c != "value"]
    return cut.select(*carried, "kind", "log_type", *[field(n) for n in PARSED_FIELDS])


def with_path_fields(parsed: DataFrame) -> DataFrame:
    """Add ``zone`` and ``day`` from ``path``; records whose path does not match are left out."""
    return (
        parsed.withColumn("zone", path_zone(F.col("path")))
        .withColumn("day", path_day(F.col("path")))
        .where(F.col("zone") != "")
    )


def flow_line(log_type: Column) -> Column:
    """Flow-file line of a parsed record, by its type's template."""
    out = None
    for name, (template, fields) in LINE_TEMPLATES.items():
        text = F.format_string(template, *[F.col(f) for f in fields])
        out = F.when(log_type == name, text) if out is None else out.when(log_type == name, text)
    return out

"""Text helpers: names, positions, JSON-kept arrays, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_date(name: Column) -> Column:
    """Text before the first underscore; NULL when there is none."""
    return F.when(F.instr(name, "_") > 0, F.substring_index(name, "_", 1))


def name_type(name: Column) -> Column:
    """Text after the first underscore; NULL when there is none."""
    at = F.instr(name, "_")
    return F.when(at > 0, F.substr(name, at + 1))


def find_substring(text: Column, needle: Column) -> Column:
    """0-based position of ``needle`` in ``text``, -1 when absent."""
    return F.position(needle, text) - 1


def position_parts(pos: Column) -> Column:
    """Struct (x, y, z) of ``"(x,y,z)"``, cut toward zero; NULL parts when malformed."""
    parts = F.filter(F.split(pos, "[,()]"), lambda p: p != "")
    part = lambda i: F.get(parts, F.lit(i)).try_cast("double").cast("int")
    return F.struct(part(0).alias("x"), part(1).alias("y"), part(2).alias("z"))


def array_to_json(values: Column) -> Column:
    return F.to_json(values)


def json_to_array(text: Column, element: str = "int") -> Column:
    return F.from_json(text, f"array<{element}>")


def safe_ratio(value: Column, top: Column) -> Column:
    """``value / top`` as double, 0.0 when ``top`` is 0."""
    return F.when(top == 0, F.lit(0.0)).otherwise(value.cast("double") / top)

"""Registered queries, each beside the SQL that states the same result."""

from __future__ import annotations

from rolepulse.registry import (  # noqa: F401
    aggregates, churn, endtoend, joins, parsing, scalars, sources, state, streams, tables, zones,
)
from rolepulse.registry.base import ORACLES, QUERIES  # noqa: F401

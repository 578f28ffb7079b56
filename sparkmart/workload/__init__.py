"""Registered queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from sparkmart.workload import (  # noqa: F401  (importing registers the queries)
    aggregates,
    changes,
    functions,
    joins,
    marts,
    retract,
    shaping,
    sinks,
    streams,
)
from sparkmart.workload.base import REGISTRY

__all__ = ["REGISTRY"]

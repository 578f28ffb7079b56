"""Operators of a training-data pipeline; nothing else in the library imports them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# functions go to the executors with their code, so these need not have the library installed
cloudpickle.register_pickle_by_value(sys.modules["sparkmart"])

from sparkmart.llm import queries  # noqa: E402, F401  (importing registers the queries)
from sparkmart.llm.registry import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]

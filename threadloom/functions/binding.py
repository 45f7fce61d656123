"""Naming a value inside an expression, and tables as constants of a plan."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def constant(value, schema: str) -> Column:
    """A table of any depth as one literal; Spark evaluates it once when it optimises the plan."""
    return F.from_json(F.lit(json.dumps(value)), schema)

"""Small helpers for Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then) -> Column:
    """``then(value)`` with the value evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))

"""Small helpers for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` or a lambda inside it uses it.

    Lambdas are interpreted element by element and have no common subexpressions; binding the value as the only element
    of an array is what keeps, say, a regular expression out of an inner loop.
    """
    return F.transform(F.array(value), body)[0]

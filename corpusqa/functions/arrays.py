"""Array helpers built on higher-order functions."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body``.

    Spark SQL has no LET; an expression written inside a lambda is evaluated
    for every element. ``aggregate`` evaluates its zero value exactly once,
    and its finish function sees that value as a bound variable.
    """
    return F.aggregate(F.array(F.lit(0)), value, lambda acc, _x: acc, body)


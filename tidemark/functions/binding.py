"""A name for a part of an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of the value, which is computed once for each row however often the body names it.

    Without it an expression that names its parts several times, on several levels, grows
    exponentially in the plan.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def exploded(frame: DataFrame, array: str, alias: str) -> DataFrame:
    """`frame` with one row for each element of an array column, which is computed once for each row.

    A plain explode makes Spark infer a filter on the array's size, push it to the scan and compute
    the array there as well.
    """
    rest = [c for c in frame.columns if c != array]
    return frame.select(*rest, F.explode_outer(array).alias(alias)).where(F.col(alias).isNotNull())


def exploded_with_place(frame: DataFrame, array: str, place: str, alias: str) -> DataFrame:
    """The same, with each element's place in the array."""
    rest = [c for c in frame.columns if c != array]
    return frame.select(*rest, F.posexplode_outer(array).alias(place, alias)).where(F.col(place).isNotNull())

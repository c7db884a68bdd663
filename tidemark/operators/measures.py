"""Aggregates that can be computed in parts and merged.

A measure is ``(function, column)`` with function ``count``, ``sum``, ``min``,
``max`` or ``avg``; ``("count", "*")`` counts rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

Measures = Mapping[str, tuple[str, str]]


def _count(column: str) -> Column:
    return F.count(F.lit(1)) if column == "*" else F.count(column)


def _check(measures: Measures) -> None:
    for name, (function, _) in measures.items():
        if function not in ("count", "sum", "min", "max", "avg"):
            raise ValueError(f"measure {name}: {function!r} cannot be merged from parts")


def direct(measures: Measures) -> list[Column]:
    _check(measures)
    return [
        (_count(c) if f == "count" else getattr(F, f)(c)).alias(name)
        for name, (f, c) in measures.items()
    ]


def _is_decimal(df: DataFrame, column: str) -> bool:
    return isinstance(df.select(column).schema[0].dataType, DecimalType)


def partial(measures: Measures, df: DataFrame) -> list[Column]:
    """Parts of the measures of ``df``. As Spark does, averages of numbers other than decimals sum doubles."""
    _check(measures)
    parts = []
    for name, (function, column) in measures.items():
        if function in ("count", "avg"):
            parts.append(_count(column).alias(f"_n_{name}"))
        if function == "sum" or function == "avg" and _is_decimal(df, column):
            parts.append(F.sum(column).alias(f"_s_{name}"))
        elif function == "avg":
            parts.append(F.sum(F.col(column).cast("double")).alias(f"_s_{name}"))
        if function in ("min", "max"):
            parts.append(getattr(F, function)(column).alias(f"_x_{name}"))
    return parts


def merged(measures: Measures, df: DataFrame) -> list[Column]:
    """The measures from their parts, in the types that Spark's own aggregates over ``df`` have."""
    kinds = df.agg(*direct(measures)).schema
    sums = df.agg(*[F.sum(c).alias(name) for name, (f, c) in measures.items() if f == "avg"] or [F.count(F.lit(1))]).schema
    columns = []
    for name, (function, column) in measures.items():
        if function == "count":
            total = F.sum(f"_n_{name}")
        elif function == "sum":
            total = F.sum(f"_s_{name}")
        elif function == "avg":
            whole = F.sum(f"_s_{name}")
            if _is_decimal(df, column):
                whole = whole.cast(sums[name].dataType)
            total = F.try_divide(whole, F.sum(f"_n_{name}"))
        else:
            total = getattr(F, function)(f"_x_{name}")
        columns.append(total.cast(kinds[name].dataType).alias(name))
    return columns

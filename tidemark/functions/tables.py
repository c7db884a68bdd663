"""Table functions over a table argument: a class whose columns follow from the table it is given.

Called in SQL as ``f(TABLE(...) PARTITION BY ... ORDER BY ..., ...)``. Spark shuffles by the
partition columns, sorts, and passes the rows of each partition in order, one by one; a
function that keeps a fixed state therefore holds however many rows a partition has.
"""

from __future__ import annotations

from pyspark.sql.types import LongType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def _named(arguments: dict[str, AnalyzeArgument]) -> dict[str, str]:
    for place, argument in arguments.items():
        if not argument.isConstantExpression or not isinstance(argument.value, str):
            raise ValueError(f"{place} must be the name of a column, as a text")
    return {place: argument.value for place, argument in arguments.items()}


class Runs:
    """``runs(TABLE(t) PARTITION BY key ORDER BY (at), 'key', 'value', 'at')``: rows on end with one value.

    Gives (key, value, ``n``, ``first_at``, ``last_at``) for every run, in the types of the
    table's columns. Nulls make runs of their own; an empty table has none.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, value: AnalyzeArgument, at: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("runs needs a table as its first argument")
        names = _named({"key": key, "value": value, "at": at})
        fields = {f.name: f for f in rows.dataType.fields}
        if unknown := sorted(set(names.values()) - set(fields)):
            raise ValueError(f"runs: the table has no column {unknown}, only {sorted(fields)}")
        schema = StructType([fields[names["key"]], fields[names["value"]]]).add("n", LongType())
        for place in ("first_at", "last_at"):
            schema = schema.add(place, fields[names["at"]].dataType)
        return AnalyzeResult(schema=schema)

    def __init__(self):
        self.run = None

    def eval(self, rows, key, value, at):
        if self.run is not None and self.run[1] == rows[value]:
            self.run[2] += 1
            self.run[4] = rows[at]
            return
        yield from self.terminate()
        self.run = [rows[key], rows[value], 1, rows[at], rows[at]]

    def terminate(self):
        if self.run is not None:
            yield tuple(self.run)

"""Keys of Python operators with state, as text.

Rows reach such an operator as pandas, where an integer beside a null becomes a float: Spark would
then keep the state of another key. Text stays what it is, nulls included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.messages import MICROSECONDS

_WRITTEN = {"timeZone": "UTC", "ignoreNullFields": "false", **MICROSECONDS}
_READ = {"mode": "FAILFAST", "timeZone": "UTC"}


def written(columns: Sequence[Column | str]) -> Column:
    """The columns as one text; never null."""
    return F.to_json(F.struct(*columns), _WRITTEN)


def parsed(text: str, schema: StructType) -> Column:
    """The columns of such a text, as a struct."""
    return F.from_json(text, schema, _READ)

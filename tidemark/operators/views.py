"""Named views and inserts by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def view(name: str, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Register ``df`` under ``name`` for later statements.

    Without ``columns`` the names of the query stay. A list given here is applied
    strictly: one name per column.
    """
    if columns is not None:
        if len(columns) != len(df.columns):
            raise ValueError(f"view {name}: {len(columns)} names for {len(df.columns)} columns")
        df = df.toDF(*columns)
    df.createOrReplaceTempView(name)
    return df


def as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def align(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Fit a query to the columns of its target, by position.

    Names come from the target. A different number of columns, or a type that
    does not widen to the target's, is an error.
    """
    schema = as_schema(schema)
    if len(schema) != len(df.columns):
        raise ValueError(f"insert of {len(df.columns)} columns into {len(schema)}: {schema.names}")
    return df.toDF(*schema.names).to(schema)

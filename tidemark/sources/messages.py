"""Messages of bytes: decoding and encoding, whatever carries them.

Any ``DataFrame`` with a binary (or string) ``value`` column will do, batch or
stream, so the same code serves a message topic and files of messages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.views import as_schema

UNDECODED = "_undecoded"
#: By default Spark writes milliseconds; it reads any number of digits.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def decode_json(
    df: DataFrame, schema: StructType | str, value: str = "value", keep_undecoded: bool = False
) -> DataFrame:
    """JSON objects to the declared columns; fields not declared are dropped.

    A message that does not decode is never lost: with ``keep_undecoded`` the result
    has one more column with its raw text (null for good rows), to be separated by
    ``split_undecoded``. Without it such a message fails the job.
    """
    schema = as_schema(schema)
    text = F.col(value).cast("string")
    if not keep_undecoded:
        # The parser takes a message without any text for a missing value.
        blank = F.coalesce(F.regexp_replace(text, r"\s+", "") == "", F.lit(True))
        text = F.when(blank, F.raise_error(F.lit("a message is null or blank"))).otherwise(text)
        parsed = F.from_json(text, schema, {"mode": "FAILFAST", "timeZone": "UTC"})
        return df.select(parsed.alias("_message")).select("_message.*")
    marked = StructType([*schema.fields, StructField(UNDECODED, StringType())])
    parsed = F.from_json(
        text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNDECODED, "timeZone": "UTC"}
    )
    bad = (
        F.when(F.col("_message").isNull(), F.coalesce(F.col("_text"), F.lit("")))
        .otherwise(F.col("_message")[UNDECODED])
        .alias(UNDECODED)
    )
    return df.select(parsed.alias("_message"), text.alias("_text")).select(
        *[F.col("_message")[name].alias(name) for name in schema.names], bad
    )


def split_undecoded(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the raw text of the others as ``value``."""
    good = df.where(F.col(UNDECODED).isNull()).drop(UNDECODED)
    bad = df.where(F.col(UNDECODED).isNotNull()).select(F.col(UNDECODED).alias("value"))
    return good, bad


def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows to ``value`` bytes, one JSON object each, and ``key`` bytes if a key column is named.

    Nulls and microseconds are written, so that a decoded row equals the row encoded.
    """
    body = F.to_json(F.struct(*df.columns), {"timeZone": "UTC", "ignoreNullFields": "false", **MICROSECONDS})
    columns = [body.cast("binary").alias("value")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").cast("binary").alias("key"))
    return df.select(*columns)


def decode_raw(df: DataFrame, names: Sequence[str] = ("key", "value")) -> DataFrame:
    """Key and payload as bytes under the declared names."""
    key, value = names
    return df.select(F.col("key").cast("binary").alias(key), F.col("value").cast("binary").alias(value))


def encode_raw(df: DataFrame) -> DataFrame:
    """A frame of two byte columns (key, payload) as ``key`` and ``value``."""
    if [t for _, t in df.dtypes] != ["binary", "binary"]:
        raise ValueError(f"need two binary columns, got {df.dtypes}")
    return df.toDF("key", "value")

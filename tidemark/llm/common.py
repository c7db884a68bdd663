"""What several operators share: sizes, identities of rows, cut lineage."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Words are separated by ASCII white space, or by everything ASCII that is no letter or digit.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parts are not made smaller than this for the sake of parallel tasks.
LEAST_BYTES = 1 << 20

KEY, BODY, TWIN = "_key", "_body", "_twin"


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Id and text under names of our own, so that no further column of the input can clash.

    ``_twin`` tells rows of one id with different texts apart; rows with equal id and text
    are alike in every result and need not be told apart. A null text is empty.
    """
    body = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].alias(KEY), body.alias(BODY), F.xxhash64(body).alias(TWIN), *[docs[c].alias(f"_{c}") for c in more]
    )


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """As many parts as keep each near ``each`` bytes, and as many as Spark shuffles to unless they got tiny."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(usual, ceil(size / LEAST_BYTES)), ceil(size / each), 1)


def cut(df: DataFrame) -> DataFrame:
    """Stores rows in the cluster's checkpoint folder, so that later steps start from there."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "cut"))
    return df.checkpoint()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: inside a lambda an expression runs for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def ascii_lower(text: Column) -> Column:
    """A-Z only; other capitals stay."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of an already lower-cased text; none for an empty text."""
    return F.regexp_extract_all(text, F.lit(f"({PLAIN_WORD})"), F.lit(1))

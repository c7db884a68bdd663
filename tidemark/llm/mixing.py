"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACED_WORD, cut

#: Pareto ranks are cut into so many bins, so that a source's rows never meet in one task.
BINS = 4096
#: Of the 128 bits of md5, the first 13 hex digits make a number below 2 ** 52.
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number between 0 and 1, both excluded, that depends on the parts alone."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[float], limit: float) -> DataFrame:
    """(_source, source_size, target): all words shared by weight, none above ``limit`` times its size.

    A source above its limit gives the excess to the others by weight. That ends where the
    sources below a level of limit / weight are full and the rest have one level in common,
    so one pass over the sources in that order finds it. The table has a row per source.
    """
    sums = sizes.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    place = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    sums = sums.select("*", weight.alias("weight"), (F.lit(float(limit)) * F.col("source_size")).alias("most"))
    sums = sums.withColumn("fill", F.col("most") / F.col("weight"))
    order = Window.orderBy("fill", F.col("_source").asc_nulls_last())
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - full) / rest
    sums = sums.select("*", level.alias("level"), F.row_number().over(order).alias("at"))
    fits = F.when(F.col("level") <= F.col("fill"), F.struct("at", "level"))
    common = F.min(fits).over(everything)["level"]
    return sums.select("_source", "source_size", F.least("most", common * F.col("weight")).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    limit: float = 3.0,
    seed: int = 0,
    importance: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    twin: Column | None = None,
) -> DataFrame:
    """Every row of ``docs`` with its ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    A source whose target is r times its size takes each document floor(r) times for certain.
    For the rest, documents are ranked by their random odds over their inclusion odds, and the
    first ones are taken whose words come nearest to the rest. ``importance`` (a positive
    function of ``_size``) multiplies a document's inclusion odds.

    A null text has no words. Rows without a source are a source of their own, placed last.
    Rows with equal id and size share a rank; rows without an id have ranks by their texts.
    ``twin``, a column of ``docs`` that tells rows of one id apart, comes out as ``twin``. An
    empty table gives an empty table; if no document has a word, every target is 0. Only the
    three named columns are read. The result has ``doc_id`` and ``source`` under those names.
    """
    size = F.coalesce(F.regexp_count(docs[text_col], F.lit(SPACED_WORD)), F.lit(0)).cast("long")
    named = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce(docs[text_col], F.lit("")))))
    chance = uniform(named, F.lit(str(seed))).alias("_chance")
    sizes = docs.select(docs[id_col].alias("_key"), docs[source_col].alias("_source"), size.alias("_size"), chance, (F.lit(None) if twin is None else twin).alias("_twin"))
    odds = F.lit(1.0) if importance is None else importance
    rank = (F.col("_chance") / (F.lit(1.0) - F.col("_chance"))) / odds
    ranked = cut(sizes.select("*", rank.alias("_odds")).drop("_chance"))

    # Inclusion odds have the common factor f / (1 - f) within a source: it moves no rank there.
    ranked = ranked.withColumn("_rank", F.col("_odds") / (F.lit(1.0) + F.col("_odds")))
    ranked = ranked.withColumn("_bin", F.floor(F.col("_rank") * BINS).cast("int"))
    targets = source_targets(ranked, weights, limit)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(ratio).cast("long"))
    targets = targets.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))

    bins = ranked.groupBy("_source", "_bin").agg(F.sum("_size").alias("words"))
    upto = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("after", F.sum("words").over(upto)).withColumn("before", F.col("after") - F.col("words"))
    bins = bins.alias("b").join(targets.alias("t"), F.expr("b._source <=> t._source"))
    bins = bins.select(F.col("b._source").alias("_bin_source"), F.col("_bin").alias("_bin_no"), "before", "after", "source_size", "target", "whole", "left")

    rows = ranked.join(bins, F.expr("_source <=> _bin_source AND _bin = _bin_no"))
    within = F.col("after") <= F.col("left")
    beyond = F.col("before") >= F.col("left")
    clear = rows.where(within | beyond).withColumn("more", within.cast("long"))
    # Only the bin in which a source's rest ends needs its rows in order.
    order = Window.partitionBy("_source", "_bin").orderBy("_rank", "_key", "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = F.col("before") + F.sum("_size").over(order) - F.col("_size")
    edge = rows.where(~(within | beyond)).withColumn("more", (ahead + F.col("_size") / 2.0 <= F.col("left")).cast("long"))
    copies = (F.col("whole") + F.col("more")).alias("copies")
    return clear.unionByName(edge).select(
        F.col("_key").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        copies,
        (copies * F.col("_size")).alias("taken"),
        *([] if twin is None else [F.col("_twin").alias("twin")]),
    )


def length_odds() -> Column:
    """Odds that grow twofold up to 1,000 words: long documents are taken somewhat more often."""
    return F.lit(1.0) + F.least(F.col("_size"), F.lit(1000)) / F.lit(1000.0)


#: The query's rows in DuckDB.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
drawn AS (
  SELECT *, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null' || md5(coalesce(text, ''))) || '|0'), 1, 13))::BIGINT::DOUBLE + 0.5)
            / 4503599627370496.0 AS u FROM sized),
odds AS (SELECT *, (u / (1.0 - u)) / (1.0 + least(size, 1000) / 1000.0::DOUBLE) AS q FROM drawn),
ranked AS (SELECT *, q / (1.0 + q) AS z FROM odds),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM ranked GROUP BY source),
limits AS (SELECT *, 3.0::DOUBLE * source_size AS most, 3.0::DOUBLE * source_size / weight AS fill FROM sums),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY fill, source NULLS LAST) AS pos
  FROM limits),
common AS (SELECT arg_min(level, pos) AS level FROM levels WHERE level <= fill),
targets AS (
  SELECT source, source_size, least(most, common.level * weight) AS target FROM levels, common),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
taken AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, t.whole,
         t.target - t.whole * t.source_size AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.z, r.doc_id, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - r.size AS ahead
  FROM ranked r JOIN rests t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN size > 0 AND ahead + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM taken"""

"""Benchmark decontamination by winnowed fingerprints. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, KEY, PLAIN_WORD_ANY_CASE, TWIN, ascii_lower, keyed, let, words_of

#: Words of one fingerprinted gram. A span of ``window`` words holds window - GRAM + 1 grams,
#: and the least of them is kept, so two equal spans keep an equal fingerprint.
GRAM = 5
#: The benchmark's side of a join is broadcast up to so many rows (about 100 bytes each); beyond, Spark shuffles both.
BROADCAST_ROWS = 200_000


def _grams(words: Column, size: int) -> Column:
    """A hash for each run of ``size`` words; none if there are fewer words."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + (j - 1)) for j in range(size)]))


def winnow(hashes: Column, width: int) -> Column:
    """The least hash of every ``width`` neighbours, each kept once; of fewer, the least."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(hashes, i, width))))


def _prints(words: Column, width: int) -> Column:
    return let(words, lambda w: let(_grams(w, GRAM), lambda hashes: winnow(hashes, width)))


def _anchors(words: Column, width: int) -> Column:
    """(print, at) for the least gram of every ``width`` neighbours, the first of equal ones; places from 0."""

    def placed(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(1)))
        first = lambda near, i: F.array_position(near, F.array_min(near)).cast("int") + i - 2
        # Places are made distinct, not pairs: Spark compares each of an array's structs with all others.
        places = F.array_distinct(F.transform(starts, lambda i: first(F.slice(hashes, i, width), i)))
        return F.transform(places, lambda at: F.struct(F.get(hashes, at).alias("print"), at.alias("at")))

    return let(words, lambda w: let(_grams(w, GRAM), placed))


def _loosely_lower(text: Column) -> Column:
    """Equal for texts that are equal after lower-casing A-Z, and quick; it may also join others.

    Capital sigma is the one letter whose lower case depends on what follows.
    """
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def _runs(words: Column, size: Column | int, anchors: Column | None = None) -> Column:
    """(at, run) for each run of ``size`` words, from 0; with ``anchors`` only those around a gram that begins there."""
    last = F.size(words) - size
    if anchors is None:
        every = F.sequence(F.lit(0), last)
    else:
        around = lambda a: F.sequence(F.greatest(a + GRAM - size, F.lit(0)), F.least(a, last))
        every = F.array_distinct(F.flatten(F.transform(anchors, around)))
    starts = F.when(last >= 0, every).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.concat_ws(" ", F.slice(words, i + 1, size)).alias("run")))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, twin, n_words, n_hit, items) for every document; ``twin`` is a hash of its text.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. An item's
    windows are its runs of ``window`` words, or the whole item if it has fewer. A document's
    word is hit if it lies within any occurrence of a window; ``items`` are the ids, as
    sorted strings, of the items with occurring windows.

    Fingerprints of both sides meet first, a document's with their places. Documents without a
    common one cannot share a window and are done. In the others each common fingerprint is
    extended to the windows around it, which are compared by their words: two equal windows have
    the same least gram, and it is kept in both. Items of fewer words than ``window`` have no
    winnowing guarantee: all runs of their length are looked up in all documents.

    A null or empty text has no words; an item without words, or without an id, has no windows.
    Rows with equal id and text have equal results. A null document id is carried through.
    Only the named columns of either table are read. Without documents the result is empty;
    without items no word is hit.
    """
    width = window - GRAM + 1
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(ascii_lower(F.coalesce(item_text_col, F.lit("")))).alias("w"))
    items = items.where(F.col("item").isNotNull() & (F.size("w") > 0))
    item_runs = items.select("item", F.least(F.size("w"), F.lit(window)).alias("len"), "w")
    item_runs = item_runs.select("item", "len", F.explode(let(F.col("w"), lambda w: _runs(w, F.col("len")))["run"]).alias("run")).distinct()
    counts = {r["len"]: r["n"] for r in item_runs.groupBy("len").agg(F.count("*").alias("n")).collect()}  # one row for each length up to window

    rows = keyed(docs, id_col, text_col)
    loose = words_of(_loosely_lower(F.col(BODY)))
    long_items = items.where(F.size("w") >= window).select(_loosely_lower(F.concat_ws(" ", "w")).alias("t"))
    prints = long_items.select(F.explode(_prints(words_of(F.col("t")), width)).alias("print")).distinct()
    ours = rows.select(KEY, TWIN, F.explode(_anchors(loose, width)).alias("anchor")).select(KEY, TWIN, "anchor.*")
    n_prints = counts.get(window, 0) * 2  # an item has fewer fingerprints than windows + 1, and a window at least
    met = ours.join(_small(prints, n_prints), "print")
    suspects = met.groupBy(KEY, TWIN).agg(F.collect_set("at").alias("anchors"))  # fewer than the text has words

    def hits(texts: DataFrame, length: int, anchors: Column | None = None) -> DataFrame:
        """Occurrences of item windows of ``length`` words."""
        found = let(words_of(ascii_lower(F.col(BODY))), lambda w: _runs(w, length, anchors))
        runs = texts.select(KEY, TWIN, F.explode(found).alias("pair")).select(KEY, TWIN, "pair.*")
        wanted = item_runs.where(F.col("len") == length).select("item", "run")
        return runs.join(_small(wanted, counts.get(length, 0)), "run").select(KEY, TWIN, "at", F.lit(length).alias("len"), "item")

    s, r = suspects.alias("s"), rows.alias("r")
    suspected = r.join(s, F.expr(f"r.{KEY} <=> s.{KEY} AND r.{TWIN} = s.{TWIN}")).select(f"r.{KEY}", f"r.{TWIN}", BODY, "anchors")
    found = hits(suspected, window, F.col("anchors"))
    for length in sorted(set(counts) - {window}):
        found = found.unionByName(hits(rows, length))

    spans = found.groupBy(KEY, TWIN, "at").agg(F.max("len").alias("len"))
    ahead = Window.partitionBy(KEY, TWIN).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("len")
    fresh = F.greatest(end - F.greatest("at", F.coalesce(F.max(end).over(ahead), F.lit(0))), F.lit(0))
    covered = spans.withColumn("fresh", fresh).groupBy(KEY, TWIN).agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = found.select(KEY, TWIN, "item").distinct().groupBy(KEY, TWIN).agg(F.sort_array(F.collect_list("item")).alias("items"))
    same = f"a.{KEY} <=> b.{KEY} AND a.{TWIN} = b.{TWIN}"
    both = covered.alias("a").join(named.alias("b"), F.expr(same)).select(f"a.{KEY}", f"a.{TWIN}", "n_hit", "items")
    counted = rows.select(KEY, TWIN, F.regexp_count(BODY, F.lit(PLAIN_WORD_ANY_CASE)).cast("long").alias("n_words"))
    joined = counted.alias("a").join(both.alias("b"), F.expr(same), "left")
    return joined.select(
        F.col(f"a.{KEY}").alias("doc_id"),
        F.col(f"a.{TWIN}").alias("twin"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


#: The query's rows in DuckDB.
SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN iw ON dw.run = iw.run AND dw.n = iw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)"""

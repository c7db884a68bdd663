"""Spelling variants: words one edit apart, found by walking a trie level by level in joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.session import shared_dir

#: What counts as a run of letters. Fixed value.
RUN = r"[A-Za-zÀ-ÿ]+"
#: One in so many tokens has a letter deleted. Fixed value.
SLIP = 97
#: Closes every word in the trie; no letter.
END = "."


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def slipped(doc_id: Column, run: Column) -> Column:
    """The run, without one of its letters if the checksum of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) for every word of enough letters and occurrences in all texts; combined in the map task."""
    text = ascii_lower(docs[text_col])
    runs = docs.select(docs[id_col].alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    words = runs.where(F.length("run") >= shortest).select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def edge_table(words: DataFrame) -> DataFrame:
    """(node, edges) of a trie of the words, forwards and backwards.

    A node is the letters so far, after ``>`` or ``<`` for the direction. An edge has the
    letter, the only word below it with its count, or null if there are several, and then the
    letters that go on from there. A node has at most as many edges as there are letters, so a
    row is small. Nodes above a single word are left out, as nothing else can be found there;
    so are those above the middle of the shortest word, where no walk begins.
    """
    both = words.select("word", "n", "l", F.explode(F.array(F.concat(F.lit(">"), "word"), F.concat(F.lit("<"), F.reverse("word")))).alias("way"))
    # A walk starts behind half of the shortest word's letters at least.
    fewest = 1 + (words.agg(F.min("l")).first()[0] or 0) // 2
    steps = both.select("word", "n", F.concat("way", F.lit(END)).alias("way"), F.explode(F.sequence(F.lit(fewest), F.length("way"))).alias("k"))
    edges = steps.select(F.expr("substring(way, 1, k)").alias("node"), F.expr("substring(way, k + 1, 1)").alias("letter"), "word", "n")
    edges = edges.groupBy("node", "letter").agg(F.count("*").alias("words"), F.min(F.struct("word", "n")).alias("only"))
    only = F.when(F.col("words") == 1, F.col("only")).alias("only")
    nodes = edges.groupBy("node").agg(F.sum("words").alias("words"), F.collect_list(F.struct("letter", only)).alias("edges")).where("words > 1")
    nodes = _stored(nodes.select("node", "edges"), "nodes")
    # Each edge learns which letters go on below it, so that walks that end there are not begun.
    onward = nodes.select(F.col("node").alias("child"), F.array_join("edges.letter", "").alias("onward"))
    parted = nodes.select("node", F.inline("edges"))
    parted = parted.withColumn("child", F.when(F.col("only").isNull(), F.concat("node", "letter")))
    joined = parted.join(onward, "child", "left").select("node", F.struct("letter", "only", "onward").alias("edge"))
    return _stored(joined.groupBy("node").agg(F.collect_list("edge").alias("edges")), "edges")


#: What a state (word, position, node, edits) leads to: for each edge that fits, either the
#: only word below it, if that ends alike, or a state one level down. ``rest`` are the letters
#: of the word from its position on, ``tail`` those that must follow the edge.
_FOUND = "e.only IS NOT NULL AND substring(IF(back, reverse(e.only.word), e.only.word) || '.', depth + 2) = {tail}"
_GOES_ON = "e.only IS NULL AND instr(e.onward, substring({tail}, 1, 1)) > 0"


def _led(fits: str, tail: str) -> str:
    """SQL: structs (v, letter, tail) for the edges ``e`` that fit and are not at an end already."""
    on = f"({_FOUND.format(tail=tail)}) OR ({_GOES_ON.format(tail=tail)})"
    made = f"struct(e.only.word AS v, e.only.n AS v_n, e.letter AS letter, {tail} AS tail)"
    return f"transform(filter(edges, e -> ({fits}) AND ({on})), e -> {made})"


#: From a state without an edit: a letter put in, but not before its like, as that is the same word as
#: after it; or another letter in place of the next one, the greater, as the lesser finds the same pair.
#: A letter taken out is a letter put in, seen from the other word.
_PUT_IN = _led("e.letter <> '.' AND e.letter <> substring(rest, 1, 1)", "rest")
_REPLACED = _led("rest <> '.' AND e.letter > substring(rest, 1, 1)", "substring(rest, 2)")
#: From a state with an edit: the next letter as it is.
_SAME = _led("e.letter = substring(rest, 1, 1)", "substring(rest, 2)")


def _walked(states: DataFrame, edges: DataFrame, led: str) -> DataFrame:
    """One level: states (word, n, node, rest) joined to the edges of their node."""
    here = states.join(edges, "node").withColumns({"depth": F.length("node") - 1, "back": F.col("node").startswith("<")})
    out = here.select("word", "n", "node", F.explode(F.expr(led)).alias("to"))
    return out.select("word", "n", F.concat("node", "to.letter").alias("node"), F.col("to.tail").alias("rest"), "to.v", "to.v_n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) for all pairs of ``words`` (word, n) that are one edit apart, in both orders.

    An edit lies in the second half of the word, then the first half leads into the trie of
    the words forwards, or in its first half, then the second half leads into the trie of the
    words backwards. So a walk begins in the middle, below which nodes have few words. States
    without an edit lie on the word's own path; all enter at once. Those with one edit go on
    one letter, and one join, at a time, until the only word below an edge ends alike. Rounds
    are as many as letters that two words share behind an edit; each is stored.
    """
    spark = words.sparkSession
    words = words.select("word", "n", F.length("word").alias("l"))
    edges = edge_table(words)
    half = "CAST(l / 2 AS INT)"
    onward = words.select("word", "n", F.concat(F.lit(">"), "word", F.lit(END)).alias("way"), F.expr(f"explode(sequence({half}, l))").alias("k"))
    back = words.select("word", "n", F.concat(F.lit("<"), F.reverse("word"), F.lit(END)).alias("way"), F.expr(f"explode(sequence(l - {half}, l))").alias("k"))
    states = onward.unionByName(back).select("word", "n", F.expr("substring(way, 1, k + 1)").alias("node"), F.expr("substring(way, k + 2)").alias("rest"))
    led = f"concat({_PUT_IN}, {_REPLACED})"
    found, seen = [], spark.createDataFrame([], "word string, n long, v string, v_n long")
    while True:
        level = _stored(_walked(states, edges, led), "level")
        found.append(level.where("v IS NOT NULL").select("word", "n", "v", "v_n"))
        states, led = level.where("v IS NULL").select("word", "n", "node", "rest"), _SAME
        if states.isEmpty():
            break
    for part in found:
        seen = seen.unionByName(part)
    other = seen.select(F.col("v").alias("word"), F.col("v_n").alias("n"), F.col("word").alias("v"), F.col("n").alias("v_n"))
    return seen.unionByName(other).distinct().select("word", "n", F.col("v").alias("other"), F.col("v_n").alias("other_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: where its chain of forms ends.

    Every step of a chain doubles the count at least, and every round doubles the length of
    the chains it has followed, so there are few rounds.
    """
    now = _stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("w"), F.col("root").alias("r"))
        moved = now.join(further, F.col("root") == F.col("w"), "left")
        moved = _stored(moved.select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def group_spellings(
    docs: DataFrame, shortest: int = 5, least: int = 3, ratio: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word: its commoner spelling, if it has one.

    Words are runs of letters of all texts, A-Z lower-cased, one token in 97 without one of
    its letters; those of at least ``shortest`` letters and ``least`` occurrences n. Two are
    near if one letter put in, taken out or replaced makes one the other. ``form`` is the near
    word of the largest n (of equal ones the first by code points) if that is at least
    ``ratio`` times the word's, ``root`` where the chain of forms ends, the word itself
    without one; ``n_near`` counts the near words.

    Texts that are null or empty, or have no letters, have no words; a null id is written as
    an empty one. Repeated rows count again. An empty table gives an empty table. Long texts
    and words take no more than themselves; rounds grow with the longest stretch that two
    words share behind an edit. A common word is combined in the map task, and a node's
    edges are one row, so no common start or end of words gathers them in one task but what
    adaptive execution splits. Other columns are not read.
    """
    if ratio < 2 or shortest < 1 or least < 1:
        raise ValueError("a form must be at least twice as common, or chains of forms need not end")
    words = _stored(word_counts(docs, shortest, least, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    near = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    forms = words.join(near, "word", "left")
    commoner = -F.col("best.less") >= ratio * F.col("n")
    forms = forms.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(commoner, F.col("best.other")).alias("form"),
        F.when(commoner, -F.col("best.less")).alias("form_n"),
    )
    forms = _stored(forms, "forms")
    roots = _roots(forms.where("form IS NOT NULL"))
    out = forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


#: DuckDB SQL for the query's rows: the checksum bit by bit over a table made by its rule, near
#: words by the letters that are left when one is taken out of both or of the longer.
SQL = f"""
    WITH RECURSIVE bits AS (
        SELECT list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c, b
        FROM (SELECT unnest(range(256)) AS b)),
    sums AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits),
    runs AS (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '{RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
        FROM documents),
    tokens AS (SELECT w, coalesce(doc_id::VARCHAR, '') || ':' || w AS k, count(*) AS times FROM runs GROUP BY ALL),
    bytes AS (
        SELECT w, times, [('0x' || substr(hex(encode(k)), 2 * i - 1, 2))::BIGINT FOR i IN range(1, 1 + octet_length(encode(k)))] AS b FROM tokens),
    summed AS (
        SELECT w, times, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) AS h
        FROM bytes, sums),
    slipped AS (
        SELECT times, CASE WHEN h % {SLIP} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM summed),
    words AS MATERIALIZED (
        SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
    gaps AS MATERIALIZED (
        SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(k)),
    met AS (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT g.word, g.n, w.word, w.n FROM gaps g JOIN words w ON w.word = g.rest
        UNION SELECT w.word, w.n, g.word, g.n FROM gaps g JOIN words w ON w.word = g.rest),
    near AS (
        SELECT word, n, count(*) AS n_near, max(other_n) AS most, min(other) FILTER (other_n = top) AS best
        FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top FROM met) GROUP BY word, n),
    forms AS MATERIALIZED (SELECT word, best AS form, most AS form_n FROM near WHERE most >= 2 * n),
    chains AS (
        SELECT word, form AS root FROM forms UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root),
    ends AS (SELECT word, root FROM chains WHERE root NOT IN (SELECT word FROM forms))
    SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(x.n_near, 0) AS n_near, f.form_n
    FROM words w LEFT JOIN near x USING (word) LEFT JOIN forms f USING (word) LEFT JOIN ends e USING (word)
"""

"""Quality rules whose cutoffs come with a bound on false rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, cut
from tidemark.llm.spans import BYTE_VALUE, Sums, Texts, Words, binary, covered, grouped, in_pieces, mixed

REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")
#: Measures that are bad when large. Each is a share; bins of a cutoff are 1 / BINS wide.
RULES = {
    "symbols": "least(n_symbols / greatest(n_words, 1), 2.0D) / 2",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(word_chars, 1)",
    "word_length": "least(word_chars / greatest(n_words, 1), 40.0D) / 40",
}
BINS = 200
#: Share of good documents that the rules together may reject in a stratum, and the chance that any stratum exceeds it.
RISK, CHANCE = 0.05, 0.05
#: A good document rejected weighs as much as so many bad ones kept, in shares of each.
REGRET = 50.0
#: Cutoffs are broadcast up to so many strata (some 100 bytes each).
BROADCAST_STRATA = 100_000


def measures(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of each text."""
    data, offsets = texts.bytes, texts.offsets
    words = Words(texts)
    count = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])
    per_text = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[words.bounds])

    letters = (data & 0xC0) != 0x80  # the first byte of each code point
    chars = np.concatenate(([0], np.cumsum(letters)))
    width = chars[words.end] - chars[words.start]
    symbol = np.isin(np.arange(256), list(SYMBOLS))[data]
    capital = (data >= 0x41) & (data <= 0x5A)
    mark = (data > 0x20) & (data < 0x7F) & ~(((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)) & ~((data >= 0x30) & (data <= 0x39))

    breaks = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(data == 0x0A) + 1)))
    breaks = breaks[breaks < len(data)]
    ends = np.append(breaks[1:], len(data))
    ends = ends - ((ends > breaks) & (data[np.maximum(ends - 1, 0)] == 0x0A)) if len(breaks) else ends
    worded = np.searchsorted(words.start, ends) > np.searchsorted(words.start, breaks)
    breaks, ends = breaks[worded], ends[worded]
    line_text = np.searchsorted(offsets, breaks, "right") - 1
    line = mixed(Sums(BYTE_VALUE[data]).between(breaks, ends) + line_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order, first = grouped(line)
    again = np.ones(len(order), bool)
    again[first] = False
    lines = np.bincount(line_text, minlength=len(texts))
    dup_lines = np.bincount(line_text[order[again]], minlength=len(texts))

    start, runs = words.runs(REPEAT_WINDOW)
    order, first = grouped(mixed(runs + words.text[start].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))
    times = np.diff(np.append(first, len(order)))
    twice = start[order[np.repeat(times > 1, times)]]
    return {
        "n_words": np.diff(words.bounds),
        "word_chars": per_text(width),
        "n_symbols": count(symbol),
        "n_dup_lines": dup_lines,
        "n_repeat_words": per_text(covered(len(words), twice, REPEAT_WINDOW)),
        "n_lines": lines,
        "n_capitals": count(capital),
        "n_marks": count(mark),
    }


def measured(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """(doc_id, stratum, and the counts) for every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in in_pieces(binary(batch.column(BODY))):
                found = measures(texts)
                columns = [batch.column(name).slice(row, len(texts)) for name in ("doc_id", "stratum")]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(found[c], pa.int64()) for c in COUNTS]], ["doc_id", "stratum", *COUNTS])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[stratum_col].cast("string").alias("stratum"), F.coalesce(docs[text_col], F.lit("")).alias(BODY))
    return rows.mapInArrow(count, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))


def at_most(n: int, risk: float, upto: int) -> np.ndarray:
    """For k = 0 .. upto: the chance of k or fewer among n, each with probability ``risk``."""
    k = np.arange(1, upto + 1)
    logs = np.concatenate(([0.0], np.cumsum(np.log((n - k + 1) / k)))) + np.arange(upto + 1) * np.log(risk) + (n - np.arange(upto + 1)) * np.log1p(-risk)
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def certified(good: np.ndarray, bad: np.ndarray, risk: float, chance: float) -> int | None:
    """The bin from which on a rule rejects, of those that hold the risk; None if it rejects nothing.

    Cutoffs are tested from the loosest on, each for the hypothesis that it rejects more than
    ``risk`` of good documents; an exact binomial test at level ``chance`` ends the sequence
    where it first fails. Since the sequence is fixed in advance, one level serves all its
    tests. Of the cutoffs passed, the one counts that rejects the most bad documents, less
    the good ones it costs.
    """
    n = int(good.sum())
    if n == 0 or bad.sum() == 0:
        return None
    lost = np.cumsum(good[::-1])  # from the loosest cutoff, which rejects the last bin alone
    limit = min(n, int(n * risk) + 1)
    tail = at_most(n, risk, limit)
    passed = (lost <= limit) & (tail[np.minimum(lost, limit)] <= chance)
    stop = len(passed) if passed.all() else int(np.argmin(passed))
    if stop == 0:
        return None
    gain = np.cumsum(bad[::-1])[:stop] / bad.sum() - REGRET * lost[:stop] / n
    best = int(np.argmax(gain))
    return len(good) - 1 - best if gain[best] > 0 else None


def cutoffs(measured_docs: DataFrame, labels: DataFrame, risk: float, chance: float, id_col: str, label_col: str) -> DataFrame:
    """(of, cut): for each stratum, a bin for each rule, or null where none is certified.

    A labelled id is one draw of a stratum, however many rows it has there: for each rule its
    worst row counts.
    Both the rules and the strata share the allowance: a rule may reject risk / rules, and a
    test errs with chance / (rules * strata).
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("k")).agg(F.max(label_col).alias("good"))
    joined = measured_docs.join(known, F.col("doc_id") == F.col("k"))
    worst = [F.max(_bin(F.expr(value))).alias(f"bin_{i}") for i, value in enumerate(RULES.values())]
    drawn = joined.groupBy("doc_id", "stratum").agg(F.max("good").alias("good"), *worst)
    bins = F.array(*[F.struct(F.lit(i).alias("rule"), F.col(f"bin_{i}").alias("bin")) for i in range(len(RULES))])
    counted = drawn.select("stratum", "good", F.explode(bins).alias("r")).groupBy("stratum", "r.rule", "r.bin")
    counted = cut(counted.agg(F.sum("good").cast("long").alias("good"), F.sum(1 - F.col("good")).cast("long").alias("bad")))
    strata = counted.select("stratum").distinct().count()
    n_rules = len(RULES)
    each_risk, each_chance = risk / n_rules, chance / (n_rules * max(1, strata))

    def certify(table: pa.Table) -> pa.Table:
        rule, place = table.column("rule").to_numpy(), table.column("bin").to_numpy()
        found = []
        for i in range(n_rules):
            good, bad = np.zeros(BINS + 1, np.int64), np.zeros(BINS + 1, np.int64)
            good[place[rule == i]] = table.column("good").to_numpy()[rule == i]
            bad[place[rule == i]] = table.column("bad").to_numpy()[rule == i]
            found.append(certified(good, bad, each_risk, each_chance))
        return pa.table({"of": pa.array([table.column("stratum")[0].as_py()], pa.string()), "cut": pa.array([found], pa.list_(pa.int32()))})

    made = counted.groupBy("stratum").applyInArrow(certify, "of string, cut array<int>")
    return F.broadcast(made) if strata <= BROADCAST_STRATA else made


def _bin(value: Column) -> Column:
    return F.floor(F.least(value, F.lit(1.0)) * BINS).cast("int")


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = RISK,
    chance: float = CHANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
) -> DataFrame:
    """(doc_id, stratum, counts, base_failed, broken, kept) for every row; ``broken`` names the rules it breaks.

    A document fails at once if it has under 10 words, or more than a fifth of them in
    repeated runs of five. Otherwise it is kept unless it breaks a rule whose cutoff is
    certified for its stratum: with probability 1 - ``chance``, in every stratum all rules
    together reject no more than ``risk`` of the documents labelled good. All labelled ids
    count, each once; nothing else was fitted to them. A stratum with too few labels has no cutoffs.

    A null or empty text has no words and fails. Rows without a stratum are one of their own.
    Of several labels of one id the greatest counts. Rows with equal texts have equal counts.
    A null id is carried through and has no label. Only the named columns are read. An empty
    table gives an empty table.
    """
    rows = cut(measured(docs, id_col, text_col, stratum_col))
    made = cutoffs(rows, labels, risk, chance, id_col, label_col)
    joined = rows.join(made, F.expr("stratum <=> of"), "left")
    names = [F.when(_bin(F.expr(value)) >= F.get("cut", i), F.lit(name)) for i, (name, value) in enumerate(RULES.items())]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = F.array_compact(F.array(*names))
    return joined.select("doc_id", "stratum", *COUNTS, failed.alias("base_failed"), broken.alias("broken"), (~failed & (F.size(broken) == 0)).alias("kept"))

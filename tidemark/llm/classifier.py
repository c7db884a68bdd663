"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, KEY, TWIN, keyed
from tidemark.llm.spans import IN_WORD, Sums, Texts, Words, binary, in_pieces, mixed

#: Features are hashed to so many places; the model is two arrays of that length.
BITS = 18
#: At most so many labelled rows are learned from: those with the least hash of their id.
SAMPLE_ROWS = 16_000
#: Learners that see the sample in shares of their own; their weights are averaged.
SHARES = 4
PASSES = 8
#: Bytes of text of which features are made at once; work arrays take some 150 times as much.
PIECE_BYTES = 1 << 18
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    """Of the update: step size and its smoothing, and the weights of both penalties."""

    alpha: float = 2.0
    beta: float = 0.1
    l1: float = 0.02
    l2: float = 0.0


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether an id belongs to the rows that are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def _shapes(words: Words) -> np.ndarray:
    """A hash of each word's form: runs of capitals, small letters, digits, each mark, other."""
    kind = np.zeros(256, np.uint64)
    kind[0x30:0x3A], kind[0x41:0x5B], kind[0x61:0x7B], kind[0x80:] = 1, 2, 3, 3
    for mark in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)):
        kind[mark] = mark
    data = words.texts.bytes
    kinds = kind[data]
    new = np.ones(len(data), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[words.start] = True
    # Only where a run begins does its kind count, at the place of its number within the word.
    runs = np.cumsum(new & IN_WORD[data])
    starts = np.flatnonzero(new & IN_WORD[data])
    sums = Sums(kinds[starts] + np.uint64(7))
    return sums.between(runs[words.start] - 1, runs[words.end - 1])


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, value): the hashed n-grams of each text.

    Single words, pairs of words, and pairs of forms of words ("Thedtiou," is capital,
    small, comma); besides, pairs of a word with itself count as such, so that repetition
    shows whatever the word. A text's values have length 1.
    """
    words = Words(texts)
    form = _shapes(words)
    n = len(words)
    pair = np.flatnonzero(words.text[1:] == words.text[:-1]) if n > 1 else np.zeros(0, np.int64)
    one, odd = np.uint64(1), np.uint64(0x9E3779B97F4A7C15)
    same = (words.hash[pair] == words.hash[pair + 1]).astype(np.uint64)
    kinds = [
        (words.text, mixed(words.hash + one)),
        (words.text[pair], mixed(words.hash[pair] * odd + words.hash[pair + 1])),
        (words.text[pair], mixed((form[pair] ^ odd) * odd + form[pair + 1])),
        (words.text[pair], mixed(same + np.uint64(3))),
    ]
    text = np.concatenate([k[0] for k in kinds])
    place = (np.concatenate([k[1] for k in kinds]) >> np.uint64(64 - BITS)).astype(np.int64)
    joint = text * (1 << BITS) + place
    joint, counts = np.unique(joint, return_counts=True)
    text, place = joint >> BITS, joint & ((1 << BITS) - 1)
    value = np.log1p(counts.astype(float))
    norm = np.sqrt(np.bincount(text, value**2, len(texts)))
    return text, place, value / norm[text]


def _learn(table: pa.Table, settings: Settings, passes: int) -> pa.Table:
    """One learner's weights after its share: for each document, one update of its features."""
    order = np.argsort(table.column("turn").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    goals = table.column("goal").to_numpy()
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for _, texts in in_pieces(binary(table.column(BODY)), PIECE_BYTES):
        text, place, value = features(texts)
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        rows += [(place[a:b], value[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)  # the last is the constant's
    for _ in range(passes):
        for goal, (place, value) in zip(goals, rows):
            at, x = np.append(place, 1 << BITS), np.append(value, 1.0)
            w = weights(z[at], n[at], settings)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - goal) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += g * g
    w = weights(z, n, settings)
    used = np.flatnonzero(w)
    return pa.table({"place": pa.array(used, pa.int32()), "weight": pa.array(w[used], pa.float64())})


def weights(z: np.ndarray, n: np.ndarray, settings: Settings) -> np.ndarray:
    """The closed form of the regularised leader."""
    small = np.abs(z) <= settings.l1
    w = -(z - np.sign(z) * settings.l1) / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2)
    return np.where(small, 0.0, w)


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    sample_rows: int = SAMPLE_ROWS,
    passes: int = PASSES,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> np.ndarray:
    """Weights for all places and, last, the constant.

    Learns from at most ``sample_rows`` labelled ids outside the held-out fold, each with one
    text, however many rows it has: of several texts the one with the least hash. Each of
    four learners takes a share of them through some passes; an average of their weights is
    the model. Its size is fixed, so it may pass the driver.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("k")).agg(F.max(F.col(label_col)).cast("double").alias("goal"))
    known = known.withColumn("turn", F.xxhash64("k", F.lit("turn"))).orderBy("turn").limit(sample_rows)
    rows = keyed(docs, id_col, text_col)
    # The sample's size is bounded by its parameter, so the documents need no shuffle.
    taught = rows.join(F.broadcast(known), F.col(KEY) == F.col("k"))
    # Combined in the map tasks, so that an id of many rows never meets in one share.
    taught = taught.groupBy("k", "goal", "turn").agg(F.min(F.struct(TWIN, BODY))[BODY].alias(BODY)).select(BODY, "goal", "turn")
    taught = taught.withColumn("share", F.pmod(F.col("turn"), F.lit(SHARES)).cast("int"))
    shares = taught.groupBy("share").applyInArrow(lambda t: _learn(t, settings, passes), "place int, weight double")
    model = np.zeros((1 << BITS) + 1)
    for row in shares.groupBy("place").agg((F.sum("weight") / SHARES).alias("weight")).toLocalIterator():
        model[row.place] = row.weight
    return model


def score(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score) for every row, and further columns as they are: sparse dot products with the model."""
    sent = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    body = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), body.alias(BODY), *more)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = sent.value.astype(float)
        for batch in batches:
            scores = []
            for _, texts in in_pieces(binary(batch.column(BODY)), PIECE_BYTES):
                text, place, value = features(texts)
                total = np.bincount(text, weight[place] * value, len(texts)) + weight[-1]
                scores.append(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))
            rest = [(name, batch.column(name)) for name in batch.schema.names if name != BODY]
            rest.append(("score", pa.array(np.concatenate(scores) if scores else np.zeros(0))))
            yield pa.RecordBatch.from_arrays([column for _, column in rest], [name for name, _ in rest])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != BODY)
    return rows.mapInArrow(rate, f"{kinds}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **names) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    A null or empty text has no features; the constant alone scores it. A null id belongs to
    no fold and is scored like any other. Of several labels of one id the greatest counts;
    null labels teach nothing, and without any label every score is 0.5. Of several texts of a
    labelled id the one with the least hash is learned, once. Rows with equal texts have equal
    scores. Only the named columns of either table are read.
    """
    scored = score(docs, train(docs, labels, **names))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

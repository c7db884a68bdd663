"""Codes of vectors: the nearest entry of a small codebook for each part, found by intersecting bit masks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Steps for each unit of a component.
SCALE = 256
#: Components beyond this many steps count as this many, so that squared distances fit 64 bits.
FARTHEST = 1 << 27
#: A mask has one bit for each entry.
MOST_ENTRIES = 64
#: A label with more than this share of the rows gets its sum by a broadcast, as there are few of those.
HOT_SHARE = 1000


def in_steps(batch_column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch as rows of whole steps, rounded down."""
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    steps = np.floor(np.clip(flat * SCALE, -FARTHEST, FARTHEST))
    return steps.astype(np.int64).reshape(-1, dims)


class Slices:
    """One part's codebook, made to find the nearest entry of many parts at once.

    For each dimension the entries' coordinates are sorted, and each place in that order has
    the mask of the entries before it. The entries within a radius are a range in every
    dimension, so a range's mask is what two prefix masks differ in, and the masks of all
    dimensions ANDed leave the entries of a box around the part. The radius is the distance to
    some entry, so no entry outside the box is as near as that one: the candidates are exact.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.left_shift(np.uint64(1), self.order.astype(np.uint64))
        none = np.zeros((1, entries.shape[1]), np.uint64)
        self.before = np.concatenate((none, np.bitwise_or.accumulate(bits, axis=0)))

    def _distance(self, parts: np.ndarray, entry: np.ndarray | int) -> np.ndarray:
        return ((parts - self.entries[entry]) ** 2).sum(axis=1)

    def radius(self, parts: np.ndarray) -> np.ndarray:
        """The distance, rounded up, to the nearest of the entries that lie next to the part in some dimension."""
        least = np.full(len(parts), np.iinfo(np.int64).max)
        for d in range(parts.shape[1]):
            at = np.searchsorted(self.sorted[:, d], parts[:, d])
            beside = self.order[np.minimum(at, len(self.entries) - 1), d]
            np.minimum(least, self._distance(parts, beside), out=least)
        return np.ceil(np.sqrt(least.astype(np.float64))).astype(np.int64) + 1

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each part the mask of the entries that are within the radius in every dimension."""
        mask = np.full(len(parts), np.iinfo(np.uint64).max)
        for d in range(parts.shape[1]):
            first = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            end = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            mask &= self.before[end, d] & ~self.before[first, d]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry, of equally near ones the first."""
        if not self.entries.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        mask = self.candidates(parts, self.radius(parts))
        index, least = np.zeros(len(parts), np.int64), np.full(len(parts), np.iinfo(np.int64).max)
        for entry in range(len(self.entries)):
            rows = np.flatnonzero(mask >> np.uint64(entry) & np.uint64(1))
            distance = self._distance(parts[rows], entry)
            nearer = distance < least[rows]
            index[rows[nearer]], least[rows[nearer]] = entry, distance[nearer]
        return index, least


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, place]`` in steps."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        return sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for each vector and part."""
        parts, _, width = self.entries.shape
        found = [Slices(self.entries[p]).nearest(vectors[:, p * width : (p + 1) * width]) for p in range(parts)]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def usable(rows: DataFrame, parts: int, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(vec_id, label, vector) of the rows whose vector can be coded, and the vectors' length.

    That is the length of the least id's vector (the shortest, should it have several).
    Vectors of other lengths, or with null or non-finite components, are not usable.
    """
    vector = rows[vec_col].cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    long_enough = (F.size(vector) >= parts) & (F.size(vector) % parts == 0)
    kept = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[label_col].alias("label"), vector.alias("vector"))
    kept = kept.where(vector.isNotNull() & long_enough & sound)
    first = kept.agg(F.min(F.struct(F.col("vec_id").isNull(), "vec_id", F.size("vector").alias("n")))["n"]).first()[0]
    return kept.where(F.size("vector") == (first or 0)), first or 0


def first_codebooks(kept: DataFrame, dims: int, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the least ids, ascending. Of one id's several vectors the least counts."""
    ids = kept.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries)
    chosen = [r[0] for r in ids.collect()]  # at most ``entries``
    least = kept.where(F.col("vec_id").isin(chosen)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    vectors = [r.vector for r in least.orderBy("vec_id").collect()]
    steps = in_steps(pa.array(vectors, pa.list_(pa.float64())), dims)
    return Codebooks(np.ascontiguousarray(steps.reshape(-1, parts, dims // parts).transpose(1, 0, 2)))


def _moved(kept: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the mean, rounded down, of the parts it is nearest to.

    A task sends one sum for each cell of the codebooks, however many rows it has, and the
    driver gets one for each cell.
    """
    parts, size, width = books.entries.shape
    cells = size * parts * (width + 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            vectors = in_steps(batch.column("vector"), parts * width)
            entry, _ = books.assign(vectors)
            for p in range(parts):
                mine = vectors[:, p * width : (p + 1) * width]
                np.add.at(total[p], entry[:, p], np.concatenate((mine, np.ones((len(mine), 1), np.int64)), axis=1))
        if total[:, :, -1].any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells), pa.int32()), pa.array(total.ravel())], ["cell", "total"])

    found = kept.select("vector").mapInArrow(sums, "cell int, total long").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.zeros(cells, np.int64)
    for cell, value in found.collect():
        total[cell] = value
    total = total.reshape(parts, size, width + 1)
    n = total[:, :, -1:]
    return Codebooks(np.where(n > 0, total[:, :, :-1] // np.maximum(n, 1), books.entries))


def fit(kept: DataFrame, dims: int, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    """Codebooks after ``rounds`` passes over all rows; None if no row has an id."""
    if not 1 <= entries <= MOST_ENTRIES:
        raise ValueError(f"a codebook has 1 to {MOST_ENTRIES} entries")
    if not dims:
        return None
    books = first_codebooks(kept, dims, parts, entries)
    if not books.entries.size:
        return None
    for _ in range(rounds):
        books = _moved(kept, books)
    return books


def encode_vectors(
    rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) for every usable row.

    A component x becomes floor(256 x). Vectors are cut into ``parts`` equal parts, each coded
    by the index of its codebook's nearest entry, two hex digits each. ``error`` is the sum of
    squared distances, ``label_error`` its sum over all rows of the label.

    Rows are left out whose vector is null, has null or non-finite components, a length that
    ``parts`` does not divide, or another length than the least id's vector. Components beyond
    2 ** 27 steps count as that. A null id is coded but never starts an entry; with fewer ids
    than entries the codebooks are smaller; without any id the result is empty, as that of an
    empty table is. Of one id's several vectors the least starts its entry. Null labels go
    together. Repeated rows each count. Other columns are not read.

    The codebooks (parts x entries, at most 64 each) go to every task; the sums of a round, as
    many, come back. A sum over a label that passes 64 bits is null. Labels with over a
    thousandth of the rows, at most a thousand, are looked up by a broadcast; the rest are
    joined, so no task gets all rows of a common label.
    """
    spark = rows.sparkSession
    kept, dims = usable(rows, parts, id_col, vec_col, label_col)
    label_type = dict(kept.dtypes)["label"]
    books = fit(kept, dims, parts, entries, rounds)
    if books is None:
        empty = f"vec_id long, label {label_type}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], empty)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, distance = books.assign(in_steps(batch.column("vector"), dims))
            digits = [row.tobytes().hex() for row in entry.astype(np.uint8)]
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(digits, pa.string()), pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    path = shared_dir(spark, "codes")
    kept.mapInArrow(code, f"vec_id long, label {label_type}, code string, error long").write.parquet(path)
    coded = spark.read.parquet(path)
    sums = coded.groupBy("label").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error"))
    most = coded.count() // HOT_SHARE
    hot = F.broadcast(sums.where(F.col("n") > most).select(F.col("label").alias("l"), "label_error", F.lit(True).alias("hot")))
    looked_up = coded.join(hot, F.expr("label <=> l"), "left").drop("l")
    rest = looked_up.where("hot IS NULL").drop("label_error")
    cold = sums.where(F.col("n") <= most).select(F.col("label").alias("l"), "label_error")
    rest = rest.join(cold, F.expr("label <=> l"))
    columns = ("vec_id", "label", "code", "error", "label_error")
    out = looked_up.where("hot").select(*columns).unionByName(rest.select(*columns))
    return out.withColumn("codebooks_sha256", F.lit(books.digest))


def _rounds_sql(rounds: int, entries: int) -> str:
    """Codebooks c0 to c<rounds>, each from the assignment a<i> of all parts to the one before."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        d{i} AS (SELECT x.r, x.p, c.e, list_sum([(a - c.x[i]) * (a - c.x[i]) FOR a, i IN x.x])::BIGINT AS d
                 FROM parts x JOIN c{i} c USING (p)),
        a{i} AS (SELECT r, p, min(d) AS d, min(d * {entries} + e) % {entries} AS e FROM d{i} GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
        s{i} AS (SELECT p, e, k, sum(x.x[k])::BIGINT AS s, count(*) AS n
                 FROM a{i} JOIN parts x USING (r, p), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS k)
                 GROUP BY p, e, k),
        m{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM s{i} GROUP BY p, e),
        c{i + 1} AS (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (p, e))""")
    return ",".join(steps)


def sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """DuckDB SQL for the query's rows, by comparing every part with every entry."""
    return f"""
        WITH sound AS (
            SELECT vec_id, label, row_number() OVER () AS r, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        parts AS (
            SELECT r, vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
            FROM sound, (SELECT unnest(range({parts})) AS p)),
        c0 AS (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
            QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries}),
        {_rounds_sql(rounds, entries)},
        coded AS (
            SELECT r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
            FROM a{rounds} GROUP BY r),
        digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN sound USING (r), digest"""

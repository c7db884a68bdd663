"""Near duplicates of weighted shingles by ProbMinHash, banding and verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, KEY, TWIN, keyed
from tidemark.llm.components import components
from tidemark.llm.spans import SECOND_BASE, Sums, Words, binary, grouped, in_pieces, mixed
from tidemark.session import shared_dir

SHINGLE = 5
#: 20 bands of 4 registers: a pair of similarity 0.8 meets in some band but for 3 cases in 100,000.
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
#: Turns in which the classes of a band are compared with its leader, before pairs of members.
LEADER_TURNS = 2
#: Pairs that leaders leave open are verified if finer registers, which only texts still apart get,
#: agree to 5 deviations below the threshold: first one bit of each, then 8. At 0.8 each loses 2
#: pairs in a million, so bands and margins together lose 3 in 100,000.
FINE, MARGIN = 1024, 5.0
#: Bytes of text that are sketched at once; work arrays take a hundred times as much.
PIECE_BYTES = 1 << 19
#: The same for finer registers, whose arrivals take some 200 bytes for a byte of short texts.
FINE_BYTES = 1 << 17
#: Pairs of texts that are compared at once.
PAIRS = 1000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight): how often each text has each run of ``size`` words, or all its words if fewer."""
    first, hashes = words.runs(size)
    text = words.text[first]
    counts = np.diff(words.bounds)
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = Sums(words.hash).between(words.bounds[short], words.bounds[short + 1])
    text, hashes = np.concatenate((text, short)), np.concatenate((hashes, whole))
    order, first = grouped(mixed(hashes + text.astype(np.uint64) * _STEP))
    weight = np.diff(np.append(first, len(order)))
    at = order[first]
    return text[at], hashes[at], weight.astype(float)


def signatures(n: int, text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """For each of ``n`` texts the shingle that arrives first at each of ``m`` registers.

    A shingle arrives again and again, after exponential gaps with its weight as the rate, at
    registers drawn evenly. It stops when it arrives later than every register of its text has
    been reached, as no later arrival can matter. Gaps and registers depend on the shingle
    alone. Two texts agree at a register with their probability Jaccard similarity.
    """
    total = np.bincount(text, weight, n)
    filled = total > 0
    # All registers are reached by then but for 3 texts in 10,000, which are done again without it.
    expected = np.full(n, np.inf)
    expected[filled] = m / total[filled] * (np.log(m) + 8)
    out = np.zeros((n, m), np.uint64)
    todo = filled
    for horizon in (expected, np.full(n, np.inf)):
        mine = todo[text]
        out_of, missed = _arrivals(n, text[mine], shingle[mine], weight[mine], m, horizon)
        done = todo & ~missed
        out[done] = out_of[done]
        todo = todo & missed
        if not todo.any():
            break
    return out


def _arrivals(n, text, shingle, weight, m, horizon):
    times = np.repeat(horizon, m)
    at, h, t, rate = text, shingle, np.zeros(len(text)), weight
    logs, latest, turn = [], horizon, 0
    while len(at):
        turn += 1
        draw = mixed(h + np.uint64((turn * int(_STEP)) % (1 << 64)))
        t = t - np.log(((draw >> np.uint64(11)).astype(float) + 1.0) * 2.0**-53) / rate
        on = t < latest[at]
        at, h, t, rate, draw = at[on], h[on], t[on], rate[on], draw[on]
        place = at * m + (mixed(draw ^ _STEP) % np.uint64(m)).astype(np.int64)
        np.minimum.at(times, place, t)
        first = t <= times[place]
        logs.append((place[first], t[first], h[first]))
        if turn <= 4 or turn % 8 == 0:  # now and then is enough: it only tells who may stop
            latest = times.reshape(n, m).max(axis=1)
    out = np.zeros(n * m, np.uint64)
    reached = np.zeros(n * m, bool)
    for place, t, h in logs:
        first = t == times[place]
        out[place[first]] = h[first]
        reached[place[first]] = True
    return out.reshape(n, m), ~reached.reshape(n, m).all(axis=1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, texts in in_pieces(binary(batch.column(BODY)), PIECE_BYTES):
            words = Words(texts)
            n = len(texts)
            lo, hi = words.bounds[:-1], words.bounds[1:]
            prints = np.stack([Sums(words.hash).between(lo, hi), Sums(words.hash, SECOND_BASE).between(lo, hi)], axis=1)
            text, shingle, weight = shingles(words)
            registers = signatures(n, text, shingle, weight)
            sums = np.zeros((n, BANDS), np.uint64)
            for k in range(ROWS):
                sums = mixed(sums * _STEP + registers[:, k : BANDS * ROWS : ROWS])
            sums = mixed(sums + np.arange(BANDS, dtype=np.uint64))
            some = hi > lo
            fixed = lambda values, width, kind: pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(values).ravel().view(kind))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(KEY).slice(row, n),
                    batch.column(TWIN).slice(row, n),
                    pa.array([p.tobytes() if ok else None for p, ok in zip(prints, some)], pa.binary()),
                    fixed(sums, BANDS, np.int64),
                ],
                [KEY, TWIN, "node", "bands"],
            )


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, fine, bits): the finer registers of a text, in 8 bits each and in one.

    Other registers agree in 8 bits once in 256: so no pair is lost, and few more are verified.
    """
    for batch in batches:
        for row, texts in in_pieces(binary(batch.column("body")), FINE_BYTES):
            n = len(texts)
            registers = signatures(n, *shingles(Words(texts)), FINE).astype(np.uint8)
            bits = np.packbits(registers & 1, axis=1).view(np.int64)
            fixed = lambda values, width: pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel())
            )
            columns = [batch.column("node").slice(row, n), fixed(registers.view(np.int8), FINE), fixed(bits, FINE // 64)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "fine", "bits"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two texts, each given as ordered shingles and their weights.

    The sum over common shingles i of 1 / sum over j of max(a_j / a_i, b_j / b_i). The inner
    sum depends on the ratio of weights alone, and there are few ratios.
    """
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])] = a[1]
    y[np.searchsorted(every, b[0])] = b[1]
    common = (x > 0) & (y > 0)
    total = 0.0
    for ratio, share in zip(*_summed(x[common] / y[common], x[common])):
        total += share / np.maximum(x, y * ratio).sum()
    return total


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, values, len(distinct)) if len(distinct) else values


def _weighed(column: pa.Array, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for _, texts in in_pieces(binary(column), PIECE_BYTES):
        text, shingle, weight = shingles(Words(texts), size)
        order = np.lexsort((shingle, text))
        text, shingle, weight = text[order], shingle[order], weight[order]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        out += [(shingle[s:e], weight[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]
    return out


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes that are at least so similar. ``texts``: (node, body)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(row, PAIRS) for whole in batches for row in range(0, len(whole), PAIRS)):
            left, right = _weighed(batch.column("one"), SHINGLE), _weighed(batch.column("other"), SHINGLE)
            keep = pa.array([similarity(x, y) >= threshold for x, y in zip(left, right)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    one = texts.select(F.col("node").alias("a"), F.col("body").alias("one"))
    other = texts.select(F.col("node").alias("b"), F.col("body").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(check, "a binary, b binary")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, twin, class_id, keep, n_class) for every row: classes of texts with similar shingles.

    Texts with the same words in a row are copies and make one node. Two nodes are linked if
    their weighted shingles of five words have a probability Jaccard of ``threshold`` or more;
    a class is a connected component. ``class_id`` is its least id, ``n_class`` its rows.
    ``keep`` marks the row that stands for it; rows alike in id and text share the mark.
    ``twin`` is a hash of the text, which tells rows of one id apart.

    Classes grow in turns. In each, one member of every class in a band is compared with the
    leader of the band's largest class: the text that meets most others over all its bands, so
    of many variants the one in their middle. What then still lies in different classes within
    a band is compared pair by pair on 1,024 finer registers, and verified from five deviations
    below the threshold, which leaves little but pairs that are linked. So no pair is left out because a band is large, and verified pairs do not grow
    with a group's square unless its similarities lie at the threshold. Of pairs at exactly
    0.8, 2.6 in 100,000 meet in no band and 0.4 in 100,000 fall below a margin, if registers are
    independent; more similar pairs are lost less.

    A text of one to four words is one shingle. Texts without words, or null, are each alone
    and kept. A null id is carried through; a class of null ids has a null ``class_id``. Only
    the two named columns are read. An empty table gives an empty table.
    """
    rows = keyed(docs, id_col, text_col)
    sketched = rows.mapInArrow(_sketch, f"{KEY} long, {TWIN} long, node binary, bands array<long>")
    sketched = _stored(sketched, "sketches")
    nodes = sketched.where("node IS NOT NULL").groupBy("node")
    nodes = nodes.agg(
        F.count("*").alias("copies"),
        F.min(F.struct(F.col(KEY).isNull(), KEY, TWIN)).alias("keeper"),
        F.any_value("bands").alias("bands"),
    )
    nodes = _stored(nodes, "nodes")

    met = nodes.select("node", "copies", F.explode("bands").alias("bucket"))
    crowd = met.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    met = met.join(crowd, "bucket")
    central = met.groupBy("node").agg(F.sum("crowd").alias("central"))
    met = _stored(met.drop("crowd").join(central, "node"), "met")

    # A text of each node that may be compared, by the row that stands for the node.
    wanted = nodes.join(met.select("node").distinct(), "node").select("node", F.col(f"keeper.{KEY}").alias("k"), F.col(f"keeper.{TWIN}").alias("t"))
    texts = rows.join(wanted, F.expr(f"{KEY} <=> k AND {TWIN} = t")).select("node", F.col(BODY).alias("body"))
    texts = _stored(texts.dropDuplicates(["node"]), "texts")

    # Not from rows of the driver's Python: for those each executor would start Python workers of another kind.
    roots = nodes.select("node", F.col("node").alias("root")).where("false")
    tested = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    links: list[DataFrame] = []
    for turn in range(LEADER_TURNS + 1):
        pairs = _led(met, roots, tested) if turn < LEADER_TURNS else _open(nodes, met, roots, threshold, texts)
        pairs = _stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        found = _stored(verified(pairs, texts, threshold), "links")
        if not found.isEmpty():
            links.append(found)
            roots = components(reduce(DataFrame.unionByName, links))

    classed = nodes.select("node", "copies", "keeper").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = classed.groupBy("root").agg(F.min("keeper").alias("stands"), F.sum("copies").alias("n_class"))
    classed = classed.select("node", "root").join(whole, "root").select("node", "stands", "n_class")
    out = sketched.select(KEY, TWIN, "node").join(classed, "node", "left")
    alone = F.col("stands").isNull()
    same = F.col(f"stands.{KEY}").eqNullSafe(F.col(KEY)) & (F.col(f"stands.{TWIN}") == F.col(TWIN))
    return out.select(
        F.col(KEY).alias("doc_id"),
        F.col(TWIN).alias("twin"),
        F.when(alone, F.col(KEY)).otherwise(F.col(f"stands.{KEY}")).alias("class_id"),
        (alone | F.coalesce(same, F.lit(False))).alias("keep"),
        F.coalesce("n_class", F.lit(1)).alias("n_class"),
    )


def _classed(met: DataFrame, roots: DataFrame) -> DataFrame:
    return met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _led(met: DataFrame, roots: DataFrame, tested: DataFrame) -> DataFrame:
    """For each class the pair (a, b) of a member and a leader that it meets in most bands, of those not tested yet."""
    best = F.max(F.struct("central", "copies", "node"))
    per_class = _classed(met, roots).groupBy("bucket", "root").agg(best["node"].alias("member"), F.count("*").alias("n"), best["central"].alias("central"))
    main = per_class.groupBy("bucket").agg(F.count("*").alias("classes"), F.max(F.struct("n", "central", "root", "member")).alias("main"))
    met_main = per_class.join(main.where("classes > 1"), "bucket").where(F.col("root") != F.col("main.root"))
    pairs = met_main.groupBy("root", "member", F.col("main.member").alias("leader")).agg(F.count("*").alias("bands"))
    pairs = pairs.select("root", "bands", F.least("leader", "member").alias("a"), F.greatest("leader", "member").alias("b"))
    pairs = pairs.join(tested, ["a", "b"], "left_anti")
    chosen = pairs.groupBy("root").agg(F.max(F.struct("bands", "a", "b")).alias("m"))
    return chosen.select("m.a", "m.b").distinct()


def _open(nodes: DataFrame, met: DataFrame, roots: DataFrame, threshold: float, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of one band and different classes whose finer registers agree often enough.

    In each band, members of its largest class need no comparison among themselves: the
    others are compared with everything there.
    """
    members = _classed(met, roots).select("bucket", "node", "root")
    per_class = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    torn = per_class.groupBy("bucket").agg(F.count("*").alias("classes"), F.max(F.struct("n", "root"))["root"].alias("main")).where("classes > 1")
    torn = _stored(members.join(torn, "bucket"), "torn")
    fine = texts.join(torn.select("node").distinct(), "node").mapInArrow(_fine, "node binary, fine array<tinyint>, bits array<long>")
    fine = _stored(nodes.select("node", "bands").join(fine, "node"), "fine")
    return _alike(torn.join(fine, "node"), threshold)


def _alike(torn: DataFrame, threshold: float) -> DataFrame:
    """Pairs of the rows (bucket, node, root, main, bands, fine, bits) whose registers agree often enough.

    A pair counts in the first band it shares. One bit of each register comes first, as whole
    numbers compare fast; where registers differ, half of their bits agree by chance.
    """
    side = lambda s, *more: [F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "bands", "fine", "bits")] + list(more)
    few = torn.where("root <> main").select("bucket", *side("a"))
    all_ = torn.select("bucket", *side("b", "main"))
    # Two members outside the main class meet twice; once is enough.
    once = (F.col("root_b") == F.col("main")) | (F.col("node_a") < F.col("node_b"))
    differ = reduce(Column.__add__, [F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(FINE // 64)])
    odds = (1 + threshold) / 2
    most = int(FINE * (1 - odds) + MARGIN * (FINE * odds * (1 - odds)) ** 0.5)
    least = int(np.ceil(FINE * threshold - MARGIN * (FINE * threshold * (1 - threshold)) ** 0.5))
    shared = F.expr("get(filter(bands_a, (x, i) -> x = get(bands_b, i)), 0)")
    agree = F.expr("aggregate(zip_with(fine_a, fine_b, (x, y) -> IF(x = y, 1, 0)), 0, (s, x) -> s + x)")
    near = (F.col("root_a") != F.col("root_b")) & once & (differ <= most) & (shared == F.col("bucket")) & (agree >= least)
    joined = few.join(all_, "bucket").where(near)
    return joined.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()

"""Removal of repeated byte strings by fingerprints of sampled positions.

This takes the place of prefix doubling. There are no pairs of ranks at doubling offsets and no
sorts of all positions in Spark: ranking every byte would shuffle 14 GB a round for 864 MB of
text. Hashes meet in three fixed exchanges instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import BODY, KEY
from tidemark.llm.exchange import GROUP, column, dealt, first_pass, in_groups, lists, met, next_pass, of_kind
from tidemark.llm.spans import BYTE_VALUE, SECOND_BASE, Sums, Texts, binary, covered, found_in, grouped, in_pieces, mixed

#: Length of the prefix by whose hash sampled positions meet first.
GRAM = 64
#: Hashes are compared by the bits above these, which hold the position.
PLACE_BITS = 31
_LOW = np.uint64(0xFFFFFFFF)
#: Kinds of lists.
REPEATED, OPEN, OPEN_GRAMS, SPOKESMAN, STRINGS = range(5)


@dataclass
class Samples:
    """Sampled positions of some texts: each stands for the strings that start from ``low`` to ``high``."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray
    context: np.ndarray
    sums: Sums


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, in doubling steps."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if width > span else keys


def samples(texts: Texts, length: int) -> Samples:
    """For each string of ``length`` bytes, the position within it of least rank (of equals, the first).

    Equal strings have it at equal places. Strings with one sampled position are neighbours,
    so a sampled position stands for a stretch of starts, and its context is all their bytes.
    """
    data, n = texts.bytes, len(texts.bytes)
    sums = Sums(BYTE_VALUE[data])
    none = np.zeros(0, np.int64)
    if n < length:
        return Samples(none, none, none, none.astype(np.uint64), none.astype(np.uint64), sums)
    gram = sums.windows(GRAM)
    place = np.uint64((1 << PLACE_BITS) - 1)
    least = _least((gram & ~place) | np.arange(len(gram), dtype=np.uint64), length - GRAM + 1) & place
    within = np.ones(n, bool)
    for end in texts.offsets[1:]:
        within[max(0, end - length + 1) : end] = False
    start = np.flatnonzero(within[: len(least)])
    if not len(start):
        return Samples(none, none, none, none.astype(np.uint64), none.astype(np.uint64), sums)
    at = least[start].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    low, high = start[first], start[np.append(first[1:], len(start)) - 1]
    at = at[first]
    context = mixed(sums.between(low, high + length) ^ mixed((at - low).astype(np.uint64) + np.uint64(1)))
    return Samples(at, low, high, gram[at], context, sums)


def _code(gram: np.ndarray, parts: int) -> np.ndarray:
    return (((gram >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (gram & _LOW)


def _once(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the last first), and where each combination begins."""
    order = np.lexsort(keys)
    new = np.zeros(max(0, len(order) - 1), bool)
    for key in keys:
        new |= key[order][1:] != key[order][:-1]
    return order, np.flatnonzero(np.concatenate(([True], new))) if len(order) else np.zeros(0, np.int64)


def _times(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(first, n))


def _group(table: pa.Table) -> int:
    return table.column(GROUP)[0].as_py()


def _grams(table: pa.Table, length: int, parts: int) -> pa.Table:
    """Exchange 1: the hashes of the first bytes of sampled positions."""
    code = np.concatenate([_code(samples(texts, length).gram, parts) for _, texts in in_pieces(binary(table.column(BODY)))])
    order, first = grouped(code)
    code, several = code[order][first], (_times(first, len(code)) > 1).astype(np.uint8)
    return lists(dealt(_group(table), 0, code >> np.uint64(32), (code & _LOW).astype(np.uint32), several))


def _repeated_grams(table: pa.Table) -> pa.Table:
    """Positions whose hash is unique are done; the others go on."""
    rest, sizes = column(table, "a", np.uint32)
    several, _ = column(table, "b", np.uint8)
    order, first = grouped(rest)
    times = _times(first, len(rest))
    again = (times > 1) | (np.maximum.reduceat(several[order], first) > 0)
    mine = np.empty(len(rest), bool)
    mine[order] = np.repeat(again, times)
    return lists(_pick(table, sizes, mine, 0, rest))


def _pick(table: pa.Table, sizes: np.ndarray, keep: np.ndarray, kind: int, *arrays: np.ndarray) -> list[tuple]:
    rows, end = [], np.cumsum(sizes)
    for i, (part, source) in enumerate(zip(table.column("part").to_pylist(), table.column("source").to_pylist())):
        span = slice(end[i] - sizes[i], end[i])
        if keep[span].any():
            picked = [a[span][keep[span]] for a in arrays]
            rows.append((part, source, kind, *picked, *[None] * (3 - len(picked))))
    return rows


def _contexts(docs: pa.Table, answers: pa.Table, length: int, parts: int) -> pa.Table:
    """Exchange 2: for what is left, the hashes of all bytes they stand for."""
    answers = answers.take(pa.array(np.argsort(answers.column("part").to_numpy(), kind="stable")))
    rest, sizes = column(answers, "a", np.uint32)
    wanted = (np.repeat(answers.column("part").to_numpy().astype(np.uint64), sizes) << np.uint64(32)) | rest
    contexts, grams = [], []
    for _, texts in in_pieces(binary(docs.column(BODY))):
        s = samples(texts, length)
        mine = found_in(_code(s.gram, parts), wanted)[0]
        contexts.append(s.context[mine])
        grams.append(s.gram[mine])
    context, gram = np.concatenate(contexts), np.concatenate(grams)
    part = (context >> np.uint64(20)) % np.uint64(parts)
    order, first = _once(gram, context, part)
    several = (_times(first, len(order)) > 1).astype(np.uint8)
    at = order[first]
    return lists(dealt(_group(docs), 0, part[at], context[at], gram[at], several))


def _repeated_contexts(table: pa.Table, parts: int) -> pa.Table:
    """Contexts that recur are repeats as a whole. The others stay open, to be compared string by string.

    They may match part of a repeated context with the same first bytes, for which one group
    speaks, if it has any open one: lists of both go to where their first bytes meet.
    """
    context, sizes = column(table, "a", np.uint64)
    gram, several = column(table, "b", np.uint64)[0], column(table, "c", np.uint8)[0]
    order, first = _once(gram, context)
    times = _times(first, len(order))
    again = (times > 1) | (np.maximum.reduceat(several[order], first) > 0)
    repeated = np.empty(len(order), bool)
    repeated[order] = np.repeat(again, times)
    speaks = np.zeros(len(order), bool)
    speaks[order[first]] = again
    rows = _pick(table, sizes, repeated, REPEATED, context)
    rows += _pick(table, sizes, ~repeated, OPEN, context)
    opened = np.unique(gram[~repeated])
    to = (opened >> np.uint64(24)) % np.uint64(parts)
    by = np.argsort(to, kind="stable")
    rows += dealt(0, OPEN_GRAMS, to[by], opened[by])
    # Spokesmen meet their grams in a row for each pair of parts, with the group beside each entry.
    source = np.repeat(table.column("source").to_numpy(), sizes)[speaks].astype(np.int32)
    to = (gram[speaks] >> np.uint64(24)) % np.uint64(parts)
    by = np.argsort(to, kind="stable")
    rows += dealt(0, SPOKESMAN, to[by], gram[speaks][by], context[speaks][by], source[by])
    return lists(rows)


def _spokesmen(table: pa.Table) -> pa.Table:
    opened = np.unique(column(of_kind(table, OPEN_GRAMS), "a", np.uint64)[0])
    speak = of_kind(table, SPOKESMAN)
    grams, contexts, sources = column(speak, "a", np.uint64)[0], column(speak, "b", np.uint64)[0], column(speak, "c", np.int32)[0]
    asked = found_in(grams, opened)[0]
    by = np.argsort(sources[asked], kind="stable")
    answers = dealt(0, SPOKESMAN, sources[asked][by], contexts[asked][by])
    return lists([(0, source, kind, *rest) for source, _, kind, *rest in answers])


def _strings(docs: pa.Table, answers: pa.Table, length: int, parts: int) -> pa.Table:
    """Exchange 3: the hash of each string of full length that an open context, or one that speaks, stands for."""
    wanted = np.unique(column(answers, "a", np.uint64)[0])
    hashes, lanes = [], []
    if len(wanted):
        for _, texts in in_pieces(binary(docs.column(BODY))):
            s = samples(texts, length)
            mine = found_in(s.context, wanted)[0]
            start = _starts(s.low[mine], s.high[mine])
            hashes.append(s.sums.between(start, start + length))
            second = Sums(BYTE_VALUE[texts.bytes], SECOND_BASE)
            lanes.append(second.between(start, start + length) % np.uint64(parts))
    if not sum(map(len, hashes)):
        return lists([])
    whole, lane = np.concatenate(hashes), np.concatenate(lanes)
    order, first = _once(whole, lane)
    several = (_times(first, len(order)) > 1).astype(np.uint8)
    at = order[first]
    return lists(dealt(_group(docs), 0, lane[at], whole[at], several))


def _starts(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    size = high - low + 1
    return np.repeat(low, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def _repeated_strings(table: pa.Table) -> pa.Table:
    whole, sizes = column(table, "a", np.uint64)
    several, _ = column(table, "b", np.uint8)
    order, first = grouped(whole)
    times = _times(first, len(whole))
    again = (times > 1) | (np.maximum.reduceat(several[order], first) > 0)
    mine = np.empty(len(whole), bool)
    mine[order] = np.repeat(again, times)
    return lists(_pick(table, sizes, mine, STRINGS, whole))


def _remove(docs: pa.Table, answers: pa.Table, length: int) -> pa.Table:
    repeated, opened, strings = (np.unique(column(of_kind(answers, kind), "a", np.uint64)[0]) for kind in (REPEATED, OPEN, STRINGS))
    sizes, lost, spans, kept = [], [], [], []
    for _, texts in in_pieces(binary(docs.column(BODY))):
        data = texts.bytes
        gone = np.zeros(len(data), bool)
        if len(repeated) or len(opened):
            s = samples(texts, length)
            whole = found_in(s.context, repeated)[0]
            gone = covered(len(data), s.low[whole], s.high[whole] + length - s.low[whole])
            some = found_in(s.context, opened)[0]
            start = _starts(s.low[some], s.high[some])
            gone |= covered(len(data), start[found_in(s.sums.between(start, start + length), strings)[0]], length)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = texts.offsets[:-1]
        inner = inner[inner < len(data)]
        begins[inner] = gone[inner]
        count = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[texts.offsets])
        sizes.append(np.diff(texts.offsets))
        lost.append(count(gone))
        spans.append(count(begins))
        rest = data[~gone].tobytes()
        at = np.concatenate(([0], np.cumsum(~gone)))[texts.offsets]
        kept += [rest[a:b] for a, b in zip(at[:-1], at[1:])]
    numbers = [pa.array(np.concatenate(x).astype(np.int64)) for x in (sizes, lost, spans)]
    return pa.table([docs.column(KEY), *numbers, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def drop_repeated_bytes(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row: bytes in repeated strings go.

    A byte goes if a string of ``length`` bytes around it also starts anywhere else, in the
    same text or another. Prefix doubling was replaced by matching of sampled fingerprints: of
    each string the position with the least hash of 64 bytes is taken, so that equal strings keep
    equal positions. These hashes are exchanged first, then, of those that occur again, hashes of
    all bytes that a position stands for, and last, where those differ, hashes of its single
    strings. Equal hashes of 64 bits count as equal strings.

    Strings never cross texts. ``kept`` has the remaining bytes, which need not be whole
    characters. A null text is empty. Rows with equal ids count as different texts. A null id
    is carried through. Ids are integers. Only the two named columns are read. An empty table
    gives an empty table. ``length`` must be more than 64.
    """
    if length <= GRAM:
        raise ValueError(f"length must be more than {GRAM}")
    frame, parts = in_groups(docs, id_col, text_col)
    alive = met(first_pass(frame, lambda t: _grams(t, length, parts)), _repeated_grams)
    ranked = met(next_pass(frame, alive, lambda d, a: _contexts(d, a, length, parts)), lambda t: _repeated_contexts(t, parts))
    speak = met(ranked.where(f"kind IN ({OPEN_GRAMS}, {SPOKESMAN})"), _spokesmen)
    compared = ranked.where(f"kind = {OPEN}").unionByName(speak)
    strings = met(next_pass(frame, compared, lambda d, a: _strings(d, a, length, parts)), _repeated_strings)
    answers = ranked.where(f"kind IN ({REPEATED}, {OPEN})").unionByName(strings)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return next_pass(frame, answers, lambda d, a: _remove(d, a, length), schema)

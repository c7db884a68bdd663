"""Substring dedup by fixed-block anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import BODY, KEY
from tidemark.llm.exchange import GROUP, column, dealt, first_pass, ids, in_groups, lists, met, next_pass
from tidemark.llm.spans import SECOND_BASE, Sums, Words, binary, covered, found_in, grouped, in_pieces

ANCHOR, SEVERAL = 1, 2
_LOW = np.uint64(0xFFFFFFFF)


def _code(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of the hash space in the upper half, what is left of the hash in the lower."""
    return (((hashes >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (hashes & _LOW)


def _survey(table: pa.Table, block: int, parts: int) -> pa.Table:
    """Every rolling window of ``block`` words, marked if it is a block of the index or in several documents."""
    codes, docs, anchors = [], [], []
    for row, texts in in_pieces(binary(table.column(BODY))):
        words = Words(texts)
        first, hashes = words.runs(block)
        codes.append(_code(hashes, parts))
        docs.append(row + words.text[first])
        anchors.append(words.place()[first] % block == 0)
    code, doc, anchor = np.concatenate(codes), np.concatenate(docs), np.concatenate(anchors)
    if not len(code):
        return lists([])
    order, first = grouped(code)
    several = np.minimum.reduceat(doc[order], first) != np.maximum.reduceat(doc[order], first)
    marks = np.logical_or.reduceat(anchor[order], first) * ANCHOR + several * SEVERAL
    code = code[order][first]
    group = table.column(GROUP)[0].as_py()
    return lists(dealt(group, 0, code >> np.uint64(32), (code & _LOW).astype(np.uint32), marks.astype(np.uint8)))


def _anchored(table: pa.Table) -> pa.Table:
    """To each group those of its windows that are a block somewhere and lie in several documents."""
    rest, sizes = column(table, "a", np.uint32)
    marks, _ = column(table, "b", np.uint8)
    order, first = grouped(rest)
    times = np.diff(np.append(first, len(rest)))
    seen = np.bitwise_or.reduceat(marks[order], first)
    hit = ((seen & ANCHOR) > 0) & (((seen & SEVERAL) > 0) | (times > 1))
    mine = np.empty(len(rest), bool)
    mine[order] = np.repeat(hit, times)
    return _answers(table, sizes, mine, rest)


def _answers(table: pa.Table, sizes: np.ndarray, keep: np.ndarray, *arrays: np.ndarray) -> pa.Table:
    rows, end = [], np.cumsum(sizes)
    for i, (part, source) in enumerate(zip(table.column("part").to_pylist(), table.column("source").to_pylist())):
        span = slice(end[i] - sizes[i], end[i])
        if keep[span].any():
            picked = [a[span][keep[span]] for a in arrays]
            rows.append((part, source, 0, *picked, *[None] * (3 - len(picked))))
    return lists(rows)


def _extend(docs: pa.Table, answers: pa.Table, window: int, block: int, parts: int) -> pa.Table:
    """The windows around hits, with the smallest and largest id of the group's documents that have them."""
    order = np.argsort(answers.column("part").to_numpy(), kind="stable")
    answers = answers.take(pa.array(order))
    rest, sizes = column(answers, "a", np.uint32)
    hits = (np.repeat(answers.column("part").to_numpy().astype(np.uint64), sizes) << np.uint64(32)) | rest
    key = ids(docs)
    hashes, lanes, owners = [], [], []
    for row, texts in in_pieces(binary(docs.column(BODY))):
        words = Words(texts)
        first, grams = words.runs(block)
        hit = np.zeros(len(words) + 1, np.int64)
        hit[1:][first[found_in(_code(grams, parts), hits)[0]]] = 1
        hit = np.cumsum(hit)
        start, whole = words.runs(window)
        near = hit[start + (window - block + 1)] > hit[start]
        start, whole = start[near], whole[near]
        hashes.append(whole)
        lanes.append(Sums(words.hash, SECOND_BASE).between(start, start + window) % np.uint64(parts))
        owners.append(key[row + words.text[start]])
    whole, lane, owner = np.concatenate(hashes), np.concatenate(lanes), np.concatenate(owners)
    if not len(whole):
        return lists([])
    order = np.lexsort((whole, lane))
    whole, lane, owner = whole[order], lane[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], (whole[1:] != whole[:-1]) | (lane[1:] != lane[:-1]))))
    least, most = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
    group = docs.column(GROUP)[0].as_py()
    return lists(dealt(group, 0, lane[first], whole[first], least, most))


def _earliest(table: pa.Table) -> pa.Table:
    """To each group the smallest id with a window, where that is not its own largest one's."""
    whole, sizes = column(table, "a", np.uint64)
    least, most = column(table, "b", np.int64)[0], column(table, "c", np.int64)[0]
    order, first = grouped(whole)
    overall = np.empty(len(whole), np.int64)
    overall[order] = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.append(first, len(whole))))
    return _answers(table, sizes, overall < most, whole, overall)


def _remove(docs: pa.Table, answers: pa.Table, window: int) -> pa.Table:
    whole, least = column(answers, "a", np.uint64)[0], column(answers, "b", np.int64)[0]
    order = np.argsort(whole)
    whole, least = whole[order], least[order]
    key, rows = ids(docs), []
    for row, texts in in_pieces(binary(docs.column(BODY))):
        words = Words(texts)
        start, hashes = words.runs(window)
        found, at = found_in(hashes, whole)
        if len(whole):
            found &= least[at] < key[row + words.text[start]]
        gone = covered(len(words), start[found], window)
        counts = np.diff(words.bounds)
        lost = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.bounds])
        for i, text in enumerate(_kept(words, ~gone)):
            rows.append((int(counts[i]), int(lost[i]), text))
    n, lost, kept = zip(*rows)
    return pa.table({"doc_id": docs.column(KEY), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(lost, pa.int64()), "kept": pa.array(kept, pa.string())})


def _kept(words: Words, keep: np.ndarray) -> list[str]:
    """Each text's kept words, joined by one space."""
    start, size = words.start[keep], (words.end - words.start)[keep]
    place = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(place, size) + inner] = words.texts.bytes[np.repeat(start, size) + inner]
    before = np.concatenate(([0], np.cumsum(keep)))[words.bounds]
    ends = np.append(place, len(out))
    whole = out.tobytes()
    return [whole[ends[a] : max(ends[a], ends[b] - 1)].decode() for a, b in zip(before[:-1], before[1:])]


def drop_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row: words in repeats of earlier documents go.

    A word goes if a run of ``window`` words around it also starts in a document with a smaller
    id. The index holds each document's blocks of (window + 1) // 2 words, one after the other,
    so every run of ``window`` words has a whole block in it. All rolling windows of that many
    words are looked up. Hits extend to the runs around them, and the smallest id with a run
    decides; neighbouring runs make up the maximal repeat.

    A hit tells by about 40 bits of a hash, and a run by more than 64: 64 are compared, and
    others have chosen where. ``kept`` has the remaining words joined by one space.

    A null or empty text has no words. Rows of one id never remove each other's words. A null
    id counts as larger than any: its row gives way to all others, and not to other nulls. Ids
    are integers. Only the two named columns are read. An empty table gives an empty table.
    """
    frame, parts = in_groups(docs, id_col, text_col)
    block = (window + 1) // 2
    hits = met(first_pass(frame, lambda t: _survey(t, block, parts)), _anchored)
    runs = met(next_pass(frame, hits, lambda d, a: _extend(d, a, window, block, parts)), _earliest)
    schema = "doc_id long, n_words long, n_removed long, kept string"
    return next_pass(frame, runs, lambda d, a: _remove(d, a, window), schema)

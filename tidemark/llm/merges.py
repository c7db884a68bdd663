"""Token counts of a byte-level vocabulary, by merging pairs and counting the merges."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the vocabulary splits a text before it merges: endings of words, words, numbers, marks, white space.
#: Fixed value: must equal what the library's byte-level splitting does.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class all versions of the Unicode tables agree on; other texts are split by the library.
SETTLED = regex.compile("[\x00-ɏΑ-ΡΣ-ϿА-я‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣﻿�\U0001f600-\U0001f64f]*+")
#: Pieces of which a worker remembers the count, and the longest of them; beyond, it starts anew.
PIECES, LONGEST = 1_000_000, 64
#: Characters of a text that are split at once, and where it may be cut: such a space begins a piece.
STRETCH = 1 << 18
CUT = regex.compile(r"(?<=[A-Za-z])(?=\x20)")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be seen, else one from U+0100 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


class Merges:
    """The order of merges of a vocabulary. A symbol is a number, a pair is two numbers in one."""

    SHIFT = 32

    def __init__(self, merges: list):
        numbers = {letter: b for b, letter in enumerate(byte_letters())}
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            both = numbers.setdefault(left + right, len(numbers))
            self.pairs.setdefault(numbers[left] << self.SHIFT | numbers[right], (rank, both))

    def count(self, data: bytes) -> int:
        """Symbols that are left of ``data`` when no pair can be merged any more.

        The pairs lie in a heap by rank, then place. The one on top is merged if it still
        stands as it did when it was pushed: its left symbol absorbs its right one, links
        skip that, and the two new pairs are pushed. So n bytes take n log n steps.
        """
        pairs, shift = self.pairs, self.SHIFT
        n = len(data)
        if n < 2:
            return n
        symbols = list(data)
        heap = []
        for place in range(n - 1):
            merge = pairs.get(symbols[place] << shift | symbols[place + 1])
            if merge is not None:
                heap.append((merge[0], place, merge[1]))
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merged = 0
        while heap:
            rank, left, both = heappop(heap)
            if symbols[left] < 0 or (right := after[left]) >= n:
                continue
            now = pairs.get(symbols[left] << shift | symbols[right])
            if now is None or now[0] != rank:
                continue
            symbols[left], symbols[right] = both, -1
            merged += 1
            further = after[left] = after[right]
            if further < n:
                before[further] = left
                merge = pairs.get(both << shift | symbols[further])
                if merge is not None:
                    heappush(heap, (merge[0], left, merge[1]))
            if (ahead := before[left]) >= 0:
                merge = pairs.get(symbols[ahead] << shift | both)
                if merge is not None:
                    heappush(heap, (merge[0], ahead, merge[1]))
        return n - merged


class _Counts(dict):
    """Token counts of pieces, made when first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        n = self.merges.count(piece.encode())
        if len(piece) <= LONGEST:
            self[piece] = n
        return n


class Counter:
    """Token counts of whole texts, without token ids."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already take all cores
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            stored = json.load(file)
        splitting = stored["pre_tokenizer"] or {}
        if stored["normalizer"] or splitting.get("type") != "ByteLevel" or splitting["add_prefix_space"] or not splitting["use_regex"]:
            raise ValueError("the vocabulary must be byte-level, split by its regex and take texts as they are")
        added = stored["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens must stand for their own letters alone")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.split = regex.compile(SPLIT)
        self.library = Tokenizer.from_file(vocabulary).pre_tokenizer
        self.counts = _Counts(Merges(stored["model"]["merges"]))

    def __call__(self, text: str) -> int:
        if len(self.counts) > PIECES:
            self.counts.clear()
        if self.added is None or not (found := len(self.added.findall(text))):
            return self._count(text)
        return found + sum(map(self._count, self.added.split(text)))

    def _count(self, text: str) -> int:
        counts, n, at = self.counts, 0, 0
        while at < len(text):
            cut = CUT.search(text, at + STRETCH)
            stretch = text[at : cut.start() if cut else None]
            if SETTLED.fullmatch(stretch) is not None:
                n += sum(map(counts.__getitem__, self.split.findall(stretch)))
            else:
                n += sum(counts[stretch[start:end]] for _, (start, end) in self.library.pre_tokenize_str(stretch))
            at += len(stretch)
        return n


_counters: dict[str, Counter] = {}


def counter(vocabulary: str) -> Counter:
    """One for each worker process."""
    if vocabulary not in _counters:
        _counters[vocabulary] = Counter(vocabulary)
    return _counters[vocabulary]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row: tokens of its whole text.

    Counts equal the library's without begin, end or added special tokens; a special token's
    letters within a text are that token. ``vocabulary`` is a byte-level file that every
    executor can read. Texts never leave their task, and nothing is shuffled.

    A null text is empty; an empty text has no tokens. Repeated rows and rows without an id
    each give a row, with the id as it is. A long text is split a quarter million characters at
    a time, so it takes little more room than itself; one piece of n bytes takes n log n steps and some
    200 n bytes. An empty table gives an empty table. Other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary)
        for batch in batches:
            texts = batch.column("text")
            n = [tokens(text.as_py()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

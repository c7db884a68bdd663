"""Token ids in ORC files: written in order of ids, read back by stripes."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for, text_bytes
from tidemark.llm.spans import IN_WORD, Texts, binary, in_pieces
from tidemark.session import shared_dir

#: Bytes of text that become one file.
FILE_BYTES = 32 << 20
#: Bytes of text that are encoded at once.
PIECE_BYTES = 4 << 20
#: Words of which a worker remembers the ids; beyond, it starts anew.
WORDS = 1_500_000
#: New words that the library encodes in one call: what it returns takes hundreds of bytes for each.
CALL = 1 << 14
#: The number of a file, from its name.
FILE = "CAST(regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) AS INT)"
#: ORC settings: ids are integers under run-length encoding, ``doc_id`` has an index and a Bloom filter.
ORC = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _bytes_of(*some: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(some)] = True
    return table


LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: A letter or digit and a mark after it are always parted by the vocabulary's splitting.
LETTER, MARK = _bytes_of(*b"0123456789abcdefghijklmnopqrstuvwxyz"), _bytes_of(*b'.,;:!?|%&#*$"()')
WORD_END = "</w>"


def _pieces(texts: Texts) -> tuple[pa.Array, np.ndarray]:
    """Words and marks of all texts in a row, lower-cased, and where each text's begin.

    What stands between white space and may hold a special token stays as it is.
    """
    data = texts.bytes
    inside = IN_WORD[data]
    low = LOWERED[data]
    edge = np.ones(len(data), bool)  # nothing of the same text that is no white space stands before
    edge[1:] = ~inside[:-1]
    edge[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
    edge &= inside
    parted = MARK[data]
    parted[1:] &= LETTER[low[:-1]]
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    if len(special):
        starts = np.flatnonzero(edge)
        whole = np.unique(np.searchsorted(starts, special, "right")) - 1
        steps = np.zeros(len(data) + 1, np.int8)
        steps[starts[whole]] = 1
        after = whole[whole + 1 < len(starts)] + 1
        steps[starts[after]] -= 1
        kept = np.cumsum(steps[:-1], dtype=np.int8) > 0
        low[kept] = data[kept]
        parted[kept] = False
    edge |= parted
    at = np.flatnonzero(edge)
    offsets = np.append(np.flatnonzero(edge[inside]), np.count_nonzero(inside)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])])
    return words, np.searchsorted(at, texts.offsets)


class Encoder:
    """Ids of whole texts, from those of their pieces between ASCII white space.

    The vocabulary must never join or look across white space and must drop it; must take
    A-Z for a-z; must part a run of letters from marks after it; must take the letters of its
    model for bytes; and must mark the last id of such a run. Then the ids of a text are those
    of its words and marks in a row. Most words come again and again, so their ids are kept in
    one array, from which those of all words of many texts are taken at once; the library
    encodes only new ones, many plain words in one call.
    """

    def __init__(self, vocabulary: str, memory: int = WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already take all cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        # The model alone, for words that the vocabulary's own rules would neither change nor split.
        self.plain = Tokenizer(self.tokenizer.model)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith(WORD_END)]] = True
        self.memory = memory
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}  # the number of each known word
        self.ids = np.zeros(0, np.uint32)  # of all known words in a row
        self.bounds = np.zeros(1, np.int64)  # of each word's ids

    def _encode(self, pieces: list[bytes]) -> None:
        ids, ends, known = [self.ids], [self.bounds], len(self.ids)
        for at in range(0, len(pieces), CALL):
            order, found, stops = self._call(pieces[at : at + CALL])
            self.words.update(zip(order, range(len(self.words), len(self.words) + len(order))))
            ids.append(found)
            ends.append(stops + known)
            known += len(found)
        self.ids, self.bounds = np.concatenate(ids), np.concatenate(ends)

    def _call(self, pieces: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The pieces in another order, their ids in a row, and where each one's end."""
        texts = [p.decode().lower() for p in pieces]
        # Latin letters only: a run of them is one word to any version of the tables of letters.
        plain = [t.isalpha() and (t.isascii() or max(t) < "\u0250") for t in texts]
        words = [p for p, is_plain in zip(pieces, plain) if is_plain]
        rest = [p for p, is_plain in zip(pieces, plain) if not is_plain]
        joined = self.plain.encode_batch_fast([" ".join([t for t, is_plain in zip(texts, plain) if is_plain])], add_special_tokens=False)[0]
        ids = np.array(joined.ids, np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary must mark the last id of each word, and no other")
        found = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)] if rest else []
        others = np.array([i for x in found for i in x], np.uint32)
        return words + rest, np.append(ids, others), np.append(stops, np.cumsum([len(x) for x in found], dtype=np.int64) + len(ids))

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin."""
        pieces, cuts = _pieces(texts)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = list(map(self.words.get, distinct))
        new = [x for x, n in zip(distinct, known) if n is None]
        if len(self.words) + len(new) > self.memory:
            self._forget()
            new = distinct
        if new:
            self._encode(new)
            known = list(map(self.words.__getitem__, distinct))
        number = np.array(known, np.int64)
        start, size = self.bounds[number], np.diff(self.bounds)[number].astype(np.int32)
        index = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[index]
        places = np.zeros(len(index) + 1, np.int32)
        np.cumsum(sizes, out=places[1:])
        at = np.repeat(start.astype(np.int32)[index] - places[:-1], sizes)
        at += np.arange(len(at), dtype=np.int32)
        return self.ids[at], places[cuts]


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One for each worker process."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES
) -> None:
    """ORC files under ``folder`` with (doc_id, size, place, ids), in ascending order of doc_id over all files.

    Texts are dealt into ranges of ids and sorted before they are encoded, so each file is
    written as its texts are encoded. The numbers of files are in order. Every document ends
    with ``end_id``. Rows without an id come first; a null or empty text has only the end.
    """
    spark = docs.sparkSession
    files = parts_for(spark, text_bytes(docs, text_col), file_bytes)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    # Rows of one id, or without one, may fill several files: in order of a hash of their texts.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(vocabulary)
        ahead = 0  # ids of this file so far
        for batch in batches:
            for row, texts in in_pieces(binary(batch.column("text")), PIECE_BYTES):  # ids take more room than texts
                n = len(texts)
                ids, places = encode_texts(texts)
                offsets = places + np.arange(n + 1, dtype=np.int64)
                flat = np.full(offsets[-1], end_id, np.uint32)
                own = np.ones(len(flat), bool)
                own[offsets[1:] - 1] = False
                flat[own] = ids
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int32)))
                sizes, places_in_file = pa.array(np.diff(offsets), pa.int64()), pa.array(ahead + offsets[:-1], pa.int64())
                ahead += int(offsets[-1])
                columns = [batch.column("doc_id").slice(row, n), sizes, places_in_file, lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "place", "ids"])

    rows.mapInArrow(encode, "doc_id long, size long, place long, ids array<int>").write.options(**ORC).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, file, start, n_tokens, ids_crc32) for every document in the files.

    ``start`` counts the ids of all documents before it. Sums over each file come first, so
    files are read in parallel, stripe by stripe, and no task sees more than one file's rows.
    """
    stored = spark.read.schema("doc_id long, place long, ids array<int>").orc(folder)
    stored = stored.select("doc_id", "place", "ids", F.expr(FILE).alias("file"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            raw = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])]
            columns = [batch.column(c) for c in ("doc_id", "file", "place")] + [pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "file", "place", "n_tokens", "ids_crc32"])

    rows = stored.mapInArrow(check, "doc_id long, file int, place long, n_tokens long, ids_crc32 long")
    # Sums of files take the column of sizes alone; the ids are read once.
    sizes = spark.read.schema("size long").orc(folder).select("size", F.expr(FILE).alias("file"))
    files = sizes.groupBy("file").agg(F.sum("size").alias("tokens"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = files.select("file", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("before"))
    start = F.col("before") + F.col("place")  # a file's rows know where they begin in it
    return rows.join(files, "file").select("doc_id", "file", start.alias("start"), "n_tokens", "ids_crc32")


def find_tokens(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: file statistics, row indexes and Bloom filters skip the rest."""
    return spark.read.schema("doc_id long, ids array<int>").orc(folder).where(F.col("doc_id").isin(doc_ids))


def encode_corpus(docs: DataFrame, vocabulary: str, folder: str | None = None, **options) -> DataFrame:
    """Writes the files, by default in a new folder of the cluster's shared one, and reads them back.

    Rows of one id, or without one, lie next to each other, in order of a hash of their texts;
    ``start`` is where each lies. An empty table makes an
    empty result. Only the two named columns are read.
    """
    folder = folder or shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, folder, vocabulary, **options)
    return read_tokens(docs.sparkSession, folder)

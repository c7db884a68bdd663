"""The corpus pipeline: from documents to token files, one stage after the other.

In every stage a null text is an empty one; ids may be null, tied or repeated, as rows are told
apart by a hash besides; an empty table gives an empty table. Further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.classifier import score, train
from tidemark.llm.common import SPACED_WORD
from tidemark.llm.decontamination import decontaminate
from tidemark.llm.mixing import length_odds, mix
from tidemark.llm.probminhash import near_duplicates
from tidemark.llm.tokens import encode_corpus
from tidemark.session import shared_dir

#: Documents of a lower score go.
LEAST_QUALITY = 0.3
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _twin() -> Column:
    """Tells rows of one id with different texts apart, as the operators do."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects. Labels teach it; those of the held-out fold do not."""
    model = train(docs, _table(spark, sf_dir, "labels"))
    kept = docs.select(*COLUMNS).withColumn("_text", F.col("text"))
    scored = score(kept, model, text_col="_text", more=COLUMNS[1:])
    return scored.where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the least id."""
    classes = near_duplicates(docs).where("keep").groupBy("doc_id", "twin").agg(F.count("*").alias("rows"))
    d, c = docs.select(*COLUMNS, _twin().alias("t")).alias("d"), classes.alias("c")
    kept = d.join(c, F.expr("d.doc_id <=> c.doc_id AND d.t = c.twin")).select("d.*", "rows")
    # Rows alike in id and text share the mark; of those one stays, unless they have no words.
    wordless = ~F.coalesce("text", F.lit("")).rlike(SPACED_WORD)
    single = kept.where((F.col("rows") == 1) | wordless)
    several = kept.where((F.col("rows") > 1) & ~wordless).dropDuplicates(["doc_id", "t"])
    return single.unionByName(several).select(*COLUMNS)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of a benchmark item."""
    found = decontaminate(docs, _table(spark, sf_dir, "benchmark")).where("n_hit > 0").select("doc_id", "twin").distinct().alias("f")
    d = docs.select(*COLUMNS, _twin().alias("t")).alias("d")
    return d.join(found, F.expr("d.doc_id <=> f.doc_id AND d.t = f.twin"), "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes.

    Rows alike in all columns count together: each of them is in the mix, and their copies are
    added. Null and repeated ids are told apart by a hash of all columns.
    """
    alike = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in COLUMNS])
    taken = mix(docs, importance=length_odds(), twin=alike).where("copies > 0")
    taken = taken.groupBy("doc_id", "twin").agg(F.sum("copies").alias("copies")).alias("t")
    d = docs.select(*COLUMNS, alike.alias("twin")).dropDuplicates(["doc_id", "twin"]).alias("d")
    joined = d.join(taken, F.expr("d.doc_id <=> t.doc_id AND d.twin = t.twin")).select("d.*", "copies")
    return joined.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files; a row for each document in them, as read back."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return encode_corpus(docs, vocabulary).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("clean_of_benchmarks", clean_of_benchmarks),
    ("mixed", mixed),
    ("token_files", token_files),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

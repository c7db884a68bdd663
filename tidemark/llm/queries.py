"""The registered queries of this package, with SQL where it can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, spellings, vector_codes
from tidemark.llm.classifier import classify
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.merges import count_tokens
from tidemark.llm.probminhash import near_duplicates
from tidemark.llm.quality_rules import apply_rules
from tidemark.llm.secrets import links_listed, listed, scan_secrets
from tidemark.llm.substring import drop_repeats
from tidemark.llm.suffixes import drop_repeated_bytes
from tidemark.llm.tokens import encode_corpus


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark, folder):
    kept = drop_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_secrets(spark, folder):
    found = scan_secrets(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("base", "linked"))
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(every).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
        links_listed(F.col("links")).alias("links"),
    )


def op3_classifier(spark, folder):
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_probminhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "keep", "n_class")


def op5_decontamination(spark, folder):
    found = decontamination.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_suffix_dedup(spark, folder):
    kept = drop_repeated_bytes(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_quality_rules(spark, folder):
    ruled = apply_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return ruled.select("doc_id", *counts, "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


def op8_mixing(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"), importance=mixing.length_odds())
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_token_files(spark, folder):
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return encode_corpus(table(spark, folder, "documents"), vocabulary).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_licenses(spark, folder):
    found = scan_licenses(table(spark, folder, "documents"))
    labels = lambda spans: F.transform(spans, lambda s: s["label"])
    joined = lambda names: F.array_join(F.sort_array(F.array_distinct(names)), ",")
    starts = F.transform("base", lambda s: s["first"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(labels("base")).alias("base_labels"),
        joined(F.concat(labels("base"), labels("found"))).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["trust"])), F.lit(0.0)).alias("score"),
    )


def op11_token_counts(spark, folder):
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_vector_codes(spark, folder):
    coded = vector_codes.encode_vectors(table(spark, folder, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_spellings(spark, folder):
    return spellings.group_spellings(table(spark, folder, "documents"))


CATALOG = {
    "op1_substring_dedup": (op1_substring_dedup, None),
    "op2_secrets": (op2_secrets, None),
    "op3_classifier": (op3_classifier, None),
    "op4_probminhash": (op4_probminhash, None),
    "op5_decontamination": (op5_decontamination, decontamination.SQL),
    "op6_suffix_dedup": (op6_suffix_dedup, None),
    "op7_quality_rules": (op7_quality_rules, None),
    "op8_mixing": (op8_mixing, mixing.SQL),
    "op9_token_files": (op9_token_files, None),
    "op10_licenses": (op10_licenses, None),
    "op11_token_counts": (op11_token_counts, None),
    "op12_vector_codes": (op12_vector_codes, vector_codes.sql()),
    "op13_spellings": (op13_spellings, spellings.SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}

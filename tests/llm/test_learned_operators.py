"""The classifier, certified cutoffs, and the pipeline."""

import os
import tracemalloc
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import classifier, queries
from tidemark.llm.classifier import classify, score, train
from tidemark.llm.components import components
from tidemark.llm.probminhash import near_duplicates
from tidemark.llm.quality_rules import apply_rules, at_most, certified


@pytest.fixture(scope="module")
def rated(cluster):
    folder = "/root/testdata/sf0.01"
    return queries.op3_classifier(cluster, folder).join(cluster.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()


def test_classifier_on_rows_it_never_saw(rated):
    held = [r for r in rated if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rated)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rated)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.9
    assert all(r.predicted for r in held if r.quality)


def test_classifier_of_odd(cluster, odd, odd_rows):
    labels = cluster.createDataFrame([(6, 1, "x"), (7, 1, "x"), (13, 0, "x"), (21, None, "x"), (None, 0, "x"), (6, 0, "x")], "doc_id long, quality int, text string")
    found = classify(odd, labels).collect()
    assert len(found) == len(odd_rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False, False]
    assert len({r.score for r in found if r.doc_id in (8, 9, 10)}) == 1
    none = cluster.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classify(odd, none).collect()} == {0.5}


def test_repeated_rows_teach_once(cluster, monkeypatch):
    """An id with many rows is learned from like any other."""
    words = "an be the of in or st er on th".split()
    single = [(i, " ".join(words[(i * k) % 10] for k in range(30))) for i in range(1, 40)]
    taught = [row for row in single if zlib.crc32(str(row[0]).encode()) % 5]
    several = [*single, *[taught[0]] * 300]
    labels = cluster.createDataFrame([(i, i % 2) for i, _ in single], "doc_id long, quality int")
    models = [train(cluster.createDataFrame(rows, "doc_id long, text string").repartition(4), labels) for rows in (single, several)]
    assert models[0].any() and np.allclose(*models)
    other = cluster.createDataFrame([*single, *[(taught[0][0], f"text {k}") for k in range(300)]], "doc_id long, text string").repartition(4)
    learned, seen = classifier._learn, str(cluster.sparkContext._temp_dir) + "/taught"
    os.mkdir(seen)

    def noted(table, *rest):
        with open(f"{seen}/{uuid.uuid4()}", "w") as out:
            out.write(str(table.num_rows))
        return learned(table, *rest)

    monkeypatch.setattr(classifier, "_learn", noted)
    train(other, labels)
    assert sum(int(open(f"{seen}/{name}").read()) for name in os.listdir(seen)) == len(taught)


def test_learning_takes_little_memory_at_once():
    """Beside its features, work arrays of a piece only: workers keep much of the most they ever took."""
    draw = np.random.default_rng(1)
    texts = [" ".join(map(str, draw.integers(0, 5000, 60))) for _ in range(8000)]  # 2.3 MB
    table = pa.table({"_body": texts, "goal": np.arange(8000) % 2.0, "turn": np.arange(8000)})
    tracemalloc.start()
    try:
        classifier._learn(table, classifier.Settings(), 1)
        assert tracemalloc.get_traced_memory()[1] < 70e6
    finally:
        tracemalloc.stop()


def test_held_out_labels_teach_nothing(cluster, data):
    docs, labels = (cluster.read.parquet(f"{data}/{name}.parquet") for name in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(train(docs, labels), train(docs, turned))


def test_exact_tail():
    assert at_most(10, 0.3, 2)[2] == pytest.approx(sum(c * 0.3**k * 0.7 ** (10 - k) for k, c in enumerate((1, 10, 45))))


def test_certified_cutoffs_hold_the_risk():
    """Over many draws, the chosen cutoff rejects too many good documents no more often than agreed."""
    draw = np.random.default_rng(3)
    risk, chance, wrong = 0.05, 0.1, 0
    true = np.linspace(2, 0.02, 51)
    true /= true.sum()
    bad_true = true[::-1]
    for _ in range(400):
        good, bad = draw.multinomial(400, true), draw.multinomial(200, bad_true)
        chosen = certified(good, bad, risk, chance)
        wrong += chosen is not None and true[chosen:].sum() > risk
    assert wrong / 400 <= chance


def test_few_labels_certify_nothing():
    assert certified(np.array([20, 0]), np.array([0, 20]), 0.01, 0.01) is None
    assert certified(np.array([5000, 0]), np.array([0, 20]), 0.01, 0.01) == 1


def test_rules_keep_good_documents(cluster):
    folder = "/root/testdata/sf0.1"
    docs, labels = (cluster.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    ruled = apply_rules(docs, labels).join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in ruled}
    assert n.get((1, False), 0) <= 0.02 * n[1, True]
    assert n.get((0, False), 0) >= n.get((0, True), 0)


def test_a_labelled_id_is_one_draw(cluster):
    """Copies of one row make no cutoff certified, and a row that breaks a rule counts though copies do not."""
    fair = "one or two words that are good and said with no haste at all here now"
    broken = " ".join("word#%d" % k + "#*$%&|<>" for k in range(20))
    rows = [(i, fair if i > 2 else broken, "en") for i in range(1, 401)] + [(i, broken, "en") for i in range(401, 501)]
    labels = cluster.createDataFrame([(i, int(i <= 400)) for i in range(1, 501)], "doc_id long, quality int")
    schema = "doc_id long, text string, lang string"

    def kept(more):
        found = apply_rules(cluster.createDataFrame(rows + more, schema).repartition(4), labels, risk=0.12, chance=0.3)
        return {r.doc_id: r.kept for r in found.where("NOT base_failed").dropDuplicates(["doc_id", "kept"]).collect()}

    alone = kept([])
    assert kept([(9, fair, "en")] * 5000) == alone
    many = [(i, broken, "en") for i in range(10, 60)]
    assert all(kept(many)[i] for i in range(401, 501))  # 52 of 400 good ids break it, too many for a cutoff


def test_rules_of_odd(cluster, odd, odd_rows):
    labels = cluster.createDataFrame([(6, 1, "x"), (13, 0, "x"), (21, None, "x"), (None, 1, "x"), (6, 0, "x")], "doc_id long, quality int, lang string")
    found = apply_rules(odd, labels).collect()
    assert len(found) == len(odd_rows)
    assert all(r.kept != r.base_failed for r in found)


def test_components(cluster):
    edges = [(f"{k:03}", f"{k + 1:03}") for k in range(60)] + [("a", "c"), ("b", "c"), ("d", "d"), ("a", "c")]
    found = {r.node: r.root for r in components(cluster.createDataFrame(edges, "a string, b string")).collect()}
    assert found == {f"{k:03}": "000" for k in range(1, 61)} | {"b": "a", "c": "a"}
    assert components(cluster.createDataFrame([], "a string, b string")).count() == 0


def test_components_of_few_edges_take_few_tasks(cluster):
    """However many partitions the session shuffles to: else each round leaves thousands of tasks and files."""
    session = cluster.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "64")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = components(session.createDataFrame([(i, i + 1) for i in range(0, 300, 2)], "a long, b long"))
    assert found.count() == 150
    assert found.rdd.getNumPartitions() <= 4


def test_near_copies_start_no_second_kind_of_worker(cluster, odd, monkeypatch):
    """Rows made of the driver's Python are decoded by Python workers of their own on every executor."""

    def refused(*a, **b):
        raise AssertionError("rows of the driver's Python")

    monkeypatch.setattr(SparkSession, "createDataFrame", refused)
    assert near_duplicates(odd).count() == odd.count()


def test_pipeline_stage_by_stage(cluster, data, tmp_path):
    docs = cluster.read.parquet(f"{data}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(cluster, docs, data).write.parquet(str(tmp_path / name))
        seen[name] = cluster.read.parquet(str(tmp_path / name))
        if name != "token_files":
            assert seen[name].columns == list(corpus_pipeline.COLUMNS)
        docs = seen[name]
    texts = {name: [r.text for r in df.collect()] for name, df in list(seen.items())[:4]}
    assert len(set(texts["near_copies"])) == len(texts["near_copies"])
    assert set(texts["mixed"]) <= set(texts["clean_of_benchmarks"]) <= set(texts["near_copies"]) <= set(texts["quality"])
    assert seen["token_files"].count() == len(texts["mixed"])


def test_pipeline_of_odd(cluster, odd, odd_rows, data, tmp_path):
    """Repeated rows of one id leave one, rows of one id with different texts stay apart."""
    kept = corpus_pipeline.near_copies(cluster, odd, data).collect()
    wanted = [row for k, row in enumerate(odd_rows) if k not in (1, 3, 11)]
    assert sorted(repr((r.doc_id, r.text)) for r in kept) == sorted(repr(row[:2]) for row in wanted)
    assert corpus_pipeline.clean_of_benchmarks(cluster, odd, data).count() == len(odd_rows)
    assert {r.doc_id for r in corpus_pipeline.mixed(cluster, odd, data).collect()} <= {row[0] for row in odd_rows}


def test_scores_pass_columns_through(cluster, odd):
    model = np.zeros((1 << 18) + 1)
    scored = score(odd, model, more=("lang", "source", "n_chars"))
    assert scored.columns == ["doc_id", "lang", "source", "n_chars", "score"]
    assert {r.score for r in scored.collect()} == {0.5}

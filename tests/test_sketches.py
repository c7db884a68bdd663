"""Stored sketches of visitors, and functions over a table argument."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions import register
from tidemark.functions.tables import Runs
from tidemark.operators import merge_visitors, rolling_visitors, visitor_sketches

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)


@pytest.fixture
def visits(spark):
    """Ten days; each day's 40,000 users share half with the day before. One category has most of them."""
    day = (F.col("id") / 40_000).cast("int")
    return spark.range(0, 400_000, 1, 8).select(
        day.alias("day"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(day, F.col("id").cast("int") % 24)).alias("ts"),
        (F.col("id") % 40_000 + day * 20_000).cast("string").alias("user"),
        F.when(F.col("id") % 100 == 0, "rare").otherwise("busy").alias("category"),
    )


def test_merged_sketches_are_within_their_bounds(visits, spark, tmp_path):
    visitor_sketches(visits, "ts", DAY, ["category"], "user").write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert stored.count() == 20
    assert stored.agg(F.max(F.length("visitors"))).first()[0] < 5_000
    exact = {r.category: (r.pv, r.uv) for r in visits.groupBy("category").agg(F.count("*").alias("pv"), F.countDistinct("user").alias("uv")).collect()}
    for row in merge_visitors(stored, ["category"]).collect():
        pv, uv = exact[row.category]
        assert row.pv == pv and row.uv_low <= uv <= row.uv_high
        assert row.uv_high - row.uv_low < 0.15 * uv
    # Days added up would count every user of two days twice.
    assert stored.where("category = 'busy'").agg(F.sum(F.hll_sketch_estimate("visitors"))).first()[0] > 1.5 * exact["busy"][1]


def test_rolling_visitors(visits):
    found = rolling_visitors(visitor_sketches(visits, "ts", DAY, [], "user"), DAY, 3, [])
    rows = {r.window_start: r for r in found.collect()}
    assert len(rows) == 12
    users = {}
    for r in visits.select("day", "user").distinct().collect():
        users.setdefault(r.day, set()).add(r.user)
    for end in range(12):
        wanted = set().union(*[users.get(end - k, set()) for k in range(3)])
        row = rows[START + end * DAY]
        assert row.uv_low <= len(wanted) <= row.uv_high


def test_sketches_of_odd_rows(spark):
    schema = "ts timestamp_ntz, k string, u string"
    df = spark.createDataFrame([(START, "a", None), (START, "a", None), (START, None, "x"), (START, None, "x"), (None, "a", "y")], schema)
    found = merge_visitors(visitor_sketches(df, "ts", DAY, ["k"], "u"), ["k"]).collect()
    assert {r.k: (r.pv, r.uv, r.uv_low, r.uv_high) for r in found} == {"a": (2, 0, 0, 0), None: (2, 1, 0, 2)}
    none = visitor_sketches(spark.createDataFrame([], schema), "ts", DAY, ["k"], "u")
    assert none.count() == 0 and rolling_visitors(none, DAY, 2, ["k"]).count() == 0


def runs(spark, df, arguments="'k', 'v', 't'"):
    register(spark, "runs", Runs, "table")
    df.createOrReplaceTempView("given")
    found = spark.sql(f"SELECT * FROM runs(TABLE(SELECT * FROM given) PARTITION BY k ORDER BY (t), {arguments})")
    return found.columns, sorted(map(tuple, found.collect()), key=str)


def test_runs_of_a_table(spark):
    rows = [(1, "a", 1), (1, "a", 2), (1, None, 3), (1, None, 4), (1, "a", 5), (2, "a", 6), (None, "a", 7)]
    df = spark.createDataFrame(rows, "k int, v string, t bigint").repartition(5)
    columns, found = runs(spark, df)
    assert columns == ["k", "v", "n", "first_at", "last_at"]
    wanted = [(1, "a", 2, 1, 2), (1, None, 2, 3, 4), (1, "a", 1, 5, 5), (2, "a", 1, 6, 6), (None, "a", 1, 7, 7)]
    assert found == sorted(wanted, key=str)
    assert runs(spark, df.where("false"))[1] == []


def test_runs_make_no_batch_of_each_row(spark):
    rows = [(1, None, None), (None, float("nan"), START), (None, 1.5, START + DAY), (None, 1.5, START + 2 * DAY)]
    df = spark.createDataFrame(rows, "k int, v double, t timestamp_ntz")
    wanted = [(1, None, 1, None, None), (None, float("nan"), 1, START, START), (None, 1.5, 2, START + DAY, START + 2 * DAY)]
    assert list(map(str, runs(spark, df)[1])) == sorted(map(str, wanted))
    found = spark.sql("SELECT * FROM runs(TABLE(given) PARTITION BY k ORDER BY (t), 'k', 'v', 't')")
    assert "ArrowEvalPythonUDTF" not in found._jdf.queryExecution().toString()


def test_runs_says_what_is_wrong(spark):
    df = spark.createDataFrame([(1, "a", 1)], "k int, v string, t bigint")
    with pytest.raises(AnalysisException, match="no column"):
        runs(spark, df, "'k', 'w', 't'")
    with pytest.raises(AnalysisException, match="name of a column"):
        runs(spark, df, "'k', 3, 't'")
    with pytest.raises(ValueError, match="schema"):
        register(spark, "runs", Runs, "table", "k int")
    with pytest.raises(ValueError, match="return"):
        register(spark, "same", lambda s: s, "scalar")

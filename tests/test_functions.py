"""User functions."""

import pickle
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql.types import DoubleType, LongType

from tidemark.functions import UserAggregate, aggregate_by_key, register
from tidemark.functions.registry import partial_states
from tidemark.queries.relational import Mean as StreamMean
from tidemark.queries.stateful import Count, CountAndLargest, MeanOfCents
from tidemark.session import job_session

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Mean(UserAggregate):
    def start(self):
        return 0.0, 0

    def add(self, state, values):
        return state[0] + float(values.sum()), state[1] + int(values.count())

    def merge(self, state, other):
        return state[0] + other[0], state[1] + other[1]

    def finish(self, state):
        return state[0] / state[1] if state[1] else None


class Letters:
    def eval(self, word: str):
        for letter in word or "":
            yield (letter,)


@pytest.fixture
def words(spark):
    df = spark.createDataFrame([("a", 1, "xy"), ("a", 3, "z"), ("b", None, None), (None, 5, "q")], "k string, n int, w string")
    df.createOrReplaceTempView("words")
    return df


def test_scalar(spark, words):
    def twice(n: pd.Series) -> pd.Series:
        return n * 2

    register(spark, "twice", twice, "scalar", "double")
    assert sorted(r[0] for r in spark.sql("SELECT twice(n) FROM words WHERE n IS NOT NULL").collect()) == [2, 6, 10]


def test_aggregate_in_sql(spark, words):
    register(spark, "my_mean", Mean(), "aggregate", "double")
    got = {r.k: r.m for r in spark.sql("SELECT k, my_mean(n) AS m FROM words GROUP BY k").collect()}
    assert got == {"a": 2.0, "b": None, None: 5.0}


def test_aggregate_in_two_phases(spark, words):
    got = {r.k: r.m for r in aggregate_by_key(words.repartition(3), ["k"], "n", Mean(), "m", DoubleType()).collect()}
    assert got == {"a": 2.0, "b": None, None: 5.0}


def test_two_phases_with_one_busy_key(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 20000, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    got = {r.k: round(r.m, 6) for r in aggregate_by_key(df, ["k"], "v", Mean(), "m", DoubleType()).collect()}
    wanted = {r.k: round(r.m, 6) for r in df.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    assert got == wanted


def test_table_function(spark, words):
    register(spark, "letters", Letters, "table", "letter string")
    got = spark.sql("SELECT letter FROM words, LATERAL letters(w)").collect()
    assert sorted(r.letter for r in got) == ["q", "x", "y", "z"]


def test_other_kinds_are_refused(spark):
    with pytest.raises(ValueError, match="unknown kind 'window' of Letters"):
        register(spark, "f", Letters(), "window", "string")
    with pytest.raises(ValueError, match="UserAggregate"):
        register(spark, "f", Letters, "aggregate", "string")


def test_functions_and_parameters_belong_to_one_job(cluster):
    one, two = job_session(cluster, {"day": "monday"}), job_session(cluster)

    def same(n: pd.Series) -> pd.Series:
        return n

    register(one, "same", same, "scalar", "long")
    assert one.conf.get("job.day") == "monday"
    assert two.conf.get("job.day", None) is None
    assert one.sql("SELECT same(1L) AS x").first().x == 1
    with pytest.raises(Exception, match="UNRESOLVED_ROUTINE"):
        two.sql("SELECT same(1L)")


def test_aggregate_keeps_large_integer_keys_beside_nulls(spark):
    class Sum(UserAggregate):
        def start(self):
            return 0

        def add(self, state, values):
            return state + int(values.sum())

        def merge(self, state, other):
            return state + other

        def finish(self, state):
            return state

    rows = [(2**53, 1), (2**53 + 1, 2), (None, 4), (2**53, 8), (None, 16)]
    df = spark.createDataFrame(rows, "k bigint, v bigint").repartition(3)
    found = aggregate_by_key(df, ["k"], "v", Sum(), "s", LongType()).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(2**53, 9), (2**53 + 1, 2), (None, 20)], key=repr)


@pytest.mark.parametrize("aggregate", [StreamMean(), MeanOfCents(), Count(), CountAndLargest()], ids=lambda a: type(a).__name__)
def test_many_groups_at_once_get_what_each_gets_alone(aggregate):
    values = pd.Series([1.25, None, 2.5, 7.75, None, -3.0, 2.5])
    groups = np.array([2, 0, 1, 2, 3, 1, 2])
    alone = [aggregate.add(aggregate.start(), values[groups == g]) for g in range(4)]
    assert list(aggregate.add_each(values, groups, 4)) == alone == list(UserAggregate.add_each(aggregate, values, groups, 4))


def test_partial_states_call_an_aggregate_once_for_many_keys(spark):
    class Calls(Mean):
        """How many calls made the states."""

        def add_each(self, values, groups, count):
            return [(1.0 / count, 1)] * count

    found = partial_states(spark.range(5000, numPartitions=1), ["id"], "id", Calls()).collect()
    assert len(found) == 5000 and sum(pickle.loads(r["_state"])[0] for r in found) == pytest.approx(1)


def test_keys_of_all_kinds_meet_once_without_a_call_for_each(spark):
    nan = float("nan")
    data = [(k, t, 1.0) for k in (nan, 0.0, -0.0, 1.5, None) for t in ("a", None, "b")] * 40
    df = spark.createDataFrame(data, "k double, t string, v double").repartition(7)
    means = aggregate_by_key(df, ["k", "t"], "v", Mean(), "m", DoubleType())
    assert "FlatMapGroupsInArrow" not in means._jdf.queryExecution().toString()
    assert sorted(map(repr, means.collect())) == sorted(map(repr, df.groupBy("k", "t").agg({"v": "avg"}).toDF("k", "t", "m").collect()))
    assert aggregate_by_key(df.where("v > 1"), ["k"], "v", Mean(), "m", DoubleType()).count() == 0

"""Plans: what reaches the scan, what is combined before a shuffle, how busy keys are spread."""

import contextlib
import io
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import as_of_join, interval_join, latest_per_key, pv_uv, session, slide, split_by
from tidemark.queries.inputs import EVENTS, table

DAY = timedelta(days=1)
#: What a stream job has written is read back; its plan says nothing of the job.
STREAMED = {n for n in entry.CATALOG if "stream" in n} | {
    "carried_over", "job_overview", "late_rows", "multi_sink", "stopped_and_restored", "topic_undecoded",
}


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df):
    """Operators of the physical plan, outermost first."""
    return re.findall(r"^[\s:+*|-]*([A-Z]\w+(?: \w+)?)", plan(df).split("\n\n")[0], re.M)


@pytest.fixture
def big(spark):
    """Statistics as on a large table: nothing is small enough to broadcast, plans are not adapted."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    return spark


@pytest.mark.parametrize("name", sorted(set(entry.CATALOG) - STREAMED))
def test_no_query_compares_all_pairs_or_gathers_all_rows(cluster, data, name):
    cluster.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cluster.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(entry.queries()[name](cluster, data))
    finally:
        cluster.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        cluster.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name != "agg_global":  # there one row per task is gathered
        assert "SinglePartition" not in text


def test_filters_and_columns_reach_the_scan(big, data):
    text = plan(entry.queries()["filter_in"](big, data))
    assert "PushedFilters: [In(event_type, [purchase,view])]" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    assert "ReadSchema: struct<user_id:bigint,props:string>" in plan(entry.queries()["pv_uv_by_category"](big, data))
    routed = split_by(table(big, data, "events"), "event_type", {"sales": ["purchase"]})
    assert "EqualTo(event_type,purchase)" in plan(routed["sales"].select("event_id"))


def test_visitors_are_combined_before_each_shuffle(big, data):
    ops = tree(pv_uv(table(big, data, "events"), "event_type", "user_id"))
    assert ops.count("Exchange") == 2
    for place in (i for i, op in enumerate(ops) if op == "Exchange"):
        assert ops[place + 1] == "HashAggregate"


def test_newest_rows_are_combined_before_the_shuffle(big, data):
    ops = tree(latest_per_key(table(big, data, "events"), ["user_id"], ["ts", "event_id"]))
    assert ops.count("Exchange") == 1 and "Window" not in ops
    assert ops[ops.index("Exchange") + 1].startswith("SortAggregate")


def test_time_is_part_of_the_shuffle_key(big, data):
    events = table(big, data, "events")
    joined = plan(as_of_join(events.select("event_id", "user_id", "ts"), events, ["user_id"], "ts", "ts", {"v": "value"}))
    windows = re.findall(r"\) Window.*?windowspecdefinition\((.*?), _\w+#\d+L? ASC", joined, re.S)
    assert any("_slice" in w for w in windows)
    assert "ReusedExchange" in joined  # probes and history are matched from one shuffle of each
    pairs = plan(interval_join(events.select("user_id", "ts"), events, ["user_id"], "ts", "ts", DAY, DAY, {"o": "event_id"}))
    assert any("user_id" in keys and "_slot" in keys for keys in re.findall(r"hashpartitioning\((.*?)\)", pairs))


def test_a_busy_key_is_spread_by_time(big):
    rng = random.Random(9)
    start = datetime(2024, 1, 1)
    data = [(7 if rng.random() < 0.6 else rng.randrange(50), start + timedelta(minutes=rng.randrange(90000))) for _ in range(6000)]
    df = big.createDataFrame(data, "user_id bigint, ts timestamp_ntz")
    slots = (
        df.groupBy("user_id", F.window("ts", "1 day")).count().groupBy("user_id").count().where("user_id = 7").first()[1]
    )
    assert slots > 60
    # Sessions: the window over a key sees at most one row per slot of the gap, not one per row.
    found = session(df, "ts", DAY, ["user_id"], {"n": ("count", "*")})
    ops = tree(found)
    assert ops[ops.index("Window"):].count("HashAggregate") == 2
    assert found.agg(F.sum("n")).first()[0] == len(data)


def test_sliding_windows_do_not_copy_rows(big, data):
    ops = tree(slide(table(big, data, "events"), "ts", DAY, DAY / 4, ["event_type"], {"n": ("count", "*")}))
    below = ops[ops.index("Generate"):]
    assert below.count("Exchange") == 1 and "Expand" not in ops


def test_top_rows_are_cut_before_the_shuffle(big, data):
    text = plan(entry.queries()["top_n_per_group"](big, data))
    assert "WindowGroupLimit" in text
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_n"](big, data))
    assert "TakeOrderedAndProject" in plan(entry.queries()["preview_page"](big, data))


def test_schema_is_declared_not_inferred(big, data):
    assert big.read.schema(EVENTS).parquet(f"{data}/events.parquet").schema == table(big, data, "events").schema

"""Operators on hand-made rows and against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import (
    align,
    as_of_join,
    interval_join,
    latest_per_key,
    merge_latest,
    pv_uv,
    pv_uv_running,
    rate_and_gap,
    session,
    slide,
    split_by,
    tumble,
    uv_running,
    view,
    with_route,
    write_routed,
)

T0 = datetime(2024, 1, 1)
LOG = [
    ("u1", "i1", "c1", "pv", T0),
    ("u1", "i2", "c1", "buy", T0 + timedelta(minutes=10)),
    ("u2", "i1", "c1", "pv", T0 + timedelta(minutes=20)),
    ("u2", "i3", "c2", "pv", T0 + timedelta(minutes=65)),
    (None, "i3", "c2", "pv", T0 + timedelta(minutes=66)),
]
LOG_SCHEMA = "user_id string, item_id string, category_id string, behavior string, ts timestamp_ntz"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(LOG, LOG_SCHEMA)


# -- visitors ------------------------------------------------------------------


def test_pv_uv_counts_null_users_as_views_only(log):
    wanted = [("c1", 3, 2), ("c2", 2, 1)]
    assert rows(pv_uv(log, "category_id", "user_id")) == wanted
    assert rows(pv_uv_running(log, "category_id", "user_id")) == wanted
    assert rows(uv_running(log, "category_id", "user_id")) == [("c1", 2), ("c2", 1)]


def test_pv_uv_of_nothing(spark):
    empty = spark.createDataFrame([], LOG_SCHEMA)
    assert rows(pv_uv(empty, "category_id", "user_id")) == []
    assert rows(pv_uv_running(empty, "category_id", "user_id")) == []


def test_pv_uv_one_category_holds_most_rows(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.7 else f"c{rng.randrange(9)}", f"u{rng.randrange(200)}") for _ in range(5000)]
    df = spark.createDataFrame(data, "category_id string, user_id string")
    wanted = sorted(
        (c, sum(x == c for x, _ in data), len({u for x, u in data if x == c})) for c in {c for c, _ in data}
    )
    assert rows(pv_uv(df, "category_id", "user_id")) == wanted
    assert rows(pv_uv_running(df, "category_id", "user_id")) == wanted


def test_retention_needs_a_stream(log):
    with pytest.raises(ValueError, match="stream"):
        pv_uv_running(log, "category_id", "user_id", retention=timedelta(days=1))
    with pytest.raises(ValueError, match="at least"):
        pv_uv_running(log, "category_id", "user_id", retention=(timedelta(days=2), timedelta(days=1)))


# -- views and inserts -----------------------------------------------------------


def test_view_keeps_the_names_of_its_query(spark, log):
    view("cdc", log.select("user_id", "item_id", "category_id", "behavior"))
    assert spark.table("cdc").columns == ["user_id", "item_id", "category_id", "behavior"]


def test_view_names_are_strict_when_given(spark, log):
    view("v", log.select("user_id", "item_id"), ["who", "what"])
    assert spark.table("v").columns == ["who", "what"]
    with pytest.raises(ValueError, match="2 names for 5"):
        view("v", log, ["a", "b"])


def test_align_is_by_position_and_widens(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    fitted = align(df, "n bigint, s string")
    assert fitted.dtypes == [("n", "bigint"), ("s", "string")]
    assert rows(fitted) == [(1, "x")]


def test_align_refuses_other_arity_and_narrowing(spark):
    df = spark.createDataFrame([("x", 2)], "a string, b bigint")
    with pytest.raises(ValueError, match="2 columns into 1"):
        align(df, "a string")
    with pytest.raises(AnalysisException):
        align(df, "a int, b bigint").collect()


# -- routing -----------------------------------------------------------------------

FEED = [("k1", "a", "dbo.A"), ("k2", "b", "dbo.B"), ("k3", "c", "dbo.Z"), ("k4", "d", None)]


def test_each_row_takes_one_route(spark, tmp_path):
    feed = spark.createDataFrame(FEED, "key string, ums string, table string")
    routes = {"A": ["dbo.A"], "B": ["dbo.B"]}
    parts = split_by(feed, "table", routes)
    assert {n: [r.key for r in p.orderBy("key").collect()] for n, p in parts.items()} == {
        "A": ["k1"],
        "B": ["k2"],
        "unrouted": ["k3", "k4"],
    }
    tagged = with_route(feed, "table", routes)
    assert rows(tagged.select("key", "route")) == [("k1", "A"), ("k2", "B"), ("k3", "unrouted"), ("k4", "unrouted")]
    write_routed(feed, "table", routes, str(tmp_path / "routed"))
    back = spark.read.parquet(str(tmp_path / "routed"))
    assert rows(back.where("route = 'B'").select("key")) == [("k2",)]
    assert back.count() == 4


def test_routes_must_not_overlap(spark):
    feed = spark.createDataFrame(FEED, "key string, ums string, table string")
    with pytest.raises(ValueError, match="both"):
        split_by(feed, "table", {"A": ["dbo.A"], "B": ["dbo.A"]})


# -- newest row ----------------------------------------------------------------------


def test_latest_and_merge(spark):
    schema = "k string, n int, v string"
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema)
    new = spark.createDataFrame([("a", 2, None), ("c", 1, "z"), ("a", 0, "late")], schema)
    assert rows(merge_latest(old, new, ["k"], ["n"])) == [("a", 2, None), ("b", 1, "y"), ("c", 1, "z")]
    assert rows(latest_per_key(new, ["k"], ["n"])) == [("a", 2, None), ("c", 1, "z")]


# -- as-of join --------------------------------------------------------------------

PROBE, HISTORY = "id int, k string, t timestamp_ntz", "k string, t timestamp_ntz, v string"


def test_asof_hand_case(spark):
    history = spark.createDataFrame([("x", T0, "v1"), ("x", T0 + timedelta(minutes=30), "v2")], HISTORY)
    at = [T0 - timedelta(minutes=1), T0, T0 + timedelta(minutes=29), T0 + timedelta(minutes=30)]
    probes = spark.createDataFrame([(i, "x", t) for i, t in enumerate(at)], PROBE)
    joined = as_of_join(probes, history, ["k"], "t", "t", {"v": "v"})
    assert [r.v for r in joined.orderBy("id").collect()] == [None, "v1", "v1", "v2"]
    inner = as_of_join(probes, history, ["k"], "t", "t", {"v": "v"}, how="inner")
    assert [r.id for r in inner.orderBy("id").collect()] == [1, 2, 3]


def test_asof_keeps_null_values_and_unmatched_probes(spark):
    history = spark.createDataFrame(
        [("x", T0, "v1"), ("x", T0 + timedelta(hours=5), None), (None, T0, "nokey"), ("x", None, "notime")], HISTORY
    )
    probes = spark.createDataFrame(
        [(0, "x", T0 + timedelta(hours=9)), (1, None, T0), (2, "x", None), (3, "other", T0)], PROBE
    )
    found = as_of_join(probes, history, ["k"], "t", "t", {"v": "v", "since": "t"})
    by_id = {r.id: r for r in found.collect()}
    assert len(by_id) == 4
    assert by_id[0].v is None and by_id[0].since == T0 + timedelta(hours=5)
    assert all(by_id[i].since is None for i in (1, 2, 3))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("width", [timedelta(minutes=7), timedelta(hours=1), timedelta(days=30)])
def test_asof_against_brute_force(spark, kind, width):
    rng = random.Random(3)

    def moment():
        return T0 + timedelta(seconds=rng.randrange(0, 40000), microseconds=rng.choice([0, 1, 500000]))

    def key():
        return "hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}"

    history = [(key(), moment(), f"v{i:04d}") for i in range(300)]
    history += [(k, t, v + "b") for k, t, v in history[:20]]  # two versions at one instant
    probes = [(i, key(), moment()) for i in range(400)]
    probes += [(1000 + i, k, t) for i, (k, t, _) in enumerate(history[:40])]  # exactly at a version
    probes += [(2000 + i, *probes[0][1:]) for i in range(50)]  # many at one instant
    found = as_of_join(
        spark.createDataFrame(probes, PROBE.replace("timestamp_ntz", kind)),
        spark.createDataFrame(history, HISTORY.replace("timestamp_ntz", kind)),
        ["k"], "t", "t", {"v": "v"}, slice_width=width,
    )
    wanted = {}
    for i, k, t in probes:
        before = [(ht, v) for hk, ht, v in history if hk == k and ht <= t]
        wanted[i] = max(before)[1] if before else None
    assert {r.id: r.v for r in found.collect()} == wanted
    assert found.count() == len(probes)


# -- interval join ------------------------------------------------------------------


@pytest.mark.parametrize("before, after", [(0, 60), (30, 0), (45, 90), (0, 0)])
def test_interval_join_against_brute_force(spark, before, after):
    rng = random.Random(5)
    left = [(i, rng.choice("hhha"), T0 + timedelta(seconds=rng.randrange(3000))) for i in range(150)]
    right = [(i, rng.choice("hhhab"), T0 + timedelta(seconds=rng.randrange(3000))) for i in range(150)]
    left.append((999, None, T0))
    right.append((999, None, T0))
    lo, hi = timedelta(seconds=before), timedelta(seconds=after)
    found = interval_join(
        spark.createDataFrame(left, PROBE), spark.createDataFrame(right, PROBE), ["k"], "t", "t", lo, hi, {"rid": "id"}
    )
    wanted = sorted((i, j) for i, k, t in left for j, m, u in right if k and k == m and t - lo <= u <= t + hi)
    assert sorted((r.id, r.rid) for r in found.collect()) == wanted


def test_zone_free_times_ignore_the_session_zone(spark):
    """Around the hours that a summer time zone skips or repeats."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    rng = random.Random(8)
    for night in (datetime(2024, 3, 10), datetime(2024, 11, 3)):
        times = [night + timedelta(minutes=rng.randrange(360)) for _ in range(120)]
        df = spark.createDataFrame([(i, "k", t) for i, t in enumerate(times)], PROBE)
        joined = interval_join(df, df, ["k"], "t", "t", timedelta(minutes=5), timedelta(minutes=9), {"rid": "id"})
        wanted = sorted(
            (i, j)
            for i, t in enumerate(times)
            for j, u in enumerate(times)
            if t - timedelta(minutes=5) <= u <= t + timedelta(minutes=9)
        )
        assert sorted((r.id, r.rid) for r in joined.collect()) == wanted
        history = df.where("id % 3 = 0").selectExpr("k", "t", "t AS v")
        found = as_of_join(df, history, ["k"], "t", "t", {"v": "v"}, slice_width=timedelta(minutes=20))
        versions = [t for i, t in enumerate(times) if i % 3 == 0]
        assert {r.id: r.v for r in found.collect()} == {
            i: max((v for v in versions if v <= t), default=None) for i, t in enumerate(times)
        }
        n = session(df, "t", timedelta(minutes=4), ["k"], COUNT).count()
        ordered = sorted(times)
        assert n == 1 + sum(b - a > timedelta(minutes=4) for a, b in zip(ordered, ordered[1:]))


def test_two_kinds_of_time_are_not_mixed(spark):
    one = spark.createDataFrame([("k", T0)], "k string, t timestamp")
    two = spark.createDataFrame([("k", T0)], "k string, t timestamp_ntz")
    with pytest.raises(ValueError, match="one kind"):
        interval_join(one, two, ["k"], "t", "t", timedelta(0), timedelta(1), {"u": "t"})
    with pytest.raises(ValueError, match="one kind"):
        as_of_join(one, two, ["k"], "t", "t", {"u": "t"})


# -- windows ------------------------------------------------------------------------

COUNT = {"n": ("count", "*")}


def test_tumble_hand_case(log):
    found = tumble(log, "ts", timedelta(hours=1), [], COUNT)
    assert rows(found.select("window_start", "n")) == [(T0, 3), (T0 + timedelta(hours=1), 2)]


def test_slide_panes_equal_plain_windows(spark, log):
    measures = {"n": ("count", "*"), "users": ("count", "user_id"), "first": ("min", "ts")}
    panes = slide(log, "ts", timedelta(hours=1), timedelta(minutes=15), ["category_id"], measures)
    wanted = []
    for c in ("c1", "c2"):
        for k in range(-4, 12):
            start = T0 + timedelta(minutes=15 * k)
            inside = [r for r in LOG if r[2] == c and start <= r[4] < start + timedelta(hours=1)]
            if inside:
                users = sum(r[0] is not None for r in inside)
                end = start + timedelta(hours=1)
                wanted.append((start, end, c, len(inside), users, min(r[4] for r in inside)))
    assert rows(panes) == sorted(wanted, key=repr)
    odd = slide(log, "ts", timedelta(minutes=50), timedelta(minutes=15), [], COUNT)
    assert odd.agg({"n": "sum"}).first()[0] > 5


def test_slide_average_of_parts(spark):
    df = spark.createDataFrame([(T0, 1.0), (T0 + timedelta(minutes=20), 5.0), (T0 + timedelta(minutes=21), None)], "ts timestamp_ntz, v double")
    found = slide(df, "ts", timedelta(minutes=30), timedelta(minutes=10), [], {"mean": ("avg", "v"), "n": ("count", "v")})
    by_start = {r.window_start: (r.mean, r.n) for r in found.collect()}
    assert by_start[T0] == (3.0, 2)
    assert by_start[T0 + timedelta(minutes=20)] == (5.0, 1)


def test_session_merges_up_to_the_gap(spark):
    gap = timedelta(minutes=30)
    times = [T0, T0 + gap, T0 + 2 * gap + timedelta(microseconds=1), T0 + timedelta(hours=9)]
    df = spark.createDataFrame([("a", t) for t in times], "k string, ts timestamp_ntz")
    found = session(df, "ts", gap, ["k"], COUNT)
    assert rows(found.select("session_start", "session_end", "n")) == sorted(
        [
            (T0, T0 + 2 * gap, 2),
            (times[2], times[2] + gap, 1),
            (times[3], times[3] + gap, 1),
        ],
        key=repr,
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_session_equals_sparks_session_window(spark, seed):
    from pyspark.sql import functions as F

    rng = random.Random(seed)
    data = [(rng.choice(["hot", "hot", "b", None]), T0 + timedelta(seconds=rng.randrange(40000)), rng.random()) for _ in range(400)]
    data.append(("b", None, 1.0))
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double")
    measures = {"n": ("count", "*"), "low": ("min", "v"), "high": ("max", "v")}
    found = session(df, "ts", timedelta(minutes=5), ["k"], measures)
    native = df.groupBy(F.session_window("ts", "5 minutes").alias("w"), "k").agg(
        F.count("*"), F.min("v"), F.max("v")
    )
    assert rows(found) == rows(native.select("w.start", "w.end", "k", "count(1)", "min(v)", "max(v)"))


def test_measures_that_do_not_merge_are_refused(log):
    with pytest.raises(ValueError, match="median"):
        slide(log, "ts", timedelta(hours=1), timedelta(minutes=15), [], {"m": ("median", "ts")})


def test_rate_and_gap(log):
    found = rate_and_gap(log, "ts", timedelta(hours=1), [])
    assert rows(found) == sorted(
        [(T0, 3, 3 / 3600, None), (T0 + timedelta(hours=1), 2, 2 / 3600, 45 * 60.0)], key=repr
    )


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(10,2)", "double"])
def test_windows_give_one_type_and_value_whatever_the_algorithm(spark, kind):
    """Sliding windows from parts, of half a second, against Spark's own windows."""
    measures = {"s": ("sum", "v"), "a": ("avg", "v"), "n": ("count", "v"), "x": ("max", "v")}
    df = spark.range(200).selectExpr(
        "'k' AS k", f"CAST(id * 1.25 AS {kind}) AS v", "timestamp_micros(1700000000000000 + id * 130000) AS ts"
    )
    width, step = timedelta(seconds=1), timedelta(milliseconds=500)
    ours = slide(df, "ts", width, step, ["k"], measures)
    own = df.groupBy(F.window("ts", "1 second", "500 milliseconds").alias("w"), "k").agg(F.sum("v").alias("s"), F.avg("v").alias("a"), F.count("v").alias("n"), F.max("v").alias("x"))
    own = own.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "k", "s", "a", "n", "x")
    assert ours.dtypes == own.dtypes
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, own.collect()))
    runs = session(df, "ts", timedelta(milliseconds=100), ["k"], measures)
    assert runs.count() == 200 and runs.select("s", "a").dtypes == own.select("s", "a").dtypes


def test_averages_of_large_whole_numbers_do_not_overflow(spark):
    df = spark.range(4).selectExpr("1 AS k", "9000000000000000000 AS v", "timestamp_seconds(id) AS ts")
    found = slide(df, "ts", timedelta(seconds=10), timedelta(seconds=5), ["k"], {"a": ("avg", "v")})
    assert {r.a for r in found.collect()} == {9e18}

"""Previews of a stream: snapshots, their pages, and what goes with time."""

import pytest
from pyspark.sql import functions as F

import feeds
from test_jobs import settings
from tidemark.plans import Job


def look(tmp_path, query, **more):
    return Job(settings(tmp_path, "look", **more), [feeds.source(tmp_path / "in"), query])


def pages_of(snapshot, size):
    return [[tuple(r) for r in snapshot.page(n, size).collect()] for n in range(1, snapshot.n_pages(size) + 2)]


def test_pages_of_a_moving_result_cover_one_snapshot_once(spark, data, tmp_path):
    parts = feeds.slices(feeds.events(data), 3)
    job = look(tmp_path, "SELECT event_type, user_id % 50 AS k, count(*) AS n FROM events GROUP BY 1, 2")

    def start():
        return job.preview_stream(spark, ["n", "k"], keys=["event_type", "k"], folder=str(tmp_path / "look"))

    wanted, seen = {}, 0
    for number, part in enumerate(parts):
        feeds.add_file(tmp_path / "in", part, number)
        preview = start()
        assert preview.has_ended
        snapshot = preview.snapshot(range_rows=30)
        assert preview.snapshot().number == snapshot.number == number + 1  # no batch has come since
        rows = spark.read.parquet(str(tmp_path / "in")).groupBy("event_type", (F.col("user_id") % 50).alias("k")).count()
        wanted[number] = sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[2], r[1] is not None, r[1], r[0]))
        assert snapshot.n_rows == len(wanted[number]) > seen
        seen = 30
    for number in (2, 3):
        pages = pages_of(preview.get(number), 7)
        assert [r for p in pages for r in p] == wanted[number - 1] and pages[-1] == []
        assert all(len(p) == 7 for p in pages[:-2])
    with pytest.raises(ValueError, match="snapshot 1 is not there"):
        preview.get(1)
    assert not (tmp_path / "look" / "snapshots" / "1").exists()


def test_a_far_page_reads_the_ranges_it_touches(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 2)
    snapshot = look(tmp_path, "SELECT event_id, ts FROM events").preview_stream(spark, ["ts"]).snapshot(range_rows=100)
    last = snapshot.page(snapshot.n_pages(10), 10)
    assert last.collect()[-1].ts == snapshot.rows().agg(F.max("ts")).first()[0]
    assert snapshot.n_rows == feeds.events(data).num_rows and len(snapshot._counts) == -(-snapshot.n_rows // 100)
    assert "_range" in last._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("PushedFilters")[0]
    touched = last.select(F.spark_partition_id()).count()
    assert touched <= 10


def test_equal_rows_do_not_share_one_range(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 2)
    snapshot = look(tmp_path, "SELECT 1 AS one, map('k', 2) AS m FROM events").preview_stream(spark, ["one"]).snapshot(100)
    assert max(snapshot._counts) < 300 and sum(snapshot._counts) == feeds.events(data).num_rows
    assert sum(len(p) for p in pages_of(snapshot, 333)) == snapshot.n_rows


def test_a_result_without_rows(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    preview = look(tmp_path, "SELECT event_id FROM events WHERE event_id < 0").preview_stream(spark, ["event_id"])
    snapshot = preview.snapshot()
    assert (snapshot.n_rows, snapshot.n_pages(5), snapshot.page(1, 5).collect()) == (0, 0, [])
    with pytest.raises(ValueError, match="numbered from 1"):
        snapshot.page(0, 5)


def test_what_cannot_be_looked_at(spark, data, tmp_path):
    feeds.in_files(tmp_path / "in", feeds.events(data), 1)
    with pytest.raises(ValueError, match="not among"):
        look(tmp_path, "SELECT event_id FROM events").preview_stream(spark, ["other"])
    with pytest.raises(Exception, match="(?i)append"):  # a changing result without keys
        look(tmp_path, "SELECT count(*) AS n FROM events", checkpoint=str(tmp_path / "c")).preview_stream(spark, ["n"])

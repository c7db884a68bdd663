"""Messages, sinks in files, database statements."""

import json
from datetime import datetime

import pytest

from tidemark.sources import (
    Table,
    changes,
    decode_json,
    decode_raw,
    encode_json,
    encode_raw,
    jdbc,
    read,
    read_back,
    split_undecoded,
    write,
)
from tidemark.sources.tables import json_topic

LOG = "user_id string, item_id string, category_id string, behavior string, ts timestamp"
GOOD = '{"user_id": "7", "item_id": "1", "category_id": "3", "behavior": "pv", "ts": "2024-01-01T01:00:00Z"}'
BAD = ["not json", '{"user_id": 1', '{"user_id": "7", "ts": "yesterday"}', "[1, 2]", ""]


def messages(spark, texts):
    return spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "value binary")


def test_decode_takes_declared_fields_only(spark):
    text = json.dumps({**json.loads(GOOD), "more": 1})
    row = decode_json(messages(spark, [text]), LOG).first()
    assert tuple(row) == ("7", "1", "3", "pv", datetime(2024, 1, 1, 1))


def test_missing_fields_are_null(spark):
    row = decode_json(messages(spark, ['{"user_id": "7"}']), LOG).first()
    assert row.user_id == "7" and row.ts is None


def test_undecoded_messages_keep_their_text(spark):
    decoded = decode_json(messages(spark, [GOOD, *BAD, None]), LOG, keep_undecoded=True)
    good, bad = split_undecoded(decoded)
    assert [r.user_id for r in good.collect()] == ["7"]
    assert sorted(r.value for r in bad.collect()) == sorted([*BAD, ""])


def test_undecoded_messages_fail_without_a_side_output(spark):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        decode_json(messages(spark, [GOOD, BAD[0]]), LOG).collect()


def test_json_round_trip_keeps_nulls(spark):
    rows = [("a", None, datetime(2024, 1, 1, 5)), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, n int, ts timestamp")
    sent = encode_json(df, key="k")
    assert sent.dtypes == [("key", "binary"), ("value", "binary")]
    assert sorted(map(tuple, decode_json(sent, "k string, n int, ts timestamp").collect()), key=repr) == sorted(rows, key=repr)


def test_raw_round_trip(spark):
    df = spark.createDataFrame([(b"\x00\xff", b"x")], "messageKey binary, message binary")
    back = decode_raw(encode_raw(df), ["messageKey", "message"])
    assert tuple(map(bytes, back.first())) == (b"\x00\xff", b"x")
    with pytest.raises(ValueError, match="binary"):
        encode_raw(spark.createDataFrame([("a", "b")], "a string, b string"))


def test_topic_options():
    topic = json_topic("user_log", LOG, "user_behavior", "broker:1", "group")
    assert dict(topic.options) == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "user_behavior",
        "startingOffsets": "earliest",
        "kafka.group.id": "group",
    }
    assert "broker" not in repr(topic)  # options may hold secrets


def test_table_checks(spark):
    with pytest.raises(ValueError, match="role"):
        Table("t", "a int", "parquet", role="other")
    with pytest.raises(ValueError, match="encoding"):
        Table("t", "a int", "parquet", encoding="xml")
    with pytest.raises(ValueError, match="keys"):
        Table("t", "a int", "parquet", keys=("b",)).fields
    with pytest.raises(ValueError, match="not a sink"):
        write(spark.range(1), Table("t", "a bigint", "parquet"), "w")


def test_table_as_source_and_sink(spark, tmp_path):
    both = Table("t", "k string, n bigint", "parquet", path=str(tmp_path / "t"), role="both")
    write(spark.createDataFrame([("a", 1)], "x string, y int"), both, "w", 0)
    write(spark.createDataFrame([("b", 2)], "x string, y int"), both, "w", 1)
    assert sorted(map(tuple, read_back(spark, both).collect())) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, read(spark, both).collect())) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_file_formats(spark, tmp_path, fmt):
    table = Table("t", "k string, n bigint", fmt, path=str(tmp_path / fmt), role="both")
    write(spark.createDataFrame([("a", 1), ("b", None)], "k string, n bigint"), table, "w")
    assert sorted(map(tuple, read_back(spark, table).collect())) == [("a", 1), ("b", None)]


@pytest.mark.parametrize("encoding, schema", [("json", "k string, n bigint"), ("raw", "k binary, v binary")])
def test_message_sinks(spark, tmp_path, encoding, schema):
    table = Table("t", schema, "parquet", path=str(tmp_path / "m"), encoding=encoding, role="both")
    row = ("a", 1) if encoding == "json" else (b"a", b"1")
    write(spark.createDataFrame([row], schema), table, "w")
    assert tuple(read_back(spark, table).first()) == row
    assert tuple(read(spark, table).first()) == row


# -- keyed files -----------------------------------------------------------------------

PV_UV = "category_id string, pv bigint, uv bigint"


def keyed(tmp_path):
    return Table("pvuv", PV_UV, "parquet", path=str(tmp_path / "pvuv"), keys=("category_id",), role="sink")


def state(spark, table):
    return sorted(map(tuple, read_back(spark, table).collect()))


def test_upsert_and_replay(spark, tmp_path):
    sink = keyed(tmp_path)
    batch0 = spark.createDataFrame([("c1", 1, 1)], PV_UV)
    batch1 = spark.createDataFrame([("c1", 3, 2), ("c2", 2, 1)], PV_UV)
    assert state(spark, sink) == []
    for number, batch in [(0, batch0), (1, batch1), (1, batch1)]:
        write(batch, sink, "run-1", number)
    assert state(spark, sink) == [("c1", 3, 2), ("c2", 2, 1)]


def test_a_later_run_is_newer(spark, tmp_path):
    sink = keyed(tmp_path)
    first, second = changes.new_writer("job"), changes.new_writer("job")
    assert first < second
    write(spark.createDataFrame([("c1", 9, 9)], PV_UV), sink, first, 7)
    write(spark.createDataFrame([("c1", 1, 1)], PV_UV), sink, second, 0)
    assert state(spark, sink) == [("c1", 1, 1)]


def test_snapshot_changes_nothing_but_the_folders_read(spark, tmp_path):
    sink = keyed(tmp_path)
    for number in range(6):
        write(spark.createDataFrame([("c1", number, 0), (f"k{number}", 1, 1)], PV_UV), sink, "run-1", number)
        if number in (1, 3):
            changes.snapshot(spark, sink.path, "parquet", PV_UV, ["category_id"])
    assert changes.newest_snapshot(spark, sink.path).endswith("_snapshots/2")
    wanted = [("c1", 5, 0)] + [(f"k{n}", 1, 1) for n in range(6)]
    assert state(spark, sink) == wanted
    back = read_back(spark, sink)
    assert any("_snapshots/2/rows" in name for name in back.inputFiles())
    assert not any("batch_id=3" in name or "batch_id=0" in name for name in back.inputFiles())


def test_folded_folders_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changes, "SNAPSHOTS_KEPT", 2)
    sink = keyed(tmp_path)
    for number in range(12):
        write(spark.createDataFrame([("c1", number, 1), (f"k{number}", number, 2)], PV_UV), sink, "run-1", number)
        if number % 3 == 2:
            changes.snapshot(spark, sink.path, "parquet", PV_UV, ["category_id"])
    wanted = sorted([("c1", 11, 1)] + [(f"k{n}", n, 2) for n in range(12)])
    assert state(spark, sink) == wanted
    left = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "pvuv" / "writer=run-1").iterdir())
    assert left == [9, 10, 11]
    assert sorted(p.name for p in (tmp_path / "pvuv" / "_snapshots").iterdir() if p.is_dir()) == ["3", "4"]
    assert changes._folded(spark, changes.newest_snapshot(spark, sink.path)) == {"run-1": [[0, 11]]}
    # A run restored to a batch after the oldest kept snapshot finds all it needs; one before it is told.
    changes.note_restore(spark, sink.path, "run-2", "run-1", 9)
    assert state(spark, sink) == sorted([("c1", 9, 1)] + [(f"k{n}", n, 2) for n in range(10)])
    write(spark.createDataFrame([("c1", 50, 9)], PV_UV), sink, "run-2", 0)
    changes.snapshot(spark, sink.path, "parquet", PV_UV, ["category_id"])
    assert ("c1", 50, 9) in state(spark, sink) and ("k11", 11, 2) not in state(spark, sink)
    assert changes._folded(spark, changes.newest_snapshot(spark, sink.path)) == {"run-1": [[0, 9]], "run-2": [[0, 0]]}
    changes.note_restore(spark, sink.path, "run-3", "run-1", 4)
    with pytest.raises(ValueError, match="batches are gone"):
        state(spark, sink)


def test_half_written_batches_are_not_read(spark, tmp_path):
    sink = keyed(tmp_path)
    write(spark.createDataFrame([("c1", 1, 1)], PV_UV), sink, "run-1", 0)
    write(spark.createDataFrame([("c1", 2, 2)], PV_UV), sink, "run-1", 1)
    (tmp_path / "pvuv" / "writer=run-1" / "batch_id=1" / "_SUCCESS").unlink()
    assert state(spark, sink) == [("c1", 1, 1)]


def test_order_within_a_batch(spark, tmp_path):
    sink = Table("t", "k string, n bigint", "parquet", path=str(tmp_path / "t"), keys=("k",), order=("n",), role="sink")
    write(spark.createDataFrame([("a", 1), ("a", 3), ("a", 2)], "k string, n bigint"), sink, "run", 0)
    assert state(spark, sink) == [("a", 3)]


# -- databases: no database runs here, so statements and call order are checked ---------


class Prepared:
    def __init__(self, connection, text):
        self.connection, self.text, self.values = connection, text, {}

    def setString(self, place, value):
        self.values[place] = value

    def setLong(self, place, value):
        self.values[place] = value

    def executeUpdate(self):
        if self.connection.fail_on and self.connection.fail_on in self.text:
            raise RuntimeError("refused")
        self.connection.log.append((self.text, self.values))

    def executeQuery(self):
        return Rows(self.connection.noted)

    def close(self):
        pass


class Rows:
    def __init__(self, noted):
        self.left = [] if noted is None else [noted]

    def next(self):
        return bool(self.left)

    def getLong(self, place):
        return self.left.pop()


class Connection:
    def __init__(self, noted=None, fail_on=None):
        self.noted, self.fail_on, self.log, self.ends = noted, fail_on, [], []

    def prepareStatement(self, text):
        return Prepared(self, text)

    def setAutoCommit(self, value):
        self.ends.append(f"auto={value}")

    def commit(self):
        self.ends.append("commit")

    def rollback(self):
        self.ends.append("rollback")

    def close(self):
        self.ends.append("close")


def test_upsert_statements():
    got = jdbc.upsert_statements("s.t", "s.t_staging", "s.t_batches", ["k", "n"], ["k"])
    assert got == [
        'DELETE FROM "s"."t" WHERE EXISTS (SELECT 1 FROM "s"."t_staging" WHERE "s"."t_staging"."k" = "s"."t"."k")',
        'INSERT INTO "s"."t" ("k", "n") SELECT "k", "n" FROM (SELECT "k", "n", '
        'ROW_NUMBER() OVER (PARTITION BY "_row" ORDER BY "_row") AS "_copy" FROM "s"."t_staging") staged WHERE "_copy" = 1',
        'DELETE FROM "s"."t_batches" WHERE "writer" = ?',
        'INSERT INTO "s"."t_batches" ("writer", "batch_id") VALUES (?, ?)',
    ]
    assert jdbc.quoted('a"b') == '"a""b"'
    assert jdbc.quoting("jdbc:mysql://h/db")("s.t") == "`s`.`t`"
    assert jdbc.quoting("jdbc:postgresql://h/db")("s.t") == '"s"."t"'
    with pytest.raises(ValueError, match="keys"):
        jdbc.upsert_statements("t", "s", "l", ["k"], [])


def test_move_is_one_transaction():
    statements = jdbc.upsert_statements("t", "t_s", "t_b", ["k"], ["k"])
    good = Connection()
    jdbc.move(good, statements, "job", 4)
    assert good.ends == ["auto=False", "commit"]
    assert [v for _, v in good.log] == [{}, {}, {1: "job"}, {1: "job", 2: 4}]
    bad = Connection(fail_on="INSERT INTO \"t\"")
    with pytest.raises(RuntimeError):
        jdbc.move(bad, statements, "job", 4)
    assert bad.ends == ["auto=False", "rollback"]


def test_a_noted_batch_is_skipped(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    options = {"url": "jdbc:none", "dbtable": "t"}
    noted = Connection(noted=4)
    assert jdbc.last_batch(noted, "t_batches", "job") == 4
    assert jdbc.last_batch(Connection(), "t_batches", "job") == -1
    assert jdbc.upsert(df, options, ["k"], [], "job", 4, connect=lambda *_: noted) is False
    assert [text for text, _ in noted.log] == [f'DROP TABLE IF EXISTS "{jdbc.staging_name("t", "job", 4)}"']


class Database(Connection):
    """Holds what its transactions have taken over from staging tables; a test may refuse a statement."""

    def __init__(self):
        super().__init__()
        self.staged, self.rows, self.ledger = {}, [], {}

    def commit(self):
        for text, values in self.log:
            if text.startswith("INSERT INTO `t`"):
                (staging,) = [name for name in self.staged if f"`{name}`" in text]
                assert "PARTITION BY `_row`" in text
                self.rows += [row for _, row in sorted(dict(self.staged[staging]).items())]
            elif text.startswith("INSERT INTO `seen`"):
                self.ledger[values[1]] = values[2]
            elif text.startswith("DROP TABLE"):
                self.staged.pop(text.split("`")[1], None)
        self.log = []
        super().commit()

    def rollback(self):
        self.log = []
        super().rollback()

    def prepareStatement(self, text):
        made = super().prepareStatement(text)
        if text.startswith("SELECT"):
            made.executeQuery = lambda: Rows(self.ledger.get(made.values[1]))
        return made

    def fill(self, df, options):
        """Every task is run twice, and both times its rows are staged."""
        rows = [tuple(r) for r in df.collect()]
        self.staged[options["dbtable"]] = list(enumerate(rows)) * 2


def test_a_batch_is_appended_once(spark):
    database = Database()
    options = {"url": "jdbc:mysql://h/db", "dbtable": "t"}
    batches = [spark.createDataFrame([("a", n), ("a", n)], "k string, n int") for n in range(3)]

    def add(number, writer="job"):
        return jdbc.append_once(batches[number], options, "seen", writer, number, lambda *_: database, database.fill)

    assert add(0) is True and database.rows == [("a", 0)] * 2
    for refused in ("INSERT INTO `t`", "INSERT INTO `seen`"):  # the batch is taken back whole
        database.fail_on = refused
        with pytest.raises(RuntimeError):
            add(1)
        assert database.rows == [("a", 0)] * 2 and database.ledger == {"job": 0}
    database.fail_on = "DROP"  # after the transaction: the replay is skipped and drops what is left
    with pytest.raises(RuntimeError):
        add(1)
    assert len(database.rows) == 4 and len(database.staged) == 1
    database.fail_on = None
    assert add(1) is False and add(0) is False and database.staged == {}
    assert add(1, "other") is True and add(2) is True
    assert sorted(database.rows) == sorted([("a", 0), ("a", 1), ("a", 1), ("a", 2)] * 2)


def test_staged_rows_are_numbered(spark, monkeypatch):
    """What goes to a staging table has a number of its own for each row; the folder between is removed."""
    seen, folders = [], []
    make = jdbc.shared_dir
    monkeypatch.setattr(jdbc, "shared_dir", lambda *a: folders.append(make(*a)) or folders[-1])
    monkeypatch.setattr(type(spark.range(1).write), "save", lambda self, *a: seen.extend(self._df.collect()))
    jdbc._fill(spark.range(0, 1000, 1, 7).selectExpr("id % 10 AS k"), {"url": "jdbc:none", "dbtable": "s"})
    assert len(seen) == 1000 == len({r._row for r in seen})
    assert not jdbc.files.exists(spark, folders[0])


def test_staging_tables_are_apart():
    names = {jdbc.staging_name("s.t", writer, batch) for writer in ("a", "b") for batch in (1, 2)}
    assert len(names) == 4 and all(name.startswith("s.t_staging_") for name in names)


def test_database_options():
    with pytest.raises(ValueError, match="dbtable"):
        jdbc._plain({"url": "jdbc:none"})
    assert jdbc._plain({"url": "u", "dbtable": "t"})["batchsize"] == "5000"
    assert jdbc._plain({"url": "u", "dbtable": "t", "batchsize": "1"})["batchsize"] == "1"


def test_two_writers_of_a_keyed_sink(spark, tmp_path):
    """Rows that an older run writes after a newer run's snapshot count; order columns decide before labels."""
    sink = Table("s", "k string, v int", "parquet", path=str(tmp_path / "s"), keys=("k",), order=("v",), role="sink")
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v int")
    write(frame(("x", 1)), sink, "2-old", 0)
    write(frame(("x", 2)), sink, "3-new", 0)
    changes.snapshot(spark, sink.path, "parquet", sink.fields, ["k"], ["v"])
    write(frame(("x", 3), ("z", 1)), sink, "2-old", 1)
    assert sorted(map(tuple, read_back(spark, sink).collect())) == [("x", 3), ("z", 1)]
    changes.snapshot(spark, sink.path, "parquet", sink.fields, ["k"], ["v"])
    assert sorted(map(tuple, read_back(spark, sink).collect())) == [("x", 3), ("z", 1)]


def test_microseconds_survive_and_blank_messages_fail(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456' AS t, timestamp_ntz'2024-01-01 00:00:00.000001' AS n")
    schema = "t timestamp, n timestamp_ntz"
    assert decode_json(encode_json(df), schema).exceptAll(df).isEmpty()
    for message in (None, "", " \n"):
        with pytest.raises(Exception, match="blank"):
            decode_json(spark.createDataFrame([(message,)], "value string"), "k string").collect()

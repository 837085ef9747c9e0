"""Partitioned message log, versioned keyed table, per-row sink."""

import datetime as dt
import json
import os
import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cabstat.session import scratch_path
from cabstat.streaming import job as J
from cabstat.streaming.message_log import MessageLog, append_messages, log_feed, read_log, run_until_caught_up
from cabstat.streaming.row_sink import (
    EpochRows, PartitionRows, RowWriter, read_epoch_rows, read_partition_rows, row_sink, start_rows)
from cabstat.streaming.sinks import KeyedUpsertSink, read_keyed_table
from cabstat.streaming.store import Folder
from cabstat.streaming.versioned import VersionedTable

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers do not import tests

T0 = dt.datetime(2024, 1, 1, 10)
MESSAGES = "body BINARY, partitionKey STRING, enqueuedTime TIMESTAMP"


# ------------------------------------------------------------------ shared files

def test_one_of_many_callers_takes_a_name(tmp_path):
    folder, won = Folder(str(tmp_path)), []
    def take(k):
        if folder.put_if_absent("log/1.json", str(k).encode()):
            won.append(k)
    threads = [threading.Thread(target=take, args=(k,)) for k in range(20)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(won) == 1 and folder.read("log/1.json") == str(won[0]).encode()
    assert folder.names("log") == ["1.json"] and folder.read("log/2.json") is None and folder.names("none") == []
    assert Folder(f"file:{tmp_path}").exists("log/1.json")


# ------------------------------------------------------------------ message log

def messages(spark, ids, keys=5):
    rows = [(bytearray(str(k).encode()), None if k % 7 == 0 else f"key{k % keys}", T0 + dt.timedelta(seconds=k)) for k in ids]
    return spark.createDataFrame(rows, MESSAGES)


def consume(spark, path, group, ckpt=None, starting="earliest", most=None):
    """Message numbers by micro-batch, and the checkpoint."""
    out, ckpt = scratch_path(spark, "log-out"), ckpt or scratch_path(spark, "log-ck")
    d = log_feed(spark, path, group, starting, most)
    q = J.start(d.select(F.col("body").cast("string").cast("int").alias("n"), "partition", "offset"), f"log_{out[-12:]}", ckpt,
                sink=lambda rows, _: rows.write.mode("append").parquet(out), available_now=False)
    run_until_caught_up(q, (path, group))
    rows = spark.read.schema("n INT, partition INT, offset BIGINT").parquet(out).collect() if os.path.isdir(out) else []
    return rows, [p.numInputRows for p in q.recentProgress if p.numInputRows], ckpt


def test_offsets_are_dense_and_keys_keep_their_order(spark):
    path = scratch_path(spark, "log")
    append_messages(messages(spark, range(100)), path, 3)
    append_messages(messages(spark, range(100, 150)), path, 3)
    rows = read_log(spark, path).collect()
    assert sorted(int(r["body"]) for r in rows) == list(range(150))
    ends = MessageLog(path).ends()
    assert {r["partition"] for r in rows} == set(map(int, ends)) and sum(ends.values()) == 150
    for p, end in ends.items():
        own = sorted((r["offset"], int(r["body"]), r["partitionKey"]) for r in rows if r["partition"] == int(p))
        assert [o for o, _, _ in own] == list(range(end))
        for key in {k for _, _, k in own if k}:
            numbers = [n for _, n, k in own if k == key]
            assert numbers == sorted(numbers)
    assert len({(r["partitionKey"], r["partition"]) for r in rows if r["partitionKey"]}) == 5   # a key has one partition
    assert not MessageLog(path).folder.names("_staged")


def test_groups_are_independent_and_restarts_go_on_exactly(spark):
    path = scratch_path(spark, "log")
    append_messages(messages(spark, range(90)), path, 3)
    first, sizes, ckpt = consume(spark, path, "a", most=10)
    assert sorted(r["n"] for r in first) == list(range(90))
    assert len(sizes) >= 3 and max(sizes) <= 30                       # ten a partition and trigger
    other, sizes, _ = consume(spark, path, "b")
    assert sorted(r["n"] for r in other) == list(range(90)) and len(sizes) == 1
    append_messages(messages(spark, range(90, 120)), path, 3)
    again, sizes, _ = consume(spark, path, "a", ckpt, most=10)         # same checkpoint: only what is new
    assert sorted(r["n"] for r in again) == list(range(90, 120)) and max(sizes) <= 30
    assert MessageLog(path).group("b")["handed"] != MessageLog(path).group("a")["handed"]


def test_starting_positions(spark):
    path = scratch_path(spark, "log")
    append_messages(messages(spark, range(40)), path, 2)
    _, _, ckpt = consume(spark, path, "g")
    append_messages(messages(spark, range(40, 60)), path, 2)
    consume(spark, path, "g", ckpt)                                    # starting this batch finished the first
    stored, _, _ = consume(spark, path, "g", starting="stored")        # a new query without the checkpoint
    assert sorted(r["n"] for r in stored) == list(range(40, 60))
    latest, _, ckpt = consume(spark, path, "new", starting="latest")
    assert latest == []
    append_messages(messages(spark, range(60, 70)), path, 2)
    assert sorted(r["n"] for r in consume(spark, path, "new", ckpt, "latest")[0]) == list(range(60, 70))
    with pytest.raises(Exception, match="startingPosition"):
        consume(spark, path, "g", starting="middle")


def test_segments_cut_files_at_offsets(spark):
    path = scratch_path(spark, "log")
    for k in range(3):
        append_messages(messages(spark, range(10 * k, 10 * k + 10)), path, 1)
    log = MessageLog(path)
    parts = log.segments({"0": 5}, {"0": 22})
    assert [(s.start, s.end) for s in parts] == [(5, 10), (10, 20), (20, 22)]
    assert [o for s in parts for b in log.read(s) for o in b.column("offset").to_pylist()] == list(range(5, 22))
    assert log.segments({"0": 22}, {"0": 22}) == []


def test_an_empty_log_waits(spark):
    path = scratch_path(spark, "log")
    append_messages(messages(spark, [1]).limit(0), path, 2)
    assert read_log(spark, path).count() == 0
    assert consume(spark, path, "g")[0] == []


# ------------------------------------------------------------------ versioned table

def batch(spark, pairs, extra=0):
    return spark.createDataFrame([(k, v, v * 2.0 + extra) for k, v in pairs], "k STRING, v INT, w DOUBLE")


def held(t, version=None):
    return {r["k"]: r["v"] for r in t.read(version).collect()}


def test_versions_replays_and_ties(spark):
    t = VersionedTable(spark, scratch_path(spark, "vt"), ["k"], n_buckets=4)
    with pytest.raises(ValueError, match="no version"):
        t.read()
    one = t.merge(batch(spark, [("a", 1), (None, 2), ("b", 3)]), "w", 0)
    assert one.version == 1 and held(t) == {"a": 1, None: 2, "b": 3}
    assert t.merge(batch(spark, [("a", 9)]), "w", 0) is None          # batch 0 again: known
    # inside a batch the greatest order column wins, then the greatest row
    t.merge(batch(spark, [("a", 5), ("a", 7), ("a", 6), (None, 4)]), "w", 1, ["v"])
    assert held(t) == {"a": 7, None: 4, "b": 3}
    tie = batch(spark, [("b", 1)]).union(batch(spark, [("b", 1)], 5)).union(batch(spark, [("b", 1)], 3))
    t.merge(tie, "w", 2, ["v"])
    assert t.read().filter("k = 'b'").first()["w"] == 7.0
    t.merge(batch(spark, [("a", 0)]), "other", 0)                      # the table's row gives way, however great
    assert held(t) == {"a": 0, None: 4, "b": 1}
    assert held(t, 1) == {"a": 1, None: 2, "b": 3} and held(t, 2) == {"a": 7, None: 4, "b": 3}
    assert t.merge(batch(spark, []), "w", 3).version == 5 and held(t, 5) == held(t, 4)
    with pytest.raises(ValueError, match="do not match"):
        t.merge(spark.range(1), "w", 4)


def test_a_batch_costs_what_it_touches(spark):
    """100 batches: each rewrites the buckets of its keys and nothing else."""
    path = scratch_path(spark, "vt-cost")
    t = VersionedTable(spark, path, ["k"], n_buckets=32)
    t.merge(batch(spark, [(f"k{k}", 0) for k in range(2000)]), "w", 0)
    before, want = t.latest(), {f"k{k}": 0 for k in range(2000)}
    for b in range(1, 101):
        keys = [f"k{(b * 37 + j) % 2000}" for j in range(1 + b % 2)]
        made = t.merge(batch(spark, [(k, b) for k in keys]), "w", b)
        assert 1 <= len(made.touched) <= len(keys)
        changed = {x for x in made.buckets if made.buckets[x] != before.buckets[x]}
        assert changed == set(map(str, made.touched))
        folder = next(iter(made.buckets[str(made.touched[0])].split("/")))
        written = sum(f.endswith(".parquet") for _, _, names in os.walk(f"{path}/data/{folder}") for f in names)
        assert written == len(made.touched)
        want.update((k, b) for k in keys)
        before = made
    assert held(t) == want and before.version == 101
    gone = t.vacuum(keep=3)
    assert gone > 0 and held(t) == want and held(VersionedTable(spark, path), 99)
    with pytest.raises(ValueError):
        t.at(90)
    assert VersionedTable(spark, path).latest().version == 101
    assert t.rebucket(5).n_buckets == 5 and held(t) == want
    t.merge(batch(spark, [("k1", -1)]), "w", 101)
    assert held(t) == want | {"k1": -1}


def test_two_writers_cannot_make_the_same_version(spark, monkeypatch):
    path = scratch_path(spark, "vt-race")
    VersionedTable(spark, path, ["k"], n_buckets=8).merge(batch(spark, [(f"k{k}", 0) for k in range(50)]), "start", 0)
    one, two = (VersionedTable(spark, path) for _ in range(2))
    rewrites, publish = [], VersionedTable._publish
    rewrite = VersionedTable._rewrite
    monkeypatch.setattr(VersionedTable, "_rewrite", lambda self, *a: rewrites.append(self) or rewrite(self, *a))

    def late(self, made):
        """Before ``one`` publishes, ``two`` merges something."""
        if self is one and pending:
            two.merge(pending.pop(), "two", made.version)
        return publish(self, made)

    monkeypatch.setattr(VersionedTable, "_publish", late)
    pending = [batch(spark, [("k1", 20)])]
    same = one.merge(batch(spark, [("k1", 10)]), "one", 0)             # same bucket: merged again on top
    assert same.version == 3 and rewrites.count(one) == 2 and held(one)["k1"] == 10 and held(one, 2)["k1"] == 20
    bucket = {r["k"]: r["b"] for r in batch(spark, [(f"k{k}", 0) for k in range(50)]).select(
        "k", one._bucket(["k"], 8).alias("b")).collect()}
    other = next(k for k in bucket if bucket[k] != bucket["k1"])
    pending, rewrites[:] = [batch(spark, [(other, 30)])], []
    apart = one.merge(batch(spark, [("k1", 11)]), "one", 1)            # other buckets: the folders made stay
    assert apart.version == 5 and rewrites.count(one) == 1
    assert held(one)["k1"] == 11 and held(one)[other] == 30
    assert sorted(n for n in one.folder.names("log")) == [f"{v:020d}.json" for v in range(1, 6)]


def test_readers_see_whole_versions(spark):
    """Merges that set every key to one value, read meanwhile: never two values at once."""
    path = scratch_path(spark, "vt-read")
    keys = [f"k{k}" for k in range(40)]
    VersionedTable(spark, path, ["k"], n_buckets=8).merge(batch(spark, [(k, 0) for k in keys]), "w", 0)
    seen, stop = [], threading.Event()

    def look():
        mine = VersionedTable(spark, path)
        while not stop.is_set():
            seen.append(held(mine))
    reader = threading.Thread(target=look)
    reader.start()
    for b in range(1, 6):
        VersionedTable(spark, path).merge(batch(spark, [(k, b) for k in keys]), "w", b)
    stop.set()
    reader.join()
    assert seen and all(set(s) == set(keys) and len(set(s.values())) == 1 for s in seen)


def test_upsert_sink_in_a_stream(spark):
    src, path, ckpt = (scratch_path(spark, x) for x in ("us-src", "us-table", "us-ck"))
    schema = "k STRING, v INT, w DOUBLE"

    def run(ckpt):
        d = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        J.run_to_end(J.start(d, f"us_{scratch_path(spark, 'x')[-12:]}", ckpt, sink=KeyedUpsertSink(path, ["k"], n_buckets=4)))

    batch(spark, [("a", 1), ("b", 1)]).coalesce(1).write.mode("append").parquet(src)
    run(ckpt)
    batch(spark, [("a", 2)]).coalesce(1).write.mode("append").parquet(src)
    run(ckpt)
    got = read_keyed_table(spark, path)
    assert {r["k"]: r["v"] for r in got.collect()} == {"a": 2, "b": 1}
    log = VersionedTable(spark, path).latest()
    assert log.version == 2 and list(log.writers.values()) == [1]     # one query, its second batch
    run(scratch_path(spark, "us-ck2"))                                 # a new checkpoint is another writer
    assert len(VersionedTable(spark, path).latest().writers) == 2
    assert {r["k"] for r in read_keyed_table(spark, path).collect()} == {"a", "b"}


# ------------------------------------------------------------------ per-row sink

WIDE = "s TIMESTAMP_NTZ, e TIMESTAMP_NTZ, n STRING, c BIGINT, f DOUBLE, t DOUBLE, a DOUBLE, b DOUBLE"


def test_columns_go_by_position(spark):
    wide = spark.createDataFrame([(T0, T0 + dt.timedelta(hours=1), "Sq", 3, 30.0, 3.0, 10.0, 1.0)], WIDE)
    for row in (wide.first(), wide.select("n", "e", "c", "f", "t", "a", "b").first()):
        d = scratch_path(spark, "pos")
        w = PartitionRows(d)
        assert w.open(0, 7)
        w.process(row)
        assert not os.path.isdir(d + "/epoch=7")
        w.close(None)
        got = read_partition_rows(spark, d).first()
        assert (got["neighborhood"], got["window_end"], got["number_of_rides"]) == ("Sq", T0 + dt.timedelta(hours=1), 3)
        assert not PartitionRows(d).open(0, 7) and PartitionRows(d).open(1, 7) and PartitionRows(d).open(0, 8)


class Recorder(RowWriter):
    """Writes what is called, when, to files of its own."""

    def __init__(self, directory):
        self.folder, self.calls = Folder(directory), []

    def open(self, partition_id, epoch_id):
        self.calls = [["open", partition_id, epoch_id]]
        return epoch_id != 1

    def process(self, row):
        self.calls.append(["process", row["v"]])
        if row["v"] == 666:
            raise ValueError("bad row")

    def close(self, error):
        self.calls.append(["close", None if error is None else str(error)])
        name = "-".join(map(str, self.calls[0][1:]))
        self.folder.put_if_absent(f"calls/{name}.json", json.dumps(self.calls).encode())

    def result(self):
        return len(self.calls) - 2

    def commit(self, epoch_id, results):
        self.folder.put_if_absent(f"commits/{epoch_id}.json", json.dumps(results).encode())

    def abort(self, epoch_id, results):
        self.folder.put_if_absent(f"aborts/{epoch_id}.json", json.dumps(results).encode())


def feed(spark, src, files):
    for values in files:
        spark.createDataFrame([(v,) for v in values], "v INT").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)     # files are taken by modification time
    return spark.readStream.schema("v INT").option("maxFilesPerTrigger", 1).parquet(src)


@pytest.mark.parametrize("through", ["foreach", "source"])
def test_three_methods_run_per_partition_and_epoch(spark, through):
    out, src = scratch_path(spark, "rec"), scratch_path(spark, "rec-src")
    d, writer = feed(spark, src, [[1, 2, 3], [4], [5]]), Recorder(out)
    if through == "foreach":
        J.run_to_end(start_rows(d, writer, f"rec_{out[-12:]}", scratch_path(spark, "rec-ck")))
    else:
        J.run_to_end(J.start(d, f"rec_{out[-12:]}", scratch_path(spark, "rec-ck"), fmt=row_sink(spark, writer, "recorder")))
    calls = {n: writer.folder.read_json(f"calls/{n}") for n in writer.folder.names("calls")}
    rows = {c[0][2]: c for c in calls.values()}
    assert rows[0] == [["open", 0, 0], ["process", 1], ["process", 2], ["process", 3], ["close", None]]
    assert rows[2] == [["open", 0, 2], ["process", 5], ["close", None]]
    assert not any(x[0] == "process" for x in rows.get(1, []))         # refused
    if through == "source":
        assert [writer.folder.read_json(f"commits/{e}.json") for e in (0, 2)] == [[3], [1]]


def test_a_failed_epoch_shows_no_row_and_runs_again(spark):
    """The source dies on a bad row after good ones; a restart with a mended writer shows each row once."""
    out, src, ckpt = (scratch_path(spark, x) for x in ("fail", "fail-src", "fail-ck"))
    d = feed(spark, src, [[1, 2], [3, 666]])

    class Rows(EpochRows):
        def process(self, row):
            super().process(row)
            if row["v"] == 666 and not self.folder.exists("mended"):
                raise ValueError("bad row")

    writer = Rows(out, ["v"], [0])
    with pytest.raises(Exception, match="bad row"):
        J.run_to_end(J.start(d, "fail1", ckpt, fmt=row_sink(spark, writer, "fail_rows")))
    assert [r["v"] for r in read_epoch_rows(spark, out, "v INT").collect()] in ([1, 2], [2, 1])
    writer.folder.put_if_absent("mended", b"")
    d = spark.readStream.schema("v INT").option("maxFilesPerTrigger", 1).parquet(src)
    J.run_to_end(J.start(d, "fail2", ckpt, fmt="fail_rows"))
    assert sorted(r["v"] for r in read_epoch_rows(spark, out, "v INT").collect()) == [1, 2, 3, 666]


def test_a_replayed_epoch_is_refused(spark):
    out = scratch_path(spark, "replay")
    for _ in range(2):
        w = EpochRows(out, ["v"], [0])
        if w.open(0, 0):
            w.process((1,))
            w.close(None)
            w.commit(0, [w.result(), None])
    w = EpochRows(out, ["v"], [0])
    assert w.open(0, 1)
    w.process((2,))
    w.close(None)
    late = w.result()
    assert read_epoch_rows(spark, out, "v INT").count() == 1           # closed, not committed
    w.commit(0, [late])                                                # epoch 0 was committed by another run
    assert not w.folder.exists(late[0])
    assert [r["v"] for r in read_epoch_rows(spark, out, "v INT").collect()] == [1]
    assert read_epoch_rows(spark, scratch_path(spark, "never"), "v INT").count() == 0
    with_error = EpochRows(out, ["v"], [0])
    assert with_error.open(3, 9)
    with_error.process((1,))
    with_error.close(ValueError("x"))
    assert not with_error.folder.exists(with_error.staged)


def test_a_log_partition_is_written_by_several_tasks_in_order(spark, monkeypatch):
    """A task's share of a partition is bounded; files follow each other in time, also messages of one time and key."""
    from cabstat.streaming import message_log as L

    monkeypatch.setattr(L, "FILE_ROWS", 100)
    rows = spark.range(3_000).selectExpr(
        "cast(concat('m', lpad(id, 5, '0')) as binary) AS body", "if(id % 11 = 0, null, concat('k', id % 7)) AS partitionKey",
        "if(id % 13 = 0, null, timestamp_seconds(1700000000 + (id * 37) % 500)) AS enqueuedTime")
    path = scratch_path(spark, "stretches")
    for _ in range(2):      # a second batch goes behind the first
        L.append_messages(rows, path, 2)
    log = L.MessageLog(path)
    files = {p: log.files(p) for p in log.partitions()}
    assert sum(map(len, files.values())) >= 40
    for p, own in files.items():
        assert max(last - first + 1 for first, last, _ in own) <= 600
        assert [first for first, _, _ in own] == [0, *[last + 1 for _, last, _ in own[:-1]]]
    got = L.read_log(spark, path).orderBy("partition", "offset").collect()
    assert sorted(bytes(r["body"]) for r in got) == sorted(2 * [bytes(r["body"]) for r in rows.collect()])
    for p in files:
        own = [r for r in got if r["partition"] == p]
        assert [r["offset"] for r in own] == list(range(len(own)))
        order = [(r["enqueuedTime"] is not None, str(r["enqueuedTime"]), r["partitionKey"] or "", bytes(r["body"])) for r in own]
        half = len(own) // 2
        assert order[:half] == sorted(order[:half]) == order[half:]

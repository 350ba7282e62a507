import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.streaming import changes as ch
from daymill.streaming import events as ev
from daymill.streaming import topics
from daymill.streaming.defaults import run_with_restarts, stream_defaults


def lines(folder, name, items):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        f.write("\n".join(i if isinstance(i, str) else json.dumps(i) for i in items) + "\n")


def text_stream(spark, folder):
    return spark.readStream.schema("value string").text(str(folder))


def drain(writer):
    writer.start().awaitTermination()


BUCKETS = [
    ({"t": 1704067200}, "20240101"),
    ({"t": 1704067200000}, "20240101"),
    ({"t": "1704153600000"}, "20240102"),
    ({"x": 1}, "19700101"),
    ({"t": "soon"}, "error_bucket"),
    ("not json", "error_bucket"),
    ("", "error_bucket"),
]


def test_day_bucket(spark):
    for item, want in BUCKETS:
        text = item if isinstance(item, str) else json.dumps(item)
        df = spark.createDataFrame([(text,)], "value string")
        assert df.select(ev.day_bucket("value", "t").alias("d")).first()["d"] == want, item


def test_daily_folders_hold_each_record_once_after_a_restart(spark, tmp_path, rows):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    for part in range(2):
        lines(source, f"f{part}", [i for i, _ in BUCKETS[:6]])
        drain(ev.daily_bucket_sink(text_stream(spark, source), "value", "t", out, check, drain=True))
    got = {d[4:]: spark.read.text(f"{out}/{d}").count() for d in os.listdir(out) if d.startswith("day=")}
    assert got == {"20240101": 4, "20240102": 2, "19700101": 2, "error_bucket": 4}


def test_event_time_splits_dirty_records(spark, tmp_path):
    good, dirty = ev.split_by_time(
        spark.createDataFrame([('{"b": 1, "a": 1704067200}',), ('{"b": 1704067200}',), ("x",), ('{"a": "y"}',)], "v string"),
        "v", ["a", "b"], "seconds",
    )
    assert good.count() == 2 and dirty.count() == 2
    assert str(good.first()["event_time"]) == "2024-01-01 00:00:00"


def test_watermark_drops_only_what_is_too_late(spark, tmp_path, rows):
    source, check = tmp_path / "in", str(tmp_path / "check")
    base = 1704067200000
    source.mkdir()
    good, _ = ev.event_time(text_stream(spark, source), "value", ["t"], delay_seconds=10)
    counted = good.groupBy(F.window("event_time", "5 seconds")).count().select("window.start", "count")
    out = str(tmp_path / "out")
    for n, offsets in enumerate([[0, 60], [52, 1], [300]]):  # 1 s is far behind the 60 s seen before
        lines(source, f"f{n}", [{"t": base + s * 1000} for s in offsets])
        drain(stream_defaults(counted.writeStream.format("parquet").option("path", out).outputMode("append"), check, True))
    stored = spark.read.schema("start timestamp, count long").parquet(out)
    assert rows(stored.select(F.unix_timestamp("start") - base // 1000, "count")) == [(0, 1), (50, 1), (60, 1)]


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def change(op, pos, before=None, after=None):
    image = lambda r: None if r is None else {"id": r[0], "v": r[1]}
    return {"before": image(before), "after": image(after), "op": op, "pos": pos, "ts_ms": pos}


def test_change_feed_over_batches(spark, tmp_path, rows):
    source, path, check = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "check")
    batches = [
        [change("r", 1, after=(1, "a")), change("r", 2, after=(2, "b")), change("r", 3, after=(3, "c"))],
        [change("d", 9, before=(2, "b")), change("u", 8, (1, "a"), (1, "a2"))],
        [change("u", 5, (2, "b"), (2, "late")), change("u", 6, (1, "a"), (1, "late")), change("c", 10, after=(4, "d"))],
    ]
    for n, batch in enumerate(batches):
        lines(source, f"f{n}", batch)
        drain(ch.apply_changes(text_stream(spark, source), "value", ROW, "id", path, check, drain=True))
    want = [(1, "a2"), (3, "c"), (4, "d")]
    assert rows(ch.current_state(spark, path, ROW, "id")) == want
    lines(source, "f9", [change("u", 7, (2, "b"), (2, "late again")), change("d", 11, before=(4, "d"))])
    drain(ch.apply_changes(text_stream(spark, source), "value", ROW, "id", path, check, drain=True))
    assert rows(ch.current_state(spark, path, ROW, "id")) == [(1, "a2"), (3, "c")]


def test_a_batch_run_again_leaves_one_copy(spark, tmp_path, rows):
    feed = tmp_path / "in"
    lines(feed, "f", [change("r", 1, after=(1, "a"))])
    path = str(tmp_path / "state")
    for n in range(2):  # a lost checkpoint: another stream brings the same changes again
        drain(ch.apply_changes(text_stream(spark, feed), "value", ROW, "id", path, str(tmp_path / f"c{n}"), drain=True))
        assert rows(ch.folded_state(spark, path, ROW, "id")) == [(1, "a", "r", 1)]


CHANGE = "id long, v string, op string, pos long"


def merged(spark, path, changes, batch, **options):
    ch.merge_batch(spark.createDataFrame(changes, CHANGE), path, ROW, "id", batch, "one", buckets=4, open_deltas=3, **options)


def files_below(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*.parquet"))


def test_reading_costs_the_same_after_many_batches(spark, tmp_path, rows):
    path = tmp_path / "t"
    state, counts = {}, []
    rnd = random.Random(2)
    for batch in range(14):
        changes = [(rnd.randrange(30), f"v{batch}", rnd.choice("uud"), batch * 100 + i) for i in range(6)]
        merged(spark, str(path), changes, batch)
        for i, v, op, pos in changes:
            state[i] = (v, op)
        live = ch.read_manifest(spark, str(path)).files(str(path))
        counts.append(len(live))
        # Two manifests are kept, so nothing else grows either.
        assert len(files_below(path)) <= 2 * 4 * (1 + 3) + 2 and len(files_below(path / "manifest")) <= 2
    assert max(counts) <= 4 * 3 and ch.read_manifest(spark, str(path)).version == 13
    assert rows(ch.current_state(spark, str(path), ROW, "id")) == sorted(((i, v) for i, (v, op) in state.items() if op != "d"), key=repr)


def test_only_touched_buckets_are_merged(spark, tmp_path):
    path = str(tmp_path / "t")
    merged(spark, path, [(i, "a", "c", i) for i in range(40)], 0)
    for batch in range(1, 4):
        merged(spark, path, [(7, f"b{batch}", "u", 100 + batch)], batch)
    live = ch.read_manifest(spark, path).live
    assert sorted(live) == [0, 1, 2, 3]
    assert sorted(base is not None for base, _ in live.values()) == [False, False, False, True]
    assert [deltas for base, deltas in live.values() if base is None] == [[0], [0], [0]]


@pytest.mark.parametrize("step", ["delta", "base", "manifest"])
def test_a_batch_that_fails_at_any_step_and_runs_again(spark, tmp_path, rows, step):
    path = str(tmp_path / "t")
    for batch in range(2):
        merged(spark, path, [(1, f"a{batch}", "u", batch), (2, "b", "u", batch)], batch)
    before = rows(ch.current_state(spark, path, ROW, "id"))

    def fail(at):
        if at == step:
            raise RuntimeError(step)

    changes = [(1, "new", "u", 9), (2, "b", "d", 9), (3, "c", "c", 9)]
    with pytest.raises(RuntimeError):
        merged(spark, path, changes, 2, on_step=fail)
    seen = rows(ch.current_state(spark, path, ROW, "id"))
    assert seen == (before if step != "manifest" else [(1, "new"), (3, "c")])
    for _ in range(2):
        merged(spark, path, changes, 2)
        assert rows(ch.current_state(spark, path, ROW, "id")) == [(1, "new"), (3, "c")]
        assert ch.read_manifest(spark, path).version == 2
    merged(spark, path, [(3, "d", "u", 10), (None, "x", "u", 11)], 3)
    assert rows(ch.current_state(spark, path, ROW, "id")) == [(1, "new"), (3, "d")]


def test_empty_table_and_empty_batch(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert rows(ch.current_state(spark, path, ROW, "id")) == []
    merged(spark, path, [], 0)
    assert rows(ch.current_state(spark, path, ROW, "id")) == []
    merged(spark, path, [(1, "a", "c", 1)], 1)
    assert rows(ch.current_state(spark, path, ROW, "id")) == [(1, "a")]


def test_topic_options():
    source = topics.source_options("h:9092", "t", "earliest")
    assert source["subscribe"] == "t" and source["startingOffsets"] == "earliest"
    sink = topics.sink_options("h:9092", "t")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_payload(spark, rows):
    df = spark.createDataFrame([(bytearray(b"{}"),), (None,)], "value binary")
    assert rows(topics.text_payload(df)) == sorted([("{}",), (None,)], key=repr)


def test_restarts_are_bounded():
    class Failing:
        def awaitTermination(self):
            raise RuntimeError("lost")

    started, waits = [], []
    with pytest.raises(RuntimeError):
        run_with_restarts(lambda: started.append(1) or Failing(), 3, 10, waits.append)
    assert len(started) == 4 and waits == [10, 10, 10]


TIMED = "id long, ts timestamp"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def timed_stream(spark, folder):
    return spark.readStream.schema(TIMED).parquet(str(folder))


def test_late_records_go_to_the_side(spark, tmp_path, rows):
    feed, path, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    schema = spark.createDataFrame([], TIMED).schema
    batches = [
        [(1, at(10)), (2, at(8)), (3, None)],  # nothing is late before a time was seen, a record without one always is
        [(4, at(9)), (5, at(8, 59)), (6, at(12))],
        [(7, at(10, 59)), (8, at(11)), (9, at(11, 30))],
        [(10, at(10, 59)), (11, at(11))],  # the latest time stays that of the second batch
    ]
    for batch in batches:
        spark.createDataFrame(batch, TIMED).coalesce(1).write.mode("append").parquet(str(feed))
        drain(ev.route_late(timed_stream(spark, feed), "ts", dt.timedelta(hours=1), path, check, drain=True))  # restarted each time
    assert rows(ev.routed(spark, path, "late", schema), "id") == sorted([(3,), (5,), (7,), (10,)], key=repr)
    assert rows(ev.routed(spark, path, "on_time", schema), "id") == sorted([(i,) for i in (1, 2, 4, 6, 8, 9, 11)], key=repr)
    assert ev.routed(spark, str(tmp_path / "none"), "late", schema).count() == 0


def test_a_routed_batch_that_runs_again(spark, tmp_path, rows):
    """The checkpoint of the last batch is lost: it is parted as before and there once."""
    feed, path, check = tmp_path / "in", str(tmp_path / "out"), tmp_path / "check"
    schema = spark.createDataFrame([], TIMED).schema
    for batch in ([(1, at(10))], [(2, at(13)), (3, at(8))]):
        spark.createDataFrame(batch, TIMED).coalesce(1).write.mode("append").parquet(str(feed))
        drain(ev.route_late(timed_stream(spark, feed), "ts", dt.timedelta(hours=1), path, str(check), drain=True))
    os.remove(check / "commits" / "1")
    if (check / "commits" / ".1.crc").exists():
        os.remove(check / "commits" / ".1.crc")
    drain(ev.route_late(timed_stream(spark, feed), "ts", dt.timedelta(hours=1), path, str(check), drain=True))
    assert rows(ev.routed(spark, path, "late", schema), "id") == [(3,)]
    assert rows(ev.routed(spark, path, "on_time", schema), "id") == [(1,), (2,)]


def test_repeats_are_dropped_and_stretches_counted_once(spark, tmp_path, rows):
    feed, path, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    batches = [[(1, at(1)), (1, at(1, 5)), (2, at(1, 30))], [(2, at(1, 40)), (3, at(2))], [(4, at(9)), (4, at(9))], [(5, at(20))]]
    for batch in batches:
        spark.createDataFrame(batch, TIMED).coalesce(1).write.mode("append").parquet(str(feed))
        once = ev.once_within(timed_stream(spark, feed), ["id"], "ts", "2 hours")
        counted = ev.counts_by_time(once, [], "ts", "1 hour")
        drain(stream_defaults(counted.writeStream.format("parquet").option("path", path), check, drain=True))
    got = rows(spark.read.schema("start timestamp, end timestamp, records long").parquet(path), "start", "records")
    assert got == [(at(1), 2), (at(2), 1), (at(9), 1)]

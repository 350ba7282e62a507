import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymill.operators import history

D = dt.date
OPEN = D(9999, 12, 31)
ZIP = "id long, city string, start_date date, end_date date"


def merge(stored, changes, day="2024-03-02"):
    return history.user_zip_merge(stored, changes, "id", ["city"], day, "seq")


def test_merge_closes_opens_and_keeps(spark, rows):
    stored = spark.createDataFrame(
        [
            (1, "A", D(2024, 1, 1), OPEN),
            (2, "B", D(2024, 1, 1), OPEN),
            (3, None, D(2024, 1, 1), OPEN),
            (4, "old", D(2023, 1, 1), D(2023, 12, 31)),
            (4, "D", D(2024, 1, 1), OPEN),
        ],
        ZIP,
    )
    changes = spark.createDataFrame(
        [(1, "A2", 5), (1, "A1", 4), (2, "B", 1), (3, "C", 1), (9, "N", 1)], "id long, city string, seq long"
    )
    want = [
        (1, "A", D(2024, 1, 1), D(2024, 3, 1)),
        (1, "A2", D(2024, 3, 2), OPEN),
        (2, "B", D(2024, 1, 1), OPEN),
        (3, "C", D(2024, 3, 2), OPEN),
        (3, None, D(2024, 1, 1), D(2024, 3, 1)),
        (4, "D", D(2024, 1, 1), OPEN),
        (4, "old", D(2023, 1, 1), D(2023, 12, 31)),
        (9, "N", D(2024, 3, 2), OPEN),
    ]
    once = merge(stored, changes)
    assert rows(once) == sorted(want, key=repr)
    assert rows(merge(once, changes)) == sorted(want, key=repr)  # a second run changes nothing


def test_second_change_on_the_same_day_replaces_the_new_row(spark, rows):
    stored = spark.createDataFrame([(1, "A", D(2024, 1, 1), OPEN)], ZIP)
    first = merge(stored, spark.createDataFrame([(1, "B", 1)], "id long, city string, seq long"))
    second = merge(first, spark.createDataFrame([(1, "C", 2)], "id long, city string, seq long"))
    assert rows(second) == sorted(
        [(1, "A", D(2024, 1, 1), D(2024, 3, 1)), (1, "C", D(2024, 3, 2), OPEN)], key=repr
    )


def test_merge_into_an_empty_history(spark, rows):
    empty = spark.createDataFrame([], ZIP)
    out = merge(empty, spark.createDataFrame([(1, "A", 1)], "id long, city string, seq long"))
    assert rows(out) == [(1, "A", D(2024, 3, 2), OPEN)]


def test_init_hashes_and_dates(spark):
    users = spark.createDataFrame(
        [(1, "n", "pw", "real", "13912345678", "bad mail", 1, 365, "F", "1704067200")],
        "id long, login_name string, passwd string, real_name string, phone_num string, email string, user_level int, "
        "birthday int, gender string, create_time string",
    )
    r = history.user_zip_init(users).first()
    assert r["birthday"] == D(1971, 1, 1) and r["start_date"] == D(2024, 1, 1) and r["end_date"] == OPEN
    assert r["gender"] == "F" and r["email"] is None and len(r["phone_num"]) == 32
    assert history.user_zip_init(users, "2024-05-05").first()["start_date"] == D(2024, 5, 5)


def test_state_ignores_late_updates_after_a_delete(spark, rows):
    feed = spark.createDataFrame(
        [(1, "a", "r", 1), (1, "b", "d", 3), (1, "c", "u", 2), (2, "x", "c", 1), (2, "y", "u", 4)],
        "id long, v string, op string, pos long",
    )
    assert rows(history.latest_state(feed, "id", ["v"], "pos")) == [(2, "y")]
    first, late = feed.where("pos <> 2"), feed.where("pos = 2")
    state = history.merge_state(first.limit(0), first, "id", ["v"], "pos")
    state = history.merge_state(state, late, "id", ["v"], "pos")
    state = history.merge_state(state, late, "id", ["v"], "pos")
    assert rows(state.where(F.col("op") != "d"), "id", "v") == [(2, "y")]


def test_rows_without_key_or_end_pass_through(spark, rows):
    day = lambda s: None if s is None else dt.date.fromisoformat(s)
    stored = spark.createDataFrame(
        [(1, "a", day("2020-01-01"), day(None)), (None, "b", day("2020-01-01"), day("9999-12-31")), (2, "c", day("2020-01-01"), day("9999-12-31"))],
        "id long, city string, start_date date, end_date date",
    )
    changes = spark.createDataFrame([(2, "d", 1), (None, "x", 1)], "id long, city string, seq long")
    out = rows(history.user_zip_merge(stored, changes, "id", ["city"], "2024-01-31", "seq"), "id", "city")
    assert sorted(out, key=repr) == sorted([(1, "a"), (None, "b"), (2, "c"), (2, "d")], key=repr)


DATED = "id long, city string, day date, seq long"


def brute_chain(stored, changes):
    """Day by day: what each key is on every day, then runs of days; changes by day, the last by order."""
    out = [r for r in stored if r[0] is None or r[2] is None or r[3] is None]
    usable = [r for r in stored if r not in out]
    for key in {r[0] for r in usable} | {c[0] for c in changes if c[0] is not None}:
        rows, mine = [r for r in usable if r[0] == key], {}
        for c in sorted((c for c in changes if c[0] == key and c[2] is not None), key=lambda c: c[3]):
            mine[c[2]] = c[1]
        starts = {r[2]: r for r in rows}
        cuts, cover, line = sorted({*starts, *mine}), None, []
        for at in cuts:
            if at in starts:
                cover = starts[at][3]
            value = mine.get(at, starts[at][1] if at in starts else None)
            until = cover if cover is not None and cover >= at else OPEN
            if line and at not in starts and line[-1][0] == value and line[-1][2] >= at - dt.timedelta(days=1):
                continue
            line.append((value, at, until))
        for n, (value, at, until) in enumerate(line):
            following = line[n + 1][1] - dt.timedelta(days=1) if n + 1 < len(line) else OPEN
            out.append((key, value, at, min(following, until)))
    return sorted(out, key=repr)


def test_three_changes_of_a_key_and_a_late_one(spark, rows):
    stored = [(1, "A", D(2024, 1, 1), OPEN), (2, "A", D(2024, 1, 1), D(2024, 1, 31)), (2, "B", D(2024, 2, 1), OPEN), (3, "A", D(2024, 1, 1), D(2024, 1, 5))]
    changes = [
        (1, "B", D(2024, 3, 1), 1), (1, "C", D(2024, 3, 5), 2), (1, "D", D(2024, 3, 9), 3), (1, "x", D(2024, 3, 9), 1),
        (2, "late", D(2024, 1, 10), 4), (3, "back", D(2024, 2, 1), 5), (4, "new", D(2024, 3, 2), 6), (None, "no key", D(2024, 3, 2), 7), (1, "no day", None, 8),
    ]
    chain = lambda h: history.user_zip_chain(h, spark.createDataFrame(changes, DATED), "id", ["city"], "day", "seq")
    want = [
        (1, "A", D(2024, 1, 1), D(2024, 2, 29)), (1, "B", D(2024, 3, 1), D(2024, 3, 4)), (1, "C", D(2024, 3, 5), D(2024, 3, 8)), (1, "D", D(2024, 3, 9), OPEN),
        (2, "A", D(2024, 1, 1), D(2024, 1, 9)), (2, "late", D(2024, 1, 10), D(2024, 1, 31)), (2, "B", D(2024, 2, 1), OPEN),
        (3, "A", D(2024, 1, 1), D(2024, 1, 5)), (3, "back", D(2024, 2, 1), OPEN), (4, "new", D(2024, 3, 2), OPEN),
    ]
    once = chain(spark.createDataFrame(stored, ZIP))
    assert rows(once) == sorted(want, key=repr)
    assert rows(chain(spark.createDataFrame(want, ZIP))) == sorted(want, key=repr)


def random_feed(seed):
    rnd = random.Random(seed)
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(40))
    stored = [(None, "n", D(2024, 1, 1), OPEN), (1, "null end", D(2024, 1, 1), None), (2, "null start", None, OPEN)]
    for key in range(1, 15):
        cuts = sorted({day() for _ in range(rnd.randrange(4))})
        for n, start in enumerate(cuts):
            last = n + 1 == len(cuts)
            end = (OPEN if rnd.random() < 0.6 else start + dt.timedelta(days=3)) if last else cuts[n + 1] - dt.timedelta(days=1)
            stored.append((key, rnd.choice(["a", "b", None]), start, end))
    changes = [(rnd.randrange(1, 20), rnd.choice(["a", "b", "c", None]), day(), i) for i in range(40)]
    return stored, changes


@pytest.mark.parametrize("seed", range(4))
def test_chain_against_brute_force(spark, rows, seed):
    stored, changes = random_feed(seed)
    got = history.user_zip_chain(spark.createDataFrame(stored, ZIP), spark.createDataFrame(changes, DATED), "id", ["city"], "day", "seq")
    assert rows(got) == brute_chain(stored, changes)


def test_only_touched_folders_are_written(spark, rows, tmp_path):
    stored, changes = random_feed(9)
    stored = [r for r in stored if r[3] is not None]
    stored.append((77, "far", D(2020, 1, 1), D(2020, 1, 31)))
    path = str(tmp_path / "zip")
    schema = spark.createDataFrame([], ZIP).schema
    spark.createDataFrame(stored, ZIP).write.partitionBy("end_date").parquet(path)
    files = lambda: {(p.parent.name, p.name) for p in (tmp_path / "zip").rglob("*.parquet")}
    before = files()
    feed = spark.createDataFrame(changes, DATED)
    dates = history.user_zip_store(spark, path, schema, feed, "id", ["city"], "day", "seq")
    after = files()
    read = lambda: rows(spark.read.schema(schema).parquet(path).select("id", "city", "start_date", "end_date"))
    assert read() == brute_chain(stored, changes)
    changed = {folder for folder, _ in before ^ after}
    assert changed == {f"end_date={d}" for d in dates} and "end_date=2020-01-31" not in changed
    assert history.user_zip_store(spark, path, schema, feed, "id", ["city"], "day", "seq") == []
    # Some folders were replaced, then the job was lost: the same call mends the table.
    old = spark.createDataFrame(stored, ZIP).where(F.col("end_date") == F.lit(dates[0]))
    old.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("end_date").parquet(path)
    history.user_zip_store(spark, path, schema, feed, "id", ["city"], "day", "seq")
    assert read() == brute_chain(stored, changes)


def test_chain_with_nothing_to_do(spark, rows):
    stored = spark.createDataFrame([(1, "A", D(2024, 1, 1), OPEN)], ZIP)
    none = spark.createDataFrame([], DATED)
    assert rows(history.user_zip_chain(stored, none, "id", ["city"], "day", "seq")) == rows(stored)
    fresh = history.user_zip_chain(stored.limit(0), spark.createDataFrame([(1, "A", D(2024, 1, 1), 1)], DATED), "id", ["city"], "day", "seq")
    assert rows(fresh) == rows(stored)

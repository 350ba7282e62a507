import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.operators import trade_facts
from daymill.sources import files, jdbc, partitions, schemas

D = dt.date


@pytest.fixture
def days(spark):
    return spark.createDataFrame(
        [(1, "a", "0", D(2024, 1, 1)), (2, "b", "1", D(2024, 1, 1)), (3, "c", "0", D(2024, 1, 2))],
        "id int, v string, is_deleted string, dt date",
    )


def test_only_the_days_written_are_replaced(spark, days, tmp_path, rows):
    path = str(tmp_path / "t")
    partitions.overwrite_partitions(days, path)
    changed = days.where("id = 3").withColumn("v", F.lit("z"))
    for _ in range(2):
        partitions.overwrite_partitions(changed, path)
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "b"), (3, "z")]


def test_read_partition_prunes_folders(spark, days, tmp_path, rows):
    path = str(tmp_path / "t")
    partitions.overwrite_partitions(days, path)
    one = partitions.read_partition(spark, path, "20240101", live_only=True)
    assert rows(one, "id") == [(1,)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(is_deleted,0)" in plan


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
            F.date_add(F.lit("2024-01-02").cast("date"), (F.col("id") % 5).cast("int")).cast("string")
        ).cast("date").alias("dt"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, "1m")
    try:
        partitions.overwrite_partitions(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(name, old)
    files_of = lambda d: [f for f in os.listdir(tmp_path / "t" / f"dt={d}") if f.endswith(".parquet")]
    assert len(files_of("2024-01-01")) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_publishing_twice_keeps_one_copy(spark, tmp_path, rows):
    path = str(tmp_path / "r")
    report = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    partitions.publish_report(report, path, "2024-01-01")
    partitions.publish_report(report, path, "2024-01-02")
    partitions.publish_report(report.where("k = 'x'"), path, "2024-01-02")
    assert rows(spark.read.parquet(path), "dt", "k") == [
        (D(2024, 1, 1), "x"), (D(2024, 1, 1), "y"), (D(2024, 1, 2), "x"),
    ]


def test_rows_without_time_get_no_day(spark, rows):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 23, 59)), (2, None)], "id int, at timestamp")
    assert rows(partitions.partition_by_event_date(df, "at"), "id", "dt") == [(1, D(2024, 1, 1))]
    assert partitions.time_column("product_sales", df.schema) == "payment_time"
    assert partitions.time_column("other", df.schema) == "at"
    with pytest.raises(ValueError):
        partitions.time_column("other", T.StructType([T.StructField("a", T.LongType())]))


def test_verify_load_reports_missing_days(days, rows):
    out = partitions.verify_load(days, days.where("id <> 3"))
    assert rows(out, "dt", "source_rows", "loaded_rows", "matches") == [
        (D(2024, 1, 1), 2, 2, True), (D(2024, 1, 2), 1, 0, False),
    ]


def test_fill_numeric_nulls(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b decimal(16,2), c string")
    assert tuple(partitions.fill_numeric_nulls(df).first()) == (0, 0, None)


def test_conform_selects_orders_and_casts(spark):
    df = spark.createDataFrame([("5", 1, "extra")], "b string, a int, z string")
    target = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    out = partitions.conform_to_table(df, target)
    assert out.columns == ["a", "b"] and tuple(out.first()) == ("1", 5)


def test_key_ranges_cover_each_row_once(spark):
    df = spark.createDataFrame([(i,) for i in range(-5, 40)] + [(None,)], "k int")
    parts = [df.where(p).count() for p in jdbc.key_ranges("k", 0, 30, 4)]
    assert sum(parts) == 46 and len(parts) == 4 and all(parts)
    assert jdbc.key_ranges("k", 0, 30, 1) == ["1 = 1"]


def test_snapshot_options_read_in_parallel():
    options = jdbc.snapshot_options("orders", "id", 0, 1000, 16)
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "id" and options["fetchsize"] == "1000"


def test_connection_takes_secrets_from_the_environment():
    got = jdbc.connection_options("jdbc:x", "d", {"WAREHOUSE_DB_USER": "u", "WAREHOUSE_DB_PASSWORD": "p"})
    assert got == {"url": "jdbc:x", "driver": "d", "user": "u", "password": "p"}
    assert jdbc.connection_options("jdbc:x", "d", {}) == {"url": "jdbc:x", "driver": "d"}


def test_watermark(spark, rows):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, at int")
    assert rows(jdbc.rows_past_watermark(source, source.where("at <= 20"), "at"), "id") == [(3,)]
    assert len(rows(jdbc.rows_past_watermark(source, source.limit(0), "at"))) == 3
    assert jdbc.incremental_query("t", "at", None) == "SELECT * FROM t"
    assert jdbc.incremental_query("t", "at", "o'clock") == "SELECT * FROM t WHERE at > 'o''clock'"


def test_watermark_keeps_null_and_equal_values(spark, rows):
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None), (5, None), (6, 20), (7, 5)], "id int, at int")
    loaded = source.where("id IN (1, 2, 4, 7)")
    for key in (["id"], None):
        assert sorted(rows(jdbc.rows_past_watermark(source, loaded, "at", key), "id")) == [(3,), (5,), (6,)]
    assert jdbc.rows_past_watermark(source, source, "at", ["id"]).count() == 0
    assert jdbc.rows_past_watermark(source, source.limit(0), "at", ["id"]).count() == 7
    assert sorted(rows(jdbc.rows_past_watermark(source, source.where("id = 4"), "at", ["id"]), "id")) == [(i,) for i in (1, 2, 3, 5, 6, 7)]
    assert jdbc.incremental_query("t", "at", "9", undecided=True) == "SELECT * FROM t WHERE at >= '9' OR at IS NULL"


def test_rows_without_a_time_are_found_again(spark, rows):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None), (3, None)], "id int, at timestamp")
    left_out = partitions.rows_without_event_date(df, "at")
    assert left_out.count() + partitions.partition_by_event_date(df, "at").count() == df.count()
    kept = trade_facts.filtered_event_fact(df, "at", ["id"], timed=False)
    assert kept.count() == 3 and kept.where("date_id IS NULL AND event_time IS NULL").count() == 2
    assert rows(trade_facts.filtered_event_fact(df, "at", ["id"]), "id") == [(1,)]


def test_load_day_does_not_hide_a_source_column(days):
    out = jdbc.stamp_load_day(days, "2024-02-02")
    assert "original_dt" in out.columns and out.first()["dt"] == D(2024, 2, 2)


def test_retries_wait_longer_each_time():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("down")

    jdbc.with_retries(flaky, 3, 10, waits.append)
    assert waits == [10, 20]
    with pytest.raises(OSError):
        jdbc.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, 1, waits.append)


def test_export_types():
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("m", T.DecimalType(16, 2)), T.StructField("t", T.StringType()),
         T.StructField("path", T.StringType())]
    )
    assert jdbc.export_column_types(schema, ("path",)) == "id BIGINT, m DECIMAL(16,2), t VARCHAR(512), path LONGTEXT"
    ddl = jdbc.export_ddl("r", schema, ("path",))
    assert "PRIMARY KEY (id)" in ddl and "m DECIMAL(16,2)" in ddl
    assert "PRIMARY KEY" not in jdbc.export_ddl("r", schema, key=None)


def test_csv_keeps_quotes_commas_and_lines(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "quoted", text'), (2, None), (3, "价格")], "id int, t string")
    files.export_csv(df, str(tmp_path / "c"))
    assert rows(files.read_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)


def test_one_failed_export_does_not_stop_the_rest(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "id int")
    failed = files.export_tables({"bad": good, "good": good}, str(tmp_path), {"bad": "no_such_column = 1"})
    assert list(failed) == ["bad"] and (tmp_path / "good" / "_SUCCESS").exists()


def test_raw_table_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a\tb"), (2, None)], "id int, t string")
    files.write_raw_table(df, str(tmp_path / "r"))
    assert rows(files.read_raw_table(spark, str(tmp_path / "r"), df.schema)) == rows(df)


def test_json_lines_keep_bad_lines_apart(spark, tmp_path, rows):
    (tmp_path / "j.json").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("_bad_line", T.StringType())])
    out = files.rows_from_json_lines(spark, str(tmp_path / "j.json"), schema)
    assert rows(out) == sorted([(1, None), (2, None), (None, "not json")], key=repr)


def test_schema_from_catalogue(spark):
    data = [
        ("t", "id", 1, "bigint(20)", "key"), ("t", "flag", 2, "tinyint(1)", ""), ("t", "n", 3, "TINYINT", ""),
        ("t", "m", 4, "decimal(10,2)", "money"), ("t", "at", 5, "datetime", ""), ("t", "name", 6, "varchar(20)", ""),
        ("t", "shape", 7, "geometry", ""), ("t", "dt", 8, "date", ""), ("t", "pic", 9, "blob", ""),
    ]
    catalogue = spark.createDataFrame(
        data, "table_name string, column_name string, ordinal int, column_type string, comment string"
    )
    schema = schemas.target_schema(catalogue, "t")
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("id", "bigint"), ("flag", "boolean"), ("n", "tinyint"), ("m", "decimal(10,2)"), ("at", "timestamp"),
        ("name", "string"), ("shape", "string"), ("pic", "binary"),
    ]
    assert schema["m"].metadata["comment"] == "money"
    ddl = schemas.table_ddl("w.t", schema, "/w/t")
    assert "`m` decimal(10,2) COMMENT 'money'" in ddl and "PARTITIONED BY (`dt`)" in ddl and "USING orc" in ddl


def test_ddl_runs(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType(), True, {"comment": "it's"})])
    schemas.create_day_table(spark, "ddl_check", schema, str(tmp_path / "ddl"))
    try:
        assert spark.table("ddl_check").columns == ["a", "dt"]
        assert spark.table("ddl_check").schema["a"].metadata["comment"] == "it's"
    finally:
        spark.sql("DROP TABLE ddl_check")


def test_rows_without_a_day_are_counted_and_kept(spark, rows):
    days = spark.createDataFrame([(1, None), (2, None), (3, "2024-01-01")], "id long, dt string").withColumn("dt", F.col("dt").cast("date"))
    assert {r["matches"] for r in partitions.verify_load(days, days).collect()} == {True}
    today = days.where("id = 3")
    assert rows(partitions.union_with_history(days, today, ["2024-01-01"]), "id") == [(1,), (2,), (3,)]


def test_csv_keeps_line_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, "plain")], "id long, t string")
    files.export_csv(df, str(tmp_path / "c"))
    assert rows(files.read_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)


def test_catalogue_table(spark, rows, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType(), True, {"comment": "it's a"}), T.StructField("b", T.StringType())])
    schemas.create_day_table(spark, "day_table_test", schema, str(tmp_path / "t"))
    day = F.col("dt").cast("date").alias("dt")
    # Columns come by name, with other types and in another order.
    feed = spark.createDataFrame([("x", 1, "2024-01-01"), ("y", 2, "2024-01-02"), ("z", 3, "2024-01-02")], "b string, a int, dt string").select(day, "b", "a")
    schemas.write_day_table(feed, "day_table_test")
    schemas.write_day_table(feed.where("a = 1").withColumn("a", F.lit(9)), "day_table_test")
    assert rows(spark.table("day_table_test"), "a", "b") == [(2, "y"), (3, "z"), (9, "x")]
    assert schemas.table_days(spark, "day_table_test") == ["2024-01-01", "2024-01-02"]
    described = {r["col_name"]: r for r in spark.sql("DESCRIBE EXTENDED day_table_test").collect()}
    assert described["a"]["comment"] == "it's a" and described["Location"]["data_type"].endswith(str(tmp_path / "t"))
    spark.sql("DROP TABLE day_table_test")


VERIFIED = "id long, v string, w double, dt date"


def test_contents_are_compared_and_faults_located(spark, rows):
    day = lambda n: dt.date(2024, 1, n)
    good = [(i, f"v{i}", None if i % 3 else float(i), day(1 + i % 4) if i % 5 else None) for i in range(200)]
    source = spark.createDataFrame(good, VERIFIED)
    same = spark.createDataFrame(good[::-1], VERIFIED).select("dt", "w", "v", "id")
    assert partitions.differing_buckets(source, same, "id").count() == 0 and partitions.verify_contents(source, same, "id").count() == 0
    bad = [list(r) for r in good]
    bad[7][1] = "changed"
    bad[10][3] = day(2)  # was without a day
    bad[12], bad[13] = bad[13][:], bad[13][:]  # one is missing, one is there twice
    loaded = spark.createDataFrame([tuple(r) for r in bad], VERIFIED)
    assert partitions.verify_load(source.where("id = 7"), loaded.where("id = 7")).first()["matches"]
    want = [(*good[7], "source", 1), (7, "changed", *good[7][2:], "loaded", 1), (*good[10], "source", 1), (*good[10][:3], day(2), "loaded", 1), (*good[12], "source", 1), (*good[13], "loaded", 1)]
    assert rows(partitions.verify_contents(source, loaded, "id")) == sorted(want, key=repr)
    assert partitions.differing_buckets(source, loaded, "id").count() <= 6


def test_nulls_and_swapped_values_differ(spark):
    one = spark.createDataFrame([(1, None, 2.0, None)], VERIFIED)
    other = spark.createDataFrame([(1, "", 2.0, None)], VERIFIED)
    assert partitions.verify_contents(one, other, "id").count() == 2
    two = spark.createDataFrame([(1, None, 5)], "id long, a int, b int")
    swapped = spark.createDataFrame([(1, 5, None)], "id long, a int, b int")
    assert partitions.verify_contents(two, swapped, "id", "id").count() == 2
    assert partitions.verify_contents(one.limit(0), one.limit(0), "id").count() == 0


def test_days_in_storage(spark, rows, tmp_path):
    source = spark.createDataFrame([(1, "a", 1.0, dt.date(2024, 1, 1)), (2, "b", 1.0, None), (3, "c", 1.0, dt.date(2024, 1, 3))], VERIFIED)
    path = str(tmp_path / "t")
    source.write.partitionBy("dt").parquet(path)
    assert rows(partitions.verify_days(spark, path, source)) == []
    more = source.where("id = 1").unionByName(spark.createDataFrame([(4, "d", 1.0, dt.date(2024, 1, 9))], VERIFIED)).unionByName(source.where("dt IS NULL"))
    assert rows(partitions.verify_days(spark, path, more)) == sorted([("2024-01-03", False, True), ("2024-01-09", True, False)])
    assert partitions.verify_days(spark, str(tmp_path / "none"), source).count() == 3


def test_raw_tables_keep_every_text(spark, tmp_path):
    draw = random.Random(1)
    texts = [None, "", "NULL", " NULL", "\\NULL", "a\tb", "a\nb\r", "\\n", "\\\\n", "\\e", "\\s x", " lead", "trail ", "  ", '"q"', '"', "\0", "\\0", "\\z", "\0\\", "é😀", "# c"]
    texts += ["".join(draw.choice("\\ntrezs0 \t\n\"N\0") for _ in range(draw.randrange(1, 7))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, `v.w` string")
    files.write_raw_table(df, str(tmp_path / "t"))
    assert {r[0]: r[1] for r in files.read_raw_table(spark, str(tmp_path / "t"), df.schema).collect()} == dict(enumerate(texts))

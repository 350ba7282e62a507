"""Properties every physical plan must have, and the behaviour under a hot key."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from daymill.functions.days import as_date, raw_within, window_days
from daymill.operators import trade_facts as tf
from daymill.plans import roles
from daymill.plans.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_pruned(spark):
    plan = plan_of(entry.queries()["sku_favor_1d"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_log_text_is_parsed_once(spark):
    assert plan_of(roles.page_views(Tables(spark, FOLDER))).count("from_json(") == 1


def test_path_uses_one_scan(spark):
    df = entry.queries()["page_path"](spark, FOLDER)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1


def test_stretches_of_sessions_are_not_broadcast(spark):
    """There may be as many as views, whatever the estimate says."""
    df = entry.queries()["page_path"](spark, FOLDER)
    df.collect()
    assert "Broadcast" not in plan_of(df)


def test_hot_order_is_split(spark, rows):
    """A third of the lines belongs to one order; the join splits it and keeps every line."""
    n = 60_000
    lines = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("order_id"),
        (F.col("id") % 50).alias("sku_id"),
        F.lit(2).cast("bigint").alias("sku_num"),
        F.lit("1.50").cast("decimal(16,2)").alias("order_price"),
        F.lit(None).cast("decimal(16,2)").alias("split_activity_amount"),
        F.lit("0.10").cast("decimal(16,2)").alias("split_coupon_amount"),
        F.lit("2.90").cast("decimal(16,2)").alias("split_total_amount"),
        F.sha2(F.col("id").cast("string"), 512).alias("note"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("create_time"),
    )
    orders = spark.range(-1, n).select(
        F.col("id").alias("order_id"), (F.col("id") % 100).alias("user_id"), F.lit(1).alias("province_id")
    )
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "5k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        fact = tf.order_detail_fact(lines, orders).groupBy("order_id", "user_id").agg(
            F.count("id").alias("n"), F.sum("original_amount").alias("amount")
        )
        got = fact.where("order_id = -1").collect()
        total = fact.agg(F.sum("n"), F.count("*")).first()
        whole = tf.order_detail_fact(lines, orders).select("id", "user_id")
        assert len(whole.collect()) == n
        plan = plan_of(whole)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert [(r["n"], str(r["amount"])) for r in got] == [(n // 3, "60000.00")]
    assert tuple(total) == (n, 1 + n - n // 3)
    assert "skew=true" in plan


#: Reports over windows, and the columns of the scans that hold their days.
WINDOW_REPORTS = {
    "channel_traffic": ["ts"],
    "offer_overview": ["o_orderdate"],
    "agent_rank_change": ["o_orderdate"],
    "shift_finish_nd": ["l_shipdate"],
    "transport_report": ["l_shipdate"],
    "transport_report_line": ["l_shipdate"],
    "transport_report_shift": ["l_shipdate"],
    "truck_report": ["l_shipdate"],
    "driver_report": ["l_shipdate"],
    "area_trade_transport": ["l_shipdate"],
    "area_trade_transport_by_org": ["l_shipdate"],
    "order_report": ["l_shipdate"],
    "order_report_cargo_type": ["l_shipdate"],
    "express_report": ["l_shipdate", "o_orderdate"],
    "express_report_province": ["l_shipdate", "o_orderdate"],
    "express_report_total": ["l_shipdate", "o_orderdate"],
    "order_flow_report": ["o_orderdate"],
}


@pytest.mark.parametrize("name", sorted(WINDOW_REPORTS))
def test_window_reports_push_both_bounds(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan_of(entry.queries()[name](spark, FOLDER)))
    for column in WINDOW_REPORTS[name]:
        ranges = [
            tuple(dt.datetime.fromisoformat(re.search(rf"{kind}\({column},([^)]*)\)", p)[1].rstrip("Z")) for kind in ("GreaterThanOrEqual", "LessThan"))
            for p in pushed
            if f"GreaterThanOrEqual({column}," in p and f"LessThan({column}," in p
        ]
        assert ranges, pushed
        # A month and the day or two by which a day of the table differs from the report's.
        assert all(dt.timedelta(0) < high - low <= dt.timedelta(days=32) for low, high in ranges)
    if name.startswith(("transport", "truck", "driver", "shift", "area", "order_report")):
        assert all("GreaterThanOrEqual(l_shipdate," in p for p in pushed if "l_shipdate" in p)


def test_bounds_are_the_inverse_of_the_day(spark):
    """Every row on the days passes, and of exact bounds none beside them."""
    start = dt.datetime(2024, 2, 27)
    times = spark.range(0, 6 * 24 * 60).select((F.lit(start).cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("t"))
    days = ("2024-02-29", "2024-03-01")
    for hours in (-8, 0, 8, 27):
        later = dt.timedelta(hours=hours)
        on_days = F.to_date(F.col("t") + F.lit(later)).between(*[F.lit(as_date(d)) for d in days])
        for unit, raw in (("timestamp", F.col("t")), ("millis", F.unix_millis("t")), ("seconds", F.unix_seconds("t"))):
            assert times.where(raw_within(raw, days, unit, later) != on_days).count() == 0
        wide = raw_within("t", days, later=later, most=later + dt.timedelta(hours=3))
        assert times.where(on_days & ~wide).count() == 0
        late = F.to_date(F.col("t") + F.lit(later + dt.timedelta(hours=3))).between(*[F.lit(as_date(d)) for d in days])
        assert times.where(late & ~wide).count() == 0
    assert times.where(raw_within("t", None)).count() == times.count()
    assert window_days("2024-03-01") == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))

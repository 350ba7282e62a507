"""Operators on hand-written rows: null keys, ties, empty input, day boundaries, fan-out."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from daymill.operators import dimensions as dims
from daymill.operators import freight_facts as ff
from daymill.operators import freight_reports as fr
from daymill.operators import freight_summaries as fs
from daymill.operators import offers as of
from daymill.operators import reports as rp
from daymill.operators import summaries as sm
from daymill.operators import trade_facts as tf

D = dt.date
DAY = D(2024, 1, 30)
T = dt.datetime


def ago(n):
    return DAY - dt.timedelta(days=n)


MONEY = "decimal(16,2)"
FACT = (
    f"id long, order_id long, user_id long, province_id int, sku_id long, dt date, sku_num long, original_amount {MONEY}, "
    f"activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, total_amount {MONEY}"
)


@pytest.fixture(scope="module")
def facts(spark):
    def line(i, order, user, province, day, items, amount):
        return (i, order, user, province, 7, day, items, Dec(amount), Dec("0"), Dec("1"), Dec(amount) - 1)

    return spark.createDataFrame(
        [
            line(1, 1, 1, 10, ago(0), 2, "10"),
            line(2, 1, 1, 10, ago(0), 1, "20"),
            line(3, 2, 1, 10, ago(6), 1, "30"),
            line(4, 3, 2, None, ago(7), 1, "40"),
            line(5, 4, None, 11, ago(29), 1, "50"),
            line(6, 5, 2, 11, ago(30), 1, "60"),
        ],
        FACT,
    )


def test_orders_are_counted_once(facts, rows):
    daily = sm.user_order_1d(facts)
    assert rows(daily.where("user_id = 1"), "dt", "order_count", "order_num", "original_amount") == [
        (ago(6), 1, 1, Dec("30.00")), (ago(0), 1, 3, Dec("30.00")),
    ]
    assert daily.where("user_id is null").count() == 1
    assert sm.user_order_1d(facts, DAY).count() == 1


def test_geo_keeps_orders_without_province(spark, facts, rows):
    geo = spark.createDataFrame([(10, "North")], "province_id int, province_name string")
    out = sm.geo_order_1d(facts, geo)
    assert rows(out, "province_id", "province_name", "order_count") == sorted(
        [(10, "North", 1), (10, "North", 1), (None, None, 1), (11, None, 1), (11, None, 1)], key=repr
    )


def test_window_edges(facts, rows):
    daily = sm.user_order_1d(facts)
    wide = sm.rolling_window_rollup(daily, ["user_id"], ["order_count"], DAY)
    assert rows(wide) == sorted([(1, 2, 2), (2, None, 1), (None, None, 1)], key=repr)
    long = sm.rolling_window_rollup(daily, ["user_id"], ["order_count"], "20240130", (1, 7, 30), "long")
    assert rows(long) == sorted([(1, 1, 1), (1, 7, 2), (1, 30, 2), (2, 30, 1), (None, 30, 1)], key=repr)


def test_geo_report_leaves_out_empty_windows(spark, facts, rows):
    geo = spark.createDataFrame([(10, "North"), (11, "South")], "province_id int, province_name string")
    wide = sm.rolling_window_rollup(
        sm.geo_order_1d(facts, geo), ["province_id", "province_name"], ["order_count", "total_amount"], DAY, (1, 7, 30)
    )
    out = rp.geo_order_report(wide)
    assert rows(out.where("province_id = 11"), "recent_days", "order_count") == [(30, 1)]
    assert rows(out.where("province_id = 10"), "recent_days", "order_count") == [(1, 1), (30, 2), (7, 2)]


def test_to_date_equals_incremental(facts, rows):
    daily = sm.user_order_1d(facts)
    whole = sm.user_order_td(daily)
    rules = {"order_date_first": "min", "order_date_last": "max", "order_count": "sum", "order_num": "sum"}
    cut = F.lit(ago(6))
    parts = sm.roll_forward(
        sm.user_order_td(daily.where(F.col("dt") < cut)), sm.user_order_td(daily.where(F.col("dt") >= cut)), ["user_id"], rules
    )
    assert rows(parts, "user_id", *rules) == rows(whole, "user_id", *rules)


def test_payments_filter_before_the_join(spark, rows):
    detail = spark.createDataFrame(
        [(1, 1, 5, 1, Dec("2"), Dec("1"), None, Dec("9")), (2, 2, 5, 1, Dec("2"), None, None, Dec("8"))],
        f"id long, order_id long, sku_id long, sku_num long, order_price {MONEY}, split_activity_amount {MONEY}, "
        f"split_coupon_amount {MONEY}, split_total_amount {MONEY}",
    ).withColumn("create_time", F.lit(T(2024, 1, 1)))
    orders = spark.createDataFrame([(1, 7, 3), (2, 7, 3)], "order_id long, user_id long, province_id int")
    pays = spark.createDataFrame(
        [(1, 7, "1101", "1602", T(2024, 1, 2)), (2, 7, "1101", "1601", T(2024, 1, 2))],
        "order_id long, user_id long, payment_type string, payment_status string, callback_time timestamp",
    )
    codes = spark.createDataFrame([("1101", "card", "11")], "dic_code string, dic_name string, parent_code string")
    out = tf.payment_fact(detail, orders, pays, codes)
    assert rows(out, "id", "order_id", "user_id", "payment_type_name", "original_amount") == [
        (1, 1, 7, "card", Dec("10.00")), (2, None, None, None, Dec("8.00")),
    ]
    assert rows(sm.user_payment_1d(out), "user_id", "payment_count", "payment_amount") == [(7, 1, Dec("9.00"))]


def test_orders_paid_and_received_twice_stay_one_row(spark, rows):
    orders = spark.createDataFrame([(1, 7, 3, Dec("9"), Dec("0"), Dec("0"))], f"order_id long, user_id long, province_id int, amount {MONEY}, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}")
    orders = orders.withColumn("create_time", F.lit(T(2024, 1, 1)))
    pays = spark.createDataFrame(
        [(1, 7, "1102", "1602", T(2024, 1, 3), Dec("4")), (1, 7, "1101", "1602", T(2024, 1, 2), Dec("5")), (1, 8, "1103", "1602", None, Dec("0"))],
        f"order_id long, user_id long, payment_type string, payment_status string, callback_time timestamp, payment_amount {MONEY}",
    )
    log = spark.createDataFrame([(1, "1004", T(2024, 1, 5)), (1, "1004", T(2024, 1, 4))], "order_id long, order_status string, create_time timestamp")
    flow = tf.trade_flow_fact(orders, pays, log)
    assert rows(flow, "order_id", "payment_time", "payment_amount", "finish_time") == [(1, T(2024, 1, 2), Dec("9.00"), T(2024, 1, 4))]
    first = tf.first_of_order(pays, "callback_time", ["user_id", "payment_type"])
    assert rows(first) == [(1, T(2024, 1, 2), 7, "1101")]


LOG = '{"common": {"uid": %s, "sid": "s%d", "ch": "c"}, "page": %s, "ts": %s}'


def test_login_takes_the_first_view_by_number(spark, rows):
    data = [
        (1, LOG % ('"5"', 1, '{"page_id": "b"}', "1704067200999")),
        (2, LOG % ('"5"', 1, '{"page_id": "a"}', "999")),
        (3, LOG % ("null", 1, '{"page_id": "z"}', "1")),
        (4, LOG % ('"6"', 2, "null", "5")),
        (5, "not json"),
    ]
    views = tf.page_view_fact(spark.createDataFrame(data, "event_id long, log string"))
    assert views.count() == 3
    assert rows(tf.login_fact(views, "event_id"), "user_id", "session_id", "login_time") == [
        ("5", "s1", "1970-01-01 08:00:00")
    ]


def test_register_keeps_one_row_per_user(spark, rows):
    data = [(i, LOG % ('"5"', i, '{"page_id": "b"}', str(i))) for i in range(3)]
    views = tf.page_view_fact(spark.createDataFrame(data, "event_id long, log string"))
    users = spark.createDataFrame([(5, T(2024, 1, 1)), (6, T(2024, 1, 2))], "id long, create_time timestamp")
    assert rows(tf.register_fact(users, views, "event_id"), "user_id", "channel") == [(5, "c"), (6, None)]


def test_three_days_in_a_row(spark, rows):
    data = [(1, ago(0)), (1, ago(1)), (1, ago(2)), (1, ago(2)), (2, ago(0)), (2, ago(2)), (2, ago(3)), (3, ago(6)), (3, ago(5)),
            (3, ago(7)), (None, ago(0))]
    daily = spark.createDataFrame(data, "user_id long, dt date")
    assert rg(rp.consecutive_order_users(daily, DAY)) == (DAY, 7, 1)
    assert rg(rp.consecutive_order_users(daily.limit(0), DAY)) == (DAY, 7, 0)


def rg(df):
    return tuple(df.first())


def test_churn_return_retention_activity(spark, rows):
    schema = "user_id long, login_date_last date, login_date_first date, login_count_td long"
    today = spark.createDataFrame(
        [(1, ago(7), ago(20), 1), (2, DAY, ago(20), 2), (3, DAY, ago(3), 2), (4, ago(3), ago(3), 1), (5, DAY, DAY, 1)], schema
    )
    before = spark.createDataFrame([(1, ago(7), ago(20), 1), (2, ago(8), ago(20), 1), (3, ago(7), ago(3), 1)], schema)
    assert rg(rp.churn_and_return(today, before, DAY)) == (DAY, 1, 1)
    kept = rp.retention(today, DAY)
    assert rows(kept, "create_date", "retention_day", "retention_count", "new_user_count", "retention_rate") == [
        (ago(3), 3, 1, 2, Dec("50.00"))
    ]
    assert rows(rp.user_activity(today, DAY), "recent_days", "new_user_count", "active_user_count") == [
        (1, 1, 3), (30, 5, 5), (7, 3, 4),
    ]


def test_repeat_rate_and_group_report(spark, rows):
    nd = spark.createDataFrame(
        [(1, 1, "t", "T", 1), (1, 2, "t", "T", 1), (2, 1, "t", "T", 1), (3, 1, "t", "T", 0), (4, 9, "u", "U", 0)],
        "user_id long, sku_id long, tm_id string, tm_name string, order_count_30d long",
    )
    assert rows(rp.repeat_purchase_rate(nd, DAY), "tm_id", "order_repeat_rate") == [("t", Dec("0.50")), ("u", None)]
    daily = spark.createDataFrame(
        [(1, "t", 2, ago(0)), (1, "t", 1, ago(3)), (2, "t", 1, ago(3))], "user_id long, tm_id string, order_count long, dt date"
    )
    assert rows(rp.order_report_by_group(daily, ["tm_id"], DAY)) == [(1, "t", 2, 1), (30, "t", 4, 2), (7, "t", 4, 2)]


def test_attributes_do_not_multiply_products(spark):
    frame = spark.createDataFrame
    sku = frame([(1, Dec("1.00"), 1, 10, 100), (2, Dec("2.00"), 0, None, 100)], f"id long, price {MONEY}, is_sale int, spu_id long, tm_id long")
    spu = frame([(10, "spu", 3)], "id long, spu_name string, category3_id long")
    cat = lambda up: frame([(3, "c", 3)], f"id long, name string, {up} long")
    tm = frame([(100, "tm")], "id long, tm_name string")
    attr = frame([(1, 5, 50, "size", "L"), (1, 5, 50, "size", "L"), (1, 4, 40, "hue", None)], "sku_id long, attr_id long, value_id long, attr_name string, value_name string")
    renamed = {"attr_id": "sale_attr_id", "value_id": "sale_attr_value_id", "attr_name": "sale_attr_name", "value_name": "sale_attr_value_name"}
    sale = attr.withColumnsRenamed(renamed).limit(0)
    out = dims.sku_dim(sku, spu, cat("category2_id"), cat("category1_id"), cat("x"), tm, attr, sale).orderBy("sku_id").collect()
    assert [r["is_sale"] for r in out] == [True, False]
    assert [tuple(a) for a in out[0]["attrs"]] == [(4, 40, "hue", None), (5, 50, "size", "L")] and out[0]["sale_attrs"] is None
    assert out[0]["category1_name"] == "c" and out[1]["category3_id"] is None


def test_areas_are_one_row_and_couriers_a_bridge(spark, rows):
    areas = spark.createDataFrame([(1, "a", 1, 2), (2, "b", 1, 2), (3, "c", 1, 99)], "id long, complex_name string, province_id long, city_id long")
    regions = spark.createDataFrame([(1, "P"), (2, "C")], "id long, name string")
    couriers = spark.createDataFrame([(1, i) for i in range(25)] + [(1, 3)], "complex_id long, courier_emp_id long")
    assert rows(dims.complex_dim(areas, regions), "id", "province_name", "city_name") == [(1, "P", "C"), (2, "P", "C")]
    assert len(rows(dims.complex_couriers(couriers))) == 25


def test_climb_by_level(spark, rows):
    regions = spark.createDataFrame(
        [(1, "P", None), (11, "C", 1), (111, "D", 11)], "id long, name string, parent_id long"
    )
    hubs = spark.createDataFrame([("x", 11, 1), ("y", 111, 2), ("z", None, 2)], "h string, r long, level int")
    out = dims.climb_regions(hubs, regions, "r", F.col("level"))
    assert rows(out, "h", "city_name", "province_name") == [("x", "C", "P"), ("y", "C", "P"), ("z", None, None)]


def _offer_frames(spark):
    sends = spark.createDataFrame(
        [
            (1, 7, 70, 5, 1, Dec("10.00"), T(2024, 1, 30, 9), 2), (2, 7, 71, 5, 1, Dec("20.00"), T(2024, 1, 30, 9), 1),
            (3, 7, 71, 6, 2, Dec("30.00"), T(2024, 1, 29, 10), 2),
        ],
        f"record_id long, activity_id long, product_id long, customer_id long, cs_id long, offer_amount {MONEY}, "
        "send_time timestamp, status int",
    ).withColumn("expire_time", F.lit(None).cast("timestamp"))
    redeemed = spark.createDataFrame(
        [(100, 1, T(2024, 1, 30, 11), Dec("1.00"), Dec("10.00")), (101, 1, T(2024, 1, 30, 13), Dec("1.00"), Dec("0.00")),
         (102, 3, T(2024, 1, 31, 10), Dec("1.00"), Dec("5.00"))],
        f"redemption_id long, record_id long, redemption_time timestamp, actual_offer_amount {MONEY}, payment_amount {MONEY}",
    )
    campaigns = spark.createDataFrame(
        [(7, "name", 1, T(2024, 1, 1), T(2024, 3, 1), 1), (8, "测试 x", 1, T(2024, 1, 1), T(2024, 1, 2), 1)],
        "activity_id long, activity_name string, offer_type int, start_time timestamp, end_time timestamp, status int",
    )
    return of.offer_send_fact(sends, campaigns, T(2024, 2, 1)), redeemed, campaigns


def test_several_redemptions_do_not_multiply_sends(spark, rows):
    sends, redeemed, campaigns = _offer_frames(spark)
    stats = of.offer_activity_stats(campaigns, sends, redeemed)
    got = rows(stats, "activity_id", "send_count", "redemption_count", "total_sales", "avg_offer_amount", "total_customers", "avg_redemption_time")
    assert got == [(7, 3, 3, Dec("15.00"), Dec("20.00"), 2, 18.0), (8, 0, 0, None, None, 0, None)]
    effect = of.offer_activity_effect(campaigns, sends, redeemed).where("activity_id = 7").first()
    assert effect["top_product_id"] == 70 and effect["redemption_rate"] == 1.0


def test_product_in_two_campaigns_counts_once(spark, rows):
    sends, redeemed, _ = _offer_frames(spark)
    products = spark.createDataFrame([(70,), (70,)], "product_id long")
    out = of.offer_product_stats(sends, redeemed, products)
    assert rows(out, "product_id", "stat_date", "send_count", "total_sales") == sorted(
        [(70, DAY, 1, Dec("10.00")), (None, DAY, 1, None), (None, ago(1), 1, Dec("5.00"))], key=repr
    )


def test_campaign_flags_and_time_grains(spark, rows):
    sends, redeemed, campaigns = _offer_frames(spark)
    flags = of.offer_activity_fact(campaigns, T(2024, 2, 1))
    assert rows(flags, "activity_id", "is_valid", "is_test_data", "activity_duration") == [(7, 1, 0, 1440.0), (8, 0, 1, 24.0)]
    stats = of.offer_time_stats(sends, redeemed)
    assert rows(stats.where("time_type <> 'day'"), "time_type", "time_value", "send_count", "peak_hour") == [
        ("month", "2024-01", 3, "09:00-09:59"), ("week", "2024-05", 3, "09:00-09:59"),
    ]


def test_rank_change_needs_the_same_department(spark, rows):
    wide = spark.createDataFrame(
        [(1, "A", DAY, 5, 1), (2, "A", DAY, 4, 2), (3, "B", DAY, 9, 1), (1, "A", ago(1), 1, 2), (2, "A", ago(1), 3, 1),
         (3, "A", ago(1), 0, 3)],
        "cs_id long, dept_name string, stat_date date, redemption_count long, rank_in_dept int",
    ).withColumns({"stat_week": F.lit(""), "stat_month": F.lit("")})
    assert rows(of.agent_rank_change(wide, DAY), "cs_id", "rank", "rank_change") == [(1, 1, -1), (2, 2, 1), (3, 1, None)]


def test_agent_days_may_lack_either_side(spark, rows):
    sends, redeemed, _ = _offer_frames(spark)
    out = of.agent_daily_fact(sends, redeemed)
    assert rows(out, "cs_id", "stat_date", "send_count", "redemption_count", "total_sales", "redemption_rate") == sorted(
        [(1, DAY, 2, 2, Dec("10.00"), 1.0), (2, ago(1), 1, 0, Dec("0.00"), 0.0), (2, D(2024, 1, 31), 0, 1, Dec("5.00"), 0.0)],
        key=repr,
    )


SHIFT = (
    "recent_days int, driver1_emp_id long, driver1_name string, driver2_emp_id long, driver2_name string, "
    f"trans_finish_count long, trans_finish_distance {MONEY}, trans_finish_dur_sec double, trans_finish_delay_count long"
)


def test_two_drivers_share_distance_but_not_trips(spark, rows):
    nd = spark.createDataFrame(
        [(7, 1, "A*", None, None, 2, Dec("10.00"), 100.0, 1), (7, 1, "A*", 2, "B*", 1, Dec("5.01"), 50.0, 1)], SHIFT
    )
    out = fr.driver_report(nd)
    assert rows(out, "driver_emp_id", "trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec", "trans_finish_late_count") == [
        (1, 3, Dec("12.5050"), 125.0, 2), (2, 1, Dec("2.5050"), 25.0, 1),
    ]


def test_full_outer_report_keeps_null_areas_apart(spark, rows):
    frame = spark.createDataFrame
    receive = frame([(7, None, 1, Dec("2.00"))], f"recent_days int, city_id long, order_count long, order_amount {MONEY}")
    deliver = frame([(7, None, 3), (7, 1, 4)], "recent_days int, city_id long, order_count long")
    sort = frame([(7, 1, 5)], "recent_days int, city_id long, sort_count long")
    out = fr.express_report(receive, deliver, sort, ["city_id"])
    assert rows(out, "city_id", "deliver_suc_count", "sort_count", "receive_order_count") == sorted(
        [(None, 3, None, None), (1, 4, 5, None), (None, None, None, 1)], key=repr
    )


def test_orders_in_transit(spark):
    totals = lambda n, a: spark.createDataFrame([(n, Dec(a))], f"order_count long, order_amount {MONEY}")
    assert rg(fr.in_transit_td(totals(10, "100.00"), totals(4, "30.00"))) == (6, Dec("70.00"))


def test_scans_without_time_are_left_out(spark, rows):
    scans = spark.createDataFrame(
        [(1, 1, 5, 1704067200, 9, None, None, 1704153600, 8)],
        "id long, order_id long, org_id long, inbound_time long, inbound_emp_id long, sort_time long, sorter_emp_id long, "
        "outbound_time long, outbound_emp_id long",
    )
    assert rows(ff.hub_scan_fact(scans), "kind", "emp_id", "dt") == [
        ("inbound", 9, D(2024, 1, 1)), ("outbound", 8, D(2024, 1, 2)),
    ]


def _freight(spark):
    orders = spark.createDataFrame(
        [(1, "60020", "0"), (2, "60020", "0"), (3, "60020", "1"), (4, "60030", "0")], "id long, status string, is_deleted string"
    ).select(
        "id", "status", "is_deleted", F.lit("n").alias("order_no"), F.lit("c").alias("collect_type"), F.lit(1).alias("user_id"),
        *[F.lit(5).alias(f"{side}_{part}_id") for side in ("sender", "receiver") for part in ("complex", "province", "city", "district")],
        F.lit(T(2024, 1, 9)).alias("estimate_arrive_time"),
        F.lit("Bob").alias("receiver_name"), F.lit("Eve").alias("sender_name"), F.lit(1).alias("cargo_num"),
        F.lit(Dec("9.00")).alias("amount"), F.lit(1).alias("distance"), F.lit(T(2024, 1, 1, 20)).alias("update_time"),
    )
    cargo = spark.createDataFrame([(i, i, "k", Dec("1.00"), "0") for i in (2, 3, 4)], f"id long, order_id long, cargo_type string, weight {MONEY}, is_deleted string")
    cargo = cargo.withColumns({f"volume_{side}": F.lit(n) for n, side in enumerate(("length", "width", "height"))})
    codes = spark.createDataFrame([("60020", "paid", "600")], "dic_code string, dic_name string, parent_code string")
    return orders, cargo.withColumn("create_time", F.lit(T(2024, 1, 1))), codes


def test_milestone_from_open_and_new_orders(spark, rows):
    orders, cargo, codes = _freight(spark)
    was = orders.withColumn("status", F.when(F.col("id") == 1, "60010").otherwise("60030"))
    old = cargo.withColumn("order_id", F.col("order_id") - 1)  # lines of orders 1, 2 and 3
    snapshot = ff.order_process_snapshot(old, was, codes)
    out = ff.order_milestone_fact(cargo, orders, snapshot, codes, "pay")
    # Order 1 was open before payment, order 2 is new, order 2's old line was past payment, order 3 is deleted.
    assert rows(out, "order_id", "id", "status_name", "receiver_name", "dt") == [
        (1, 2, "paid", "B*", D(2024, 1, 2)), (2, 2, "paid", "B*", D(2024, 1, 2)),
    ]
    assert "payment_time" in out.columns
    assert rows(out, "volume_height", "receiver_complex_id", "sender_province_id", "estimate_arrive_time") == [(2, 5, 5, T(2024, 1, 9))] * 2


def test_snapshot_end_dates(spark, rows):
    orders, cargo, codes = _freight(spark)
    done = orders.withColumn("status", F.when(F.col("id") == 2, "60080").otherwise(F.col("status")))
    out = ff.order_process_snapshot(cargo, done, codes)
    assert rows(out, "order_id", "end_date") == [(2, D(2024, 1, 1)), (4, D(9999, 12, 31))]


def test_hub_summaries_count_orders_once(spark, rows):
    detail = spark.createDataFrame(
        [(1, 5, 7, DAY, Dec("9.00")), (1, 5, 7, DAY, Dec("9.00")), (2, 6, 7, DAY, Dec("1.00"))],
        f"order_id long, sender_district_id long, receiver_district_id long, dt date, amount {MONEY}",
    )
    orgs = spark.createDataFrame([(50, "hub", 2, 5)], "id long, org_name string, org_level int, region_id long")
    regions = spark.createDataFrame([(5, "D", 11), (11, "C", 1), (1, "P", None)], "id long, name string, parent_id long")
    out = fs.org_receive_1d(detail, orgs, regions)
    assert rows(out, "org_id", "city_name", "order_count", "order_amount") == sorted(
        [(50, "C", 1, Dec("9.00")), (None, None, 1, Dec("1.00"))], key=repr
    )
    assert rows(fs.org_deliver_1d(detail, orgs, regions), "order_count") == [(2,)]
    assert rows(fs.dispatch_1d(detail), "order_count", "order_amount") == [(2, Dec("10.00"))]
    assert rg(fs.finished_orders_td(detail, DAY)) == (2, Dec("10.00"))
    assert rg(fs.running_total_td(fs.dispatch_1d(detail), ago(1))) == (None, None)


def test_late_trips(spark, rows):
    start = T(2024, 1, 29)
    tasks = spark.createDataFrame(
        [(1, 1, 60), (2, 1, 61), (3, 9, 600)], "id long, shift_id long, minutes int"
    ).select(
        "id", "shift_id", F.lit(1).alias("line_id"), F.lit(50).alias("start_org_id"), F.lit("hub").alias("start_org_name"),
        F.lit(51).alias("end_org_id"), F.lit("end hub").alias("end_org_name"), F.lit(2).alias("order_num"), F.lit(1).alias("driver1_emp_id"), F.lit("Al").alias("driver1_name"),
        F.lit(None).cast("long").alias("driver2_emp_id"), F.lit(None).cast("string").alias("driver2_name"),
        F.lit(1).alias("truck_id"), F.lit("T").alias("truck_no"), (F.unix_millis(F.lit(start))).alias("actual_start_time"),
        (F.unix_millis(F.lit(start)) + F.col("minutes") * 60000).alias("actual_end_time"),
        F.lit(Dec("5.00")).alias("actual_distance"), F.lit("0").alias("is_deleted"),
    )
    shifts = spark.createDataFrame([(1, 60, "line")], "id long, estimated_time int, line_name string")
    finish = ff.transport_finish_fact(tasks, shifts)
    assert rows(finish, "id", "finish_dur_sec", "driver1_name") == [(1, 3600.0, "A*"), (2, 3660.0, "A*"), (3, 36000.0, "A*")]
    orgs = spark.createDataFrame([(50, "hub", 1, 11)], "id long, org_name string, org_level int, region_id long")
    regions = spark.createDataFrame([(11, "C", 1), (1, "P", None)], "id long, name string, parent_id long")
    trucks = spark.createDataFrame([(1, "big", "Big")], "id long, model_type string, model_type_name string")
    out = fs.shift_finish_nd(finish, orgs, regions, shifts, trucks, DAY)
    assert rows(out.where("recent_days = 7"), "shift_id", "trans_finish_count", "trans_finish_delay_count", "city_name") == sorted(
        [(1, 2, 1, "C"), (9, 1, 0, "C")], key=repr
    )


def test_channel_traffic_and_funnel(spark, rows):
    sessions = spark.createDataFrame(
        [("s1", "m1", "c", DAY, 3000, 1), ("s2", "m1", "c", DAY, 2000, 3), ("s3", "m2", "c", ago(5), 999, 1), ("s4", "m3", None, DAY, None, 1)],
        "session_id string, mid_id string, channel string, dt date, during_time long, page_count long",
    )
    out = rp.channel_traffic(sessions, DAY)
    assert rows(out.where("channel = 'c'")) == [
        (1, "c", 1, 2, 2, 2, Dec("0.50")), (30, "c", 2, 1, 1, 3, Dec("0.67")), (7, "c", 2, 1, 1, 3, Dec("0.67")),
    ]
    assert out.where("channel is null").count() == 3


def test_funnel_keeps_days_without_a_step(spark, rows):
    pages = spark.createDataFrame([("home", DAY), ("home", DAY), ("other", ago(1))], "page_id string, dt date")
    users = spark.createDataFrame([(1, DAY), (2, ago(1))], "user_id long, dt date")
    out = rp.action_funnel(pages, users, users.limit(0), users.where("user_id = 1"), "home", "detail")
    assert rows(out) == [(ago(1), 0, 0, 1, 0, 0), (DAY, 2, 0, 1, 0, 1)]


def test_mean_payment_time_is_cut_to_whole_seconds(spark):
    flow = spark.createDataFrame(
        [(T(2024, 1, 30), T(2024, 1, 30, 0, 0, 2), DAY), (T(2024, 1, 30), T(2024, 1, 30, 0, 0, 3), DAY), (T(2024, 1, 30), None, None)],
        "order_time timestamp, payment_time timestamp, payment_date_id date",
    )
    assert rg(rp.order_to_pay_avg(flow, DAY)) == (DAY, 2)
    back = flow.where("payment_date_id is not null").selectExpr(
        "payment_time AS order_time", "order_time AS payment_time", "payment_date_id"
    )
    assert rg(rp.order_to_pay_avg(back, DAY)) == (DAY, -2)


def test_overview_counts_each_agent_and_customer_once(spark, rows):
    sends = spark.createDataFrame(
        [(1, 1, 5, DAY, 1, Dec("2.00")), (2, 1, 6, DAY, 0, Dec("4.00")), (3, 2, 5, ago(6), 1, None), (4, 3, 7, ago(30), 1, Dec("1.00"))],
        f"record_id long, cs_id long, customer_id long, dt date, is_used int, offer_amount {MONEY}",
    )
    out = of.offer_overview(sends, DAY)
    assert rows(out, "recent_days", "total_send_count", "total_redemption_count", "avg_offer_amount", "active_cs_count", "active_customer_count") == [
        (1, 2, 1, Dec("3.00"), 1, 2), (30, 3, 2, Dec("3.00"), 2, 2), (7, 3, 2, Dec("3.00"), 2, 2),
    ]

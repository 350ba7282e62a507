"""The test tables in the roles the operators expect."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import Days, raw_within
from daymill.functions.values import money
from daymill.operators import dimensions as dims
from daymill.operators import freight_facts as ff
from daymill.operators import offers as of
from daymill.operators import trade_facts as tf
from daymill.plans import literals as lit
from daymill.plans.registry import Tables, shared


def instant(c: str) -> Column:
    return F.col(c).cast("timestamp")


@shared
def codes(t: Tables) -> DataFrame:
    return t.spark.sql(f"SELECT * FROM VALUES {lit.CODE_ROWS} AS t(dic_code, dic_name, parent_code)")


# ---- retail -------------------------------------------------------------------


@shared
def order_headers(t: Tables, with_province: bool = True) -> DataFrame:
    """Order headers; the province comes from the customer and is left null where no query reads it."""
    if with_province:
        places = t.customer.select("c_custkey", "c_nationkey")
        rows = t.orders.join(places, F.col("o_custkey") == F.col("c_custkey"), "left")
    else:
        rows = t.orders.withColumn("c_nationkey", F.lit(None).cast("int"))
    return (
        rows.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("c_nationkey").alias("province_id"),
            F.col("o_orderstatus").alias("state"),
            money("o_totalprice").alias("amount"),
            instant("o_orderdate").alias("create_time"),
            F.to_date("o_orderdate").alias("dt"),
        )
    )


@shared
def order_lines(t: Tables) -> DataFrame:
    priced = t.lineitem.withColumns(
        {"price": money("l_extendedprice"), "items": F.col("l_quantity").cast("bigint")}
    ).withColumn("gross", money(F.col("items") * F.col("price")))
    reduced = priced.withColumn("reduction", money(F.col("gross") * F.col("l_discount").cast("decimal(4,2)")))
    gross, reduction = F.col("gross"), F.col("reduction")
    return reduced.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("items").alias("sku_num"),
        F.col("price").alias("order_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.when(F.col("l_linestatus") == "O", reduction).alias("split_activity_amount"),
        F.when(F.col("l_linestatus") == "F", reduction).alias("split_coupon_amount"),
        (gross - reduction).cast("decimal(16,2)").alias("split_total_amount"),
        instant("l_shipdate").alias("create_time"),
        "l_linestatus",
        "l_returnflag",
    )


@shared
def line_activities(t: Tables) -> DataFrame:
    rows = order_lines(t).where(F.col("l_linestatus") == "O")
    return rows.groupBy(F.col("id").alias("order_detail_id")).agg(
        F.min("supplier_id").alias("activity_id"), (F.min("supplier_id") % 7).alias("activity_rule_id")
    )


@shared
def line_coupons(t: Tables) -> DataFrame:
    rows = order_lines(t).where((F.col("l_linestatus") == "F") & (F.col("discount") > 0))
    return rows.groupBy(F.col("id").alias("order_detail_id")).agg(
        F.min((F.col("discount") * 100).cast("int")).alias("coupon_id")
    )


@shared
def order_facts(t: Tables, with_province: bool = False) -> DataFrame:
    """Order line fact without promotion and voucher ids, which no summary reads."""
    return tf.order_detail_fact(order_lines(t), order_headers(t, with_province))


@shared
def payments(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("110"), (F.col("o_orderkey") % 4).cast("string")).alias("payment_type"),
        F.when(F.col("o_orderstatus") == "F", "1602").otherwise("1601").alias("payment_status"),
        (instant("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 72).cast("int"))).alias("callback_time"),
        money("o_totalprice").alias("payment_amount"),
    )


@shared
def payment_facts(t: Tables) -> DataFrame:
    return tf.payment_fact(order_lines(t), order_headers(t, False), payments(t), codes(t))


@shared
def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_type").alias("category_id"),
        F.lower("p_type").alias("category_name"),
        (F.col("p_size") % 2).alias("category1_id"),
        F.concat(F.lit("root "), (F.col("p_size") % 2).cast("string")).alias("category1_name"),
        (F.col("p_size") % 10).alias("category2_id"),
        F.concat(F.lit("group "), (F.col("p_size") % 10).cast("string")).alias("category2_name"),
        F.col("p_size").alias("category3_id"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("category3_name"),
        F.col("p_brand").alias("tm_id"),
        F.lower("p_brand").alias("tm_name"),
    )


@shared
def geo(t: Tables) -> DataFrame:
    provinces = t.nation.select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region_id"),
        (F.col("n_nationkey") + 100).cast("string").alias("area_code"),
        F.concat(F.lit("C-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
        F.concat(F.lit("C-"), F.substring("n_name", 1, 2)).alias("iso_3166_2"),
    )
    regions = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region_name"))
    return dims.geo_dim(provinces, regions)


@shared
def coupon_rules(t: Tables) -> DataFrame:
    """One voucher per discount level."""
    level = (F.col("l_discount").cast("decimal(4,2)") * 100).cast("int")
    return t.lineitem.select(level.alias("id")).distinct().select(
        "id",
        F.concat(F.lit("coupon "), F.col("id").cast("string")).alias("coupon_name"),
        F.concat(F.lit("320"), (F.col("id") % 4).cast("string")).alias("rule_type"),
        (F.col("id") * 10).alias("condition_amount"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("condition_num"),
        F.col("id").alias("benefit_amount"),
        (F.lit(10) - F.col("id") % 10).alias("benefit_discount"),
    )


@shared
def coupon_uses(t: Tables) -> DataFrame:
    """Voucher use events: reduced lines, used when the line ships."""
    lines = order_lines(t).where(F.col("discount") > 0)
    header = order_headers(t, False).select(F.col("order_id").alias("__o"), "user_id")
    return lines.join(header, F.col("order_id") == F.col("__o")).select(
        "id",
        (F.col("discount") * 100).cast("int").alias("coupon_id"),
        "user_id",
        "order_id",
        F.to_date("create_time").alias("dt"),
        F.col("create_time").alias("used_time"),
    )


# ---- traffic ------------------------------------------------------------------


@shared
def page_log(t: Tables, days: Days | None = None) -> DataFrame:
    """Events as JSON log text; error events have no page, every tenth user is not signed in.

    ``days`` stands for the folders of those days: the log is kept by day, so its time is known without the text.
    """
    user = F.col("user_id")

    def mod(prefix: str, n: int) -> Column:
        return F.concat(F.lit(prefix), (user % n).cast("string"))

    common = F.struct(
        mod("", 34).alias("ar"),
        mod("brand", 3).alias("ba"),
        mod("ch", 5).alias("ch"),
        F.when(user % 2 == 0, "1").otherwise("0").alias("is_new"),
        mod("model", 4).alias("md"),
        mod("mid_", 1 << 40).alias("mid"),
        mod("os", 2).alias("os"),
        F.when(user % 10 != 0, user.cast("string")).alias("uid"),
        mod("v", 6).alias("vc"),
        F.concat(user.cast("string"), F.lit("-"), F.date_format(instant("ts"), "yyyyMMdd")).alias("sid"),
    )
    page = F.struct(
        F.get_json_object("props", "$.k").alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.col("event_type").alias("page_id"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
    )
    record = F.struct(
        common.alias("common"),
        F.when(F.col("event_type") != "error", page).alias("page"),
        F.unix_millis(instant("ts")).alias("ts"),
    )
    return t.events.where(raw_within(instant("ts"), days)).select("event_id", F.to_json(record).alias("log"))


@shared
def page_views(t: Tables, days: Days | None = None) -> DataFrame:
    return tf.page_view_fact(page_log(t, days))


@shared
def users(t: Tables) -> DataFrame:
    """Customers who sign up in the month of the events."""
    made = F.lit("2024-01-01 06:00:00").cast("timestamp") + F.make_dt_interval(
        days=(F.col("c_custkey") % 30).cast("int")
    )
    return t.customer.select(F.col("c_custkey").alias("id"), made.alias("create_time"))


@shared
def logins(t: Tables) -> DataFrame:
    return tf.login_fact(page_views(t), "event_id")


# ---- freight ------------------------------------------------------------------


@shared
def regions(t: Tables) -> DataFrame:
    """Tree of provinces (regions), cities (nations) and districts (one per supplier)."""
    provinces = t.region.select(
        (F.col("r_regionkey").cast("bigint") + 1).alias("id"), F.col("r_name").alias("name"),
        F.lit(None).cast("bigint").alias("parent_id"),
    )
    cities = t.nation.select(
        (F.col("n_nationkey").cast("bigint") + 1000).alias("id"), F.col("n_name").alias("name"),
        (F.col("n_regionkey").cast("bigint") + 1).alias("parent_id"),
    )
    districts = t.supplier.select(
        (F.col("s_suppkey") + 100000).alias("id"), F.concat(F.lit("District of "), F.col("s_name")).alias("name"),
        (F.col("s_nationkey").cast("bigint") + 1000).alias("parent_id"),
    )
    return provinces.unionByName(cities).unionByName(districts).withColumn(
        "dict_code", F.concat(F.lit("C"), F.col("id").cast("string"))
    )


@shared
def orgs(t: Tables) -> DataFrame:
    """Hubs: even suppliers sit on a city (level 1), odd ones on their district (level 2)."""
    level = (F.col("s_suppkey") % 2 + 1).cast("int")
    return t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("org_name"),
        level.alias("org_level"),
        F.when(level == 1, F.col("s_nationkey").cast("bigint") + 1000)
        .otherwise(F.col("s_suppkey") + 100000)
        .alias("region_id"),
        F.floor(F.col("s_suppkey") / 10).cast("bigint").alias("org_parent_id"),
    )


def _state(position: Column) -> Column:
    return F.element_at(F.expr(f"array({lit.STATE_LIST})"), (position % 9 + 1).cast("int"))


#: From the day of an order to its last update.
UPDATED_AFTER = dt.timedelta(days=3, hours=18)


@shared
def freight_orders(t: Tables, earlier: bool = False, days: Days | None = None) -> DataFrame:
    """Freight order headers; ``earlier`` gives the state each had in the open snapshot.

    ``days`` are local days of the update time, given on to the day it is made from.
    """
    key = F.col("o_orderkey")
    near = raw_within(instant("o_orderdate"), days, later=UPDATED_AFTER + ff.LOCAL)
    return t.orders.where(near).select(
        key.alias("id"),
        F.concat(F.lit("NO"), key.cast("string")).alias("order_no"),
        _state(F.floor(key / 9) if earlier else key).alias("status"),
        F.concat(F.lit("8000"), F.substring("o_orderpriority", 1, 1)).alias("collect_type"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_custkey") % 25).alias("sender_complex_id"),
        (F.col("o_custkey") % 5 + 1).alias("sender_province_id"),
        (F.col("o_custkey") % 25 + 1000).alias("sender_city_id"),
        (F.col("o_custkey") % 400 + 100000).alias("sender_district_id"),
        (key % 25).alias("receiver_complex_id"),
        (key % 5 + 1).alias("receiver_province_id"),
        (key % 25 + 1000).alias("receiver_city_id"),
        (key % 400 + 100000).alias("receiver_district_id"),
        (instant("o_orderdate") + F.lit(dt.timedelta(days=5))).alias("estimate_arrive_time"),
        F.col("o_orderpriority").alias("receiver_name"),
        F.concat(F.col("o_orderstatus"), F.lit("-sender")).alias("sender_name"),
        F.lit(1).alias("cargo_num"),
        money("o_totalprice").alias("amount"),
        (key % 3000).alias("distance"),
        (instant("o_orderdate") + F.lit(UPDATED_AFTER)).alias("update_time"),
        F.when(key % 50 == 0, "1").otherwise("0").alias("is_deleted"),
    )


@shared
def cargo(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "A", "70001").when(F.col("l_returnflag") == "N", "70002").otherwise("70003")
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        kind.alias("cargo_type"),
        (F.col("l_partkey") % 100 + 1).alias("volume_length"),
        (F.col("l_suppkey") % 50 + 1).alias("volume_width"),
        (F.col("l_linenumber") * 5).alias("volume_height"),
        money("l_quantity").alias("weight"),
        instant("l_shipdate").alias("create_time"),
        F.when(F.col("l_linenumber") == 7, "1").otherwise("0").alias("is_deleted"),
    )


@shared
def freight_details(t: Tables, days: Days | None = None) -> DataFrame:
    return ff.order_cargo_fact(cargo(t), freight_orders(t), codes(t), days)


@shared
def open_orders(t: Tables) -> DataFrame:
    earlier = cargo(t).where(F.col("create_time") < F.lit(lit.OPEN_SNAPSHOT_CUT).cast("timestamp"))
    return ff.order_process_snapshot(earlier, freight_orders(t, earlier=True), codes(t))


@shared
def todays_cargo(t: Tables) -> DataFrame:
    return cargo(t).where(F.col("create_time") >= F.lit(lit.OPEN_SNAPSHOT_CUT).cast("timestamp"))


@shared
def milestone(t: Tables, kind: str, days: Days | None = None) -> DataFrame:
    return ff.order_milestone_fact(todays_cargo(t), freight_orders(t, days=days), open_orders(t), codes(t), kind, days)


@shared
def delivered(t: Tables, days: Days | None = None) -> DataFrame:
    return ff.order_milestone_by_exclusion(
        cargo(t), freight_orders(t, days=days), codes(t), ff.NOT_YET_DELIVERED, "deliver_suc_time", days
    )


@shared
def hub_scans(t: Tables, sorted_on: Days | None = None) -> DataFrame:
    """Scans of each line; ``sorted_on`` are days of the sort scan, a day and up to 7 minutes after shipping."""
    shipped = F.unix_timestamp(instant("l_shipdate"))
    near = raw_within(instant("l_shipdate"), sorted_on, later=dt.timedelta(days=1, minutes=1), most=dt.timedelta(days=1, minutes=7))
    return t.lineitem.where(near).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("org_id"),
        shipped.alias("inbound_time"),
        F.col("l_partkey").alias("inbound_emp_id"),
        F.when(F.col("l_returnflag") != "N", shipped + 86400 + 60 * F.col("l_linenumber")).alias("sort_time"),
        (F.col("l_partkey") + 1).alias("sorter_emp_id"),
        F.when(F.col("l_linestatus") == "F", shipped + 172800).alias("outbound_time"),
        (F.col("l_partkey") + 2).alias("outbound_emp_id"),
    )


@shared
def lines(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t.nation.select(
        n.alias("id"),
        F.concat(F.lit("Line "), F.col("n_name")).alias("name"),
        F.col("n_regionkey").cast("string").alias("line_type_id"),
        n.cast("bigint").alias("start_org_id"),
        ((n + 1) % 25).cast("bigint").alias("end_org_id"),
        (n * 100 + 50).cast("decimal(16,2)").alias("distance"),
        (n * 10 + 5).cast("decimal(16,2)").alias("cost"),
        ((n * 40 + 200) * 1440).alias("estimated_time"),
    )


@shared
def shifts(t: Tables) -> DataFrame:
    raw = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("line_id"))
    return dims.shift_dim(raw, lines(t), codes(t))


@shared
def truck_models(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct().select(
        F.concat_ws("/", "p_brand", "p_type").alias("id"),
        F.concat_ws(" ", "p_type", "p_brand").alias("model_name"),
        F.col("p_type").alias("model_type"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("no "), "p_brand").alias("model_no"),
        F.length("p_type").alias("truck_weight"),
        (F.length("p_type") * 2).alias("load_weight"),
        (F.length("p_type") * 3).alias("total_weight"),
        F.lit("5").alias("eev"),
        (F.length("p_brand") + 1).alias("boxcar_len"),
        (F.length("p_brand") + 2).alias("boxcar_wd"),
        (F.length("p_brand") + 3).alias("boxcar_hg"),
        (F.length("p_type") + 80).alias("max_speed"),
        (F.length("p_type") * 10).alias("oil_vol"),
    )


@shared
def trucks(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").alias("team_id"),
        F.concat_ws("/", "p_brand", "p_type").alias("model_id"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("truck_no"),
        (F.col("p_partkey") + 5000).alias("device_gps_id"),
        F.concat(F.lit("E"), F.col("p_partkey").cast("string")).alias("engine_no"),
        F.date_add(F.lit("2015-01-01").cast("date"), F.col("p_size").cast("int")).alias("license_registration_date"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size").cast("int")).alias("license_last_check_date"),
        F.date_add(F.lit("2026-01-01").cast("date"), F.col("p_size").cast("int")).alias("license_expire_date"),
        (F.col("p_partkey") % 2).cast("string").alias("is_enabled"),
    )
    teams = t.part.select("p_size").distinct().select(
        F.col("p_size").alias("id"),
        F.concat(F.lit("Team "), F.col("p_size").cast("string")).alias("name"),
        F.concat(F.lit("TN"), F.col("p_size").cast("string")).alias("team_no"),
        (F.col("p_size") + 1000).alias("manager_emp_id"),
        (F.col("p_size") % 25).alias("org_id"),
    )
    bases = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("org_name"))
    return dims.truck_dim(raw, teams, truck_models(t), bases, codes(t))


@shared
def transport_tasks(t: Tables, days: Days | None = None) -> DataFrame:
    """Order lines as trips from order day to ship day; a line that ships earlier never ends.

    ``days`` are days of the end, given on to the ship day.
    """
    start, end = instant("o_orderdate"), instant("l_shipdate")
    even = F.col("o_orderkey") % 2 == 0
    key = F.col("l_suppkey")
    ended = t.lineitem.where(raw_within(end, days))
    return ended.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        key.alias("shift_id"),
        (key % 25).alias("line_id"),
        key.alias("start_org_id"),
        F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0")).alias("start_org_name"),
        (F.col("l_partkey") % 10).alias("end_org_id"),
        F.concat(F.lit("End "), (F.col("l_partkey") % 10).cast("string")).alias("end_org_name"),
        F.col("l_linenumber").alias("order_num"),
        key.alias("driver1_emp_id"),
        F.concat(F.lit("S"), key.cast("string")).alias("driver1_name"),
        F.when(even, F.col("o_custkey")).alias("driver2_emp_id"),
        F.when(even, F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("driver2_name"),
        F.col("l_partkey").alias("truck_id"),
        F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("truck_no"),
        F.unix_millis(start).alias("actual_start_time"),
        F.when(end >= start, F.unix_millis(end)).alias("actual_end_time"),
        money("l_quantity").alias("actual_distance"),
        F.when(F.col("l_linenumber") == 7, "1").otherwise("0").alias("is_deleted"),
    )


@shared
def transport_facts(t: Tables, days: Days | None = None) -> DataFrame:
    return ff.transport_finish_fact(transport_tasks(t, days), shifts(t), days)


# ---- offers -------------------------------------------------------------------


@shared
def activities(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("int")
    start = F.lit("1995-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=size)
    length = F.make_dt_interval(days=(F.col("p_partkey") % 2500).cast("int"), hours=size, mins=size)
    return t.part.select(
        F.col("p_partkey").alias("activity_id"),
        F.col("p_name").alias("activity_name"),
        (size % 3 + 1).alias("offer_type"),
        start.alias("start_time"),
        (start + length).alias("end_time"),
        (size % 2).alias("status"),
        (size % 5).alias("shop_id"),
    )


@shared
def sends(t: Tables, days: Days | None = None) -> DataFrame:
    """Orders as sent offers, at some time of the order's day; ``days`` are days of the sending."""
    key = F.col("o_orderkey")
    near = raw_within(instant("o_orderdate"), days, most=dt.timedelta(hours=23, minutes=59))
    sent = instant("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"), mins=(key % 60).cast("int"))
    return t.orders.where(near).select(
        key.alias("record_id"),
        F.col("o_custkey").alias("activity_id"),
        (key % 97).alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 40).alias("cs_id"),
        money("o_totalprice").alias("offer_amount"),
        sent.alias("send_time"),
        F.when(key % 5 != 0, sent + F.make_dt_interval(hours=(key % 2000).cast("int"))).alias("expire_time"),
        F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3).alias("status"),
    )


@shared
def send_facts(t: Tables, days: Days | None = None) -> DataFrame:
    return of.offer_send_fact(sends(t, days), activities(t), offers_now(), days)


def offers_now():
    return dt.datetime.fromisoformat(lit.OFFERS_NOW)


@shared
def redemptions(t: Tables) -> DataFrame:
    """Returned lines, one redemption per order and line number; the seventh line is free."""
    price = money("l_extendedprice")
    offer = F.sum(money(price * F.col("l_discount").cast("decimal(4,2)")))
    hours = F.make_dt_interval(hours=F.col("l_linenumber"))
    return (
        t.lineitem.where(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max(instant("l_shipdate")).alias("ship"), F.sum(price).alias("price"), offer.alias("offer"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("redemption_id"),
            F.col("l_orderkey").alias("record_id"),
            F.col("l_orderkey").alias("order_id"),
            (F.col("ship") + hours).alias("redemption_time"),
            F.col("offer").cast("decimal(16,2)").alias("actual_offer_amount"),
            F.when(F.col("l_linenumber") == 7, F.lit(0)).otherwise(F.col("price") - F.col("offer"))
            .cast("decimal(16,2)").alias("payment_amount"),
        )
    )


@shared
def agents(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("cs_id"),
        F.col("s_name").alias("cs_name"),
        F.concat(F.lit("D"), (F.col("s_nationkey") % 5).cast("string")).alias("department"),
    )


@shared
def offer_products(t: Tables) -> DataFrame:
    """Products of campaigns; one product is in several campaigns."""
    return t.part.where(F.col("p_partkey") % 2 == 0).select((F.col("p_partkey") % 200).alias("product_id"))


# ---- labels -------------------------------------------------------------------


@shared
def entry_stats(t: Tables) -> DataFrame:
    """One entry per user and event type."""
    n = F.count(F.lit(1))
    bought = F.count_if(F.col("value") > 20)
    return t.events.groupBy("user_id", "event_type").agg(
        n.alias("visitor_count"),
        F.count_if(F.dayofmonth("ts") <= 15).alias("new_visitor_count"),
        bought.alias("order_buyer_count"),
        F.round(bought / n, 4).alias("order_conversion_rate"),
        F.round(F.sum(F.col("value").cast("decimal(16,2)")).cast("double") / n, 4).alias("avg_stay_duration"),
    ).select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("entry_id"),
        "visitor_count", "new_visitor_count", "order_buyer_count", "order_conversion_rate", "avg_stay_duration",
        F.concat(F.lit("P"), (F.col("user_id") % 4).cast("string")).alias("time_period"),
        F.col("event_type").alias("entry_page_name"),
    )

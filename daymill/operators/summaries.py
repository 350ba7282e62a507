"""Retail and traffic summaries by day, by window of days and to date.

Facts are aggregated before any dimension is joined, so a hot key is folded
on the map side and the join sees one row per key.  ``day=None`` summarises
every day of the fact table in one pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import in_windows, within
from daymill.operators.dimensions import with_names
from daymill.operators.trade_facts import day_rows

AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "total_amount"]
# Columns a summary takes from its dimension, as far as the dimension has them.
SKU_NAMES = [
    "sku_name", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name", "tm_id", "tm_name",
]
GEO_NAMES = ["province_name", "area_code", "iso_code", "iso_3166_2"]

Day = str | dt.date | None


def _amount_sums():
    return [F.sum(c).alias(c) for c in AMOUNTS]


def _held(dim: DataFrame, names: Sequence[str]) -> dict[str, str]:
    return {c: c for c in names if c in dim.columns}


def per_order(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold lines to one row per order inside each key, so that orders are counted once.

    A plain row count of the result is the number of distinct orders.
    """
    return facts.groupBy(*keys, "order_id").agg(F.sum("sku_num").alias("sku_num"), *_amount_sums())


def user_order_1d(facts: DataFrame, day: Day = None) -> DataFrame:
    """Per user and day: distinct orders, items and amounts."""
    return (
        per_order(day_rows(facts, day), ["user_id", "dt"])
        .groupBy("user_id", "dt")
        .agg(F.count("order_id").alias("order_count"), F.sum("sku_num").alias("order_num"), *_amount_sums())
    )


def user_payment_1d(facts: DataFrame, day: Day = None) -> DataFrame:
    """Per user and day of payment: distinct paid orders, items, amount."""
    paid = day_rows(facts.where(F.col("order_id").isNotNull()), day)
    return (
        paid.groupBy("user_id", "dt", "order_id")
        .agg(F.sum("sku_num").alias("sku_num"), F.sum("payment_amount").alias("payment_amount"))
        .groupBy("user_id", "dt")
        .agg(
            F.count("order_id").alias("payment_count"),
            F.sum("sku_num").alias("payment_num"),
            F.sum("payment_amount").alias("payment_amount"),
        )
    )


def user_cart_1d(facts: DataFrame, day: Day = None) -> DataFrame:
    return (
        day_rows(facts, day)
        .groupBy("user_id", "dt")
        .agg(F.count(F.lit(1)).alias("cart_add_count"), F.sum("sku_num").alias("cart_add_num"))
    )


def geo_order_1d(facts: DataFrame, geo: DataFrame, day: Day = None) -> DataFrame:
    """Per province and day: distinct orders and amounts, then the province's name and codes."""
    daily = (
        per_order(day_rows(facts, day), ["province_id", "dt"])
        .groupBy("province_id", "dt")
        .agg(F.count("order_id").alias("order_count"), *_amount_sums())
    )
    return with_names(daily, geo, "province_id", "province_id", _held(geo, GEO_NAMES))


def user_sku_order_1d(facts: DataFrame, sku: DataFrame, day: Day = None) -> DataFrame:
    """Per user, product and day: lines, items, amounts, with three levels of category and brand."""
    daily = (
        day_rows(facts, day)
        .groupBy("user_id", "sku_id", "dt")
        .agg(F.count("id").alias("order_count"), F.sum("sku_num").alias("order_num"), *_amount_sums())
    )
    return with_names(daily, sku, "sku_id", "sku_id", _held(sku, SKU_NAMES))


def sku_favor_1d(facts: DataFrame, sku: DataFrame, day: Day = None) -> DataFrame:
    daily = day_rows(facts, day).groupBy("sku_id", "dt").agg(F.count(F.lit(1)).alias("favor_add_count"))
    return with_names(daily, sku, "sku_id", "sku_id", _held(sku, SKU_NAMES))


def user_coupon_1d(facts: DataFrame, coupons: DataFrame, day: Day = None) -> DataFrame:
    daily = day_rows(facts, day).groupBy("user_id", "coupon_id", "dt").agg(F.count(F.lit(1)).alias("used_count"))
    names = {"coupon_name": "coupon_name", "rule_type_name": "coupon_type_name", "benefit_rule": "benefit_rule"}
    return with_names(daily, coupons, "coupon_id", "id", names)


def session_page_1d(views: DataFrame, day: Day = None) -> DataFrame:
    """Per session with its device and channel: stay and pages."""
    keys = ["session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel", "dt"]
    return (
        day_rows(views, day)
        .groupBy(*keys)
        .agg(F.sum("during_time").alias("during_time"), F.count(F.lit(1)).alias("page_count"))
    )


def visitor_page_1d(views: DataFrame, day: Day = None) -> DataFrame:
    """Per visitor and page: stay and views."""
    return (
        day_rows(views, day)
        .groupBy("mid_id", "brand", "model", "operate_system", "page_id", "dt")
        .agg(F.sum("during_time").alias("during_time"), F.count(F.lit(1)).alias("view_count"))
    )


def rolling_window_rollup(
    daily: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    as_of: str | dt.date,
    days: Sequence[int] = (7, 30),
    shape: str = "wide",
    day: str = "dt",
) -> DataFrame:
    """Sums of a daily table over the last n days, one scan for all windows.

    ``wide`` gives one row per key with columns such as ``order_count_7d``,
    ``long`` one row per key and window with column ``recent_days``.
    """
    if shape == "long":
        rows = in_windows(daily, as_of, days, day).groupBy(*keys, "recent_days")
        return rows.agg(*[F.sum(m).alias(m) for m in measures])
    rows = daily.where(within(day, as_of, max(days)))
    sums = [
        F.sum(F.when(within(day, as_of, n), F.col(m))).alias(f"{m}_{n}d")
        for n in days
        for m in measures
    ]
    return rows.groupBy(*keys).agg(*sums)


def user_order_td(daily: DataFrame) -> DataFrame:
    """To-date totals per user with first and last order day."""
    return daily.groupBy("user_id").agg(
        F.min("dt").alias("order_date_first"),
        F.max("dt").alias("order_date_last"),
        F.sum("order_count").alias("order_count"),
        F.sum("order_num").alias("order_num"),
        *_amount_sums(),
    )


def roll_forward(previous: DataFrame, today: DataFrame, keys: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """To-date table of today from yesterday's table and today's rows only.

    ``rules`` names for each column how two values combine: sum, min or max.
    """
    both = previous.select(*keys, *rules).unionByName(today.select(*keys, *rules))
    return both.groupBy(*keys).agg(*[getattr(F, how)(c).alias(c) for c, how in rules.items()])


def user_login_td(users: DataFrame, logins: DataFrame) -> DataFrame:
    """To-date login per user: last day, first day, count; users without a login count 1 on their register day."""
    seen = logins.groupBy(F.col("user_id").cast("string").alias("__u")).agg(
        F.max("date_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    made = F.to_date("create_time")
    return users.join(seen, F.col("id").cast("string") == F.col("__u"), "left").select(
        F.col("id").alias("user_id"),
        F.coalesce("last", made).alias("login_date_last"),
        made.alias("login_date_first"),
        F.coalesce("n", F.lit(1)).alias("login_count_td"),
    )

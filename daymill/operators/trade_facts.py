"""Retail order, payment, traffic and user facts.

Order lines are joined to headers by order id as plain joins: adaptive
execution splits an order that holds a large share of the lines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.functions.days import as_date, millis_to_timestamp
from daymill.functions.values import MONEY, money

PAID = "1602"
RECEIVED = "1004"

LOG_SCHEMA = T.StructType(
    [
        T.StructField(
            "common",
            T.StructType([T.StructField(n, T.StringType()) for n in "ar ba ch is_new md mid os uid vc sid".split()]),
        ),
        T.StructField(
            "page",
            T.StructType(
                [
                    T.StructField(n, T.StringType())
                    for n in "item item_type last_page_id page_id from_pos_id from_pos_seq refer_id during_time".split()
                ]
            ),
        ),
        T.StructField("ts", T.StringType()),
    ]
)

DEVICE_COLUMNS = ["channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system"]


def _detail_sources(
    detail: DataFrame, orders: DataFrame, activity: DataFrame | None, coupon: DataFrame | None
) -> DataFrame:
    """Order lines with the user and province of the order, promotion and voucher.

    Promotion and voucher tables hold one row per line; without one its
    columns are null.
    """
    header = orders.select(F.col("order_id").alias("__o"), "user_id", "province_id")
    out = detail.join(header, F.col("order_id") == F.col("__o"), "left").drop("__o")
    for side, columns in ((activity, ["activity_id", "activity_rule_id"]), (coupon, ["coupon_id"])):
        if side is None:
            out = out.withColumns({c: F.lit(None).cast("bigint") for c in columns})
        else:
            side = side.select(F.col("order_detail_id").alias("__d"), *columns)
            out = out.join(side, F.col("id") == F.col("__d"), "left").drop("__d")
    return out


def order_detail_fact(
    detail: DataFrame, orders: DataFrame, activity: DataFrame | None = None, coupon: DataFrame | None = None
) -> DataFrame:
    """Order line fact: amount before reductions is items times price, missing reductions are 0."""
    lines = _detail_sources(detail, orders, activity, coupon)
    return lines.select(
        "id",
        "order_id",
        "user_id",
        "sku_id",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        F.to_date("create_time").alias("dt"),
        "create_time",
        "sku_num",
        money(F.col("sku_num") * F.col("order_price")).alias("original_amount"),
        F.coalesce("split_activity_amount", F.lit(0).cast(MONEY)).alias("activity_reduce_amount"),
        F.coalesce("split_coupon_amount", F.lit(0).cast(MONEY)).alias("coupon_reduce_amount"),
        F.col("split_total_amount").alias("total_amount"),
    )


def first_of_order(rows: DataFrame, time_col: str, columns: list[str]) -> DataFrame:
    """The earliest row per order, rows without a time last; folded before the shuffle."""
    first = F.min(F.struct(F.col(time_col).isNull().alias("late"), time_col, *columns))
    return rows.groupBy("order_id").agg(first.alias("__first")).select("order_id", *[f"__first.{c}" for c in [time_col, *columns]])


def payment_fact(
    detail: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    codes: DataFrame,
    activity: DataFrame | None = None,
    coupon: DataFrame | None = None,
) -> DataFrame:
    """Order lines with the successful payment of their order.

    Payments are filtered and folded to the first of each order before the
    join, so lines of unpaid orders stay, with nulls, and a line stays one
    row however often its order was paid.  The original amount is what was
    paid plus both reductions.
    """
    paid = first_of_order(payments.where(F.col("payment_status") == PAID), "callback_time", ["user_id", "payment_type"])
    paid = paid.select(F.col("order_id").alias("__p"), F.col("user_id").alias("pay_user_id"), "payment_type", "callback_time")
    names = codes.where(F.col("parent_code") == "11").select(
        F.col("dic_code").alias("__d"), F.col("dic_name").alias("payment_type_name")
    )
    zero = F.lit(0).cast(MONEY)
    activity_part = F.coalesce("split_activity_amount", zero)
    coupon_part = F.coalesce("split_coupon_amount", zero)
    return (
        _detail_sources(detail, orders, activity, coupon)
        .drop("user_id")
        .join(paid, F.col("order_id") == F.col("__p"), "left")
        .join(names, F.col("payment_type") == F.col("__d"), "left")
        .select(
            "id",
            F.col("__p").alias("order_id"),
            F.col("pay_user_id").alias("user_id"),
            "sku_id",
            "province_id",
            "activity_id",
            "activity_rule_id",
            "coupon_id",
            "payment_type",
            "payment_type_name",
            F.to_date("callback_time").alias("dt"),
            "callback_time",
            "sku_num",
            money(activity_part + coupon_part + F.col("split_total_amount")).alias("original_amount"),
            activity_part.alias("activity_reduce_amount"),
            coupon_part.alias("coupon_reduce_amount"),
            F.col("split_total_amount").alias("payment_amount"),
        )
    )


def trade_flow_fact(orders: DataFrame, payments: DataFrame, status_log: DataFrame) -> DataFrame:
    """One row per order with the days of order, payment and receipt; missing steps are null.

    Several payments count with their first time and the sum of what was
    paid, several receipts with the first.
    """
    paid = (
        payments.where(F.col("payment_status") == PAID)
        .groupBy(F.col("order_id").alias("__p"))
        .agg(F.min("callback_time").alias("payment_time"), F.sum("payment_amount").alias("__sum"))
        .withColumn("payment_amount", F.col("__sum").cast(payments.schema["payment_amount"].dataType))
        .drop("__sum")
    )
    received = (
        status_log.where(F.col("order_status") == RECEIVED)
        .groupBy(F.col("order_id").alias("__s"))
        .agg(F.min("create_time").alias("finish_time"))
    )
    return (
        orders.join(paid, F.col("order_id") == F.col("__p"), "left")
        .join(received, F.col("order_id") == F.col("__s"), "left")
        .select(
            "order_id",
            "user_id",
            "province_id",
            F.to_date("create_time").alias("order_date_id"),
            F.col("create_time").alias("order_time"),
            F.to_date("payment_time").alias("payment_date_id"),
            "payment_time",
            F.to_date("finish_time").alias("finish_date_id"),
            "finish_time",
            money(F.col("amount") + F.col("activity_reduce_amount") + F.col("coupon_reduce_amount")).alias(
                "original_amount"
            ),
            "activity_reduce_amount",
            "coupon_reduce_amount",
            F.col("amount").alias("total_amount"),
            "payment_amount",
        )
    )


def filtered_event_fact(
    df: DataFrame, time_col: str, columns: list[str], condition: Column | None = None, timed: bool = True
) -> DataFrame:
    """Event fact: rows that meet ``condition``, with the day of their time.

    Rows without a time are left out if ``timed`` (a voucher not used is no event), else kept without a day.
    """
    rows = df if condition is None else df.where(condition)
    return (rows.where(F.col(time_col).isNotNull()) if timed else rows).select(
        *columns, F.to_date(time_col).alias("date_id"), F.col(time_col).alias("event_time")
    )


def _parsed(log: DataFrame) -> DataFrame:
    """Parse the log text; only rows about a page are kept.

    The parsed record passes through a generator, because a filter on a plain
    column would be pushed below it and parse every text a second time.
    """
    kept = [c for c in log.columns if c != "log"]
    record = F.explode_outer(F.array(F.from_json("log", LOG_SCHEMA))).alias("__j")
    return log.select(*kept, record).where(F.col("__j.page").isNotNull())


def page_view_fact(log: DataFrame) -> DataFrame:
    """Page views from JSON log text, time in UTC, stay as bigint."""
    names = {
        "common.ar": "province_id",
        "common.ba": "brand",
        "common.ch": "channel",
        "common.is_new": "is_new",
        "common.md": "model",
        "common.mid": "mid_id",
        "common.os": "operate_system",
        "common.uid": "user_id",
        "common.vc": "version_code",
        "page.item": "page_item",
        "page.item_type": "page_item_type",
        "page.last_page_id": "last_page_id",
        "page.page_id": "page_id",
        "page.from_pos_id": "from_pos_id",
        "page.from_pos_seq": "from_pos_seq",
        "page.refer_id": "refer_id",
        "common.sid": "session_id",
    }
    view_time = millis_to_timestamp("__j.ts")
    kept = [c for c in log.columns if c != "log"]
    return _parsed(log).select(
        *kept,
        *[F.col(f"__j.{path}").alias(name) for path, name in names.items()],
        F.col("__j.page.during_time").try_cast("bigint").alias("during_time"),
        view_time.alias("view_time"),
        F.to_date(view_time).alias("dt"),
    )


def _first_view(views: DataFrame, key: str, tie: str) -> DataFrame:
    """Device and time of the first view per key, found by an aggregate.

    ``min_by`` folds before the shuffle; a ranking window would have to bring
    every view of one key to a single task.
    """
    first = F.min_by(F.struct("user_id", "view_time", *DEVICE_COLUMNS), F.struct("view_time", tie))
    return views.groupBy(F.col(key).alias("__key")).agg(first.alias("__first")).select("__key", "__first.*")


def login_fact(views: DataFrame, tie: str, utc_offset: str = "GMT+8") -> DataFrame:
    """One login per session: its first view that has a user, in local time."""
    first = _first_view(views.where(F.col("user_id").isNotNull()), "session_id", tie)
    local = F.from_utc_timestamp("view_time", utc_offset)
    return first.select(
        "user_id",
        F.col("__key").alias("session_id"),
        F.to_date(local).alias("date_id"),
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("login_time"),
        *DEVICE_COLUMNS,
    )


def register_fact(users: DataFrame, views: DataFrame, tie: str) -> DataFrame:
    """New users with the device of their first view, one row per user."""
    first = _first_view(views.where(F.col("user_id").isNotNull()), "user_id", tie).drop("view_time", "user_id")
    return users.join(first, F.col("id").cast("string") == F.col("__key"), "left").select(
        F.col("id").alias("user_id"),
        F.to_date("create_time").alias("date_id"),
        "create_time",
        *DEVICE_COLUMNS,
    )


def day_rows(df: DataFrame, day: str | dt.date | None, day_column: str = "dt") -> DataFrame:
    """Rows of one day, or all days when none is given (a backfill)."""
    return df if day is None else df.where(F.col(day_column) == F.lit(as_date(day)))

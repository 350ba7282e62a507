"""Retail reports: windows, funnels, retention, paths, repeat purchase."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from daymill.functions.days import REPORT_WINDOWS, as_date, in_windows, seconds_between, within
from daymill.operators.ranking import steps_in_session, top_in_group
from daymill.operators.summaries import rolling_window_rollup

DayText = str | dt.date


def coupon_report(daily: DataFrame) -> DataFrame:
    """Uses and users per coupon, from the daily uses per user and coupon."""
    per_user = daily.groupBy("coupon_id", "coupon_name", "user_id").agg(F.sum("used_count").alias("n"))
    return per_user.groupBy("coupon_id", "coupon_name").agg(
        F.sum("n").cast("bigint").alias("used_count"), F.count("user_id").alias("used_user_count")
    )


def new_order_users(td: DataFrame, as_of: DayText, days: Sequence[int] = REPORT_WINDOWS) -> DataFrame:
    """Users whose first order lies in the last n days."""
    return in_windows(td, as_of, days, "order_date_first").groupBy("recent_days").agg(
        F.count(F.lit(1)).alias("new_order_user_count")
    )


def geo_order_report(wide: DataFrame, days: Sequence[int] = REPORT_WINDOWS) -> DataFrame:
    """Orders and amount per province and window, unfolded from the wide table of all windows.

    A province without orders in a window has no row for it.  Codes of the
    province are kept if the wide table is keyed by them too.
    """
    windows = F.array(
        *[
            F.struct(
                F.lit(n).alias("recent_days"),
                F.col(f"order_count_{n}d").alias("order_count"),
                F.col(f"total_amount_{n}d").alias("order_total_amount"),
            )
            for n in days
        ]
    )
    names = [c for c in ("province_name", "area_code", "iso_code", "iso_3166_2") if c in wide.columns]
    rows = wide.select("province_id", *names, F.inline(windows))
    return rows.where(F.col("order_count").isNotNull())


def consecutive_order_users(daily: DataFrame, as_of: DayText, n: int = 3, span: int = 7) -> DataFrame:
    """Users with orders on ``n`` days in a row within the last ``span`` days.

    A user has at most ``span`` rows here, one per day.
    """
    days = daily.where(within("dt", as_of, span)).select("user_id", "dt").distinct()
    later = F.lead("dt", n - 1).over(Window.partitionBy("user_id").orderBy("dt"))
    runs = days.withColumn("gap", F.datediff(later, "dt")).where(F.col("gap") == n - 1)
    return runs.select("user_id").distinct().agg(F.count("user_id").alias("user_count")).select(
        F.lit(as_date(as_of)).alias("dt"), F.lit(span).alias("recent_days"), "user_count"
    )


def order_report_by_group(
    daily: DataFrame, keys: Sequence[str], as_of: DayText, days: Sequence[int] = REPORT_WINDOWS
) -> DataFrame:
    """Orders and buyers per category or brand for windows of days.

    Folded per user first, so that counting buyers needs no distinct.
    """
    per_user = rolling_window_rollup(daily, [*keys, "user_id"], ["order_count"], as_of, days, "long")
    return per_user.groupBy("recent_days", *keys).agg(
        F.sum("order_count").alias("order_count"),
        F.count(F.when(F.col("order_count") > 0, F.col("user_id"))).alias("order_user_count"),
    )


def order_to_pay_avg(flow: DataFrame, day: DayText | None = None) -> DataFrame:
    """Mean whole seconds from order to payment, for payments of one day or per payment day."""
    paid = flow.where(F.col("payment_date_id").isNotNull())
    if day is not None:
        paid = paid.where(F.col("payment_date_id") == F.lit(as_date(day)))
    seconds = seconds_between("order_time", "payment_time")
    return paid.groupBy(F.col("payment_date_id").alias("dt")).agg(
        F.call_function("div", F.sum(seconds), F.count(seconds)).alias("order_to_pay_interval_avg")
    )


def page_path(views: DataFrame, session: str, time: str, tie: str, page: str) -> DataFrame:
    """Counted page transitions with step labels; the last page of a session leads to ``null``."""
    steps = steps_in_session(views, session, time, tie, page)
    target = F.concat(F.lit("step-"), (F.col("step") + 1).cast("string"), F.lit(":"), F.col("next_page_id"))
    return (
        steps.groupBy("step", "page_id", "next_page_id")
        .agg(F.count(F.lit(1)).alias("path_count"))
        .select(
            F.concat(F.lit("step-"), F.col("step").cast("string"), F.lit(":"), F.col("page_id")).alias("source"),
            F.coalesce(target, F.lit("null")).alias("target"),
            "path_count",
        )
    )


def repeat_purchase_rate(user_sku_nd: DataFrame, as_of: DayText, window: int = 30) -> DataFrame:
    """Per brand: share of buyers with two or more orders among buyers with one or more."""
    per_user = user_sku_nd.groupBy("user_id", "tm_id", "tm_name").agg(
        F.sum(f"order_count_{window}d").alias("order_count")
    )
    again, once = F.count_if(F.col("order_count") >= 2), F.count_if(F.col("order_count") >= 1)
    return per_user.groupBy("tm_id", "tm_name").agg(
        (again / F.nullif(once, F.lit(0))).cast("decimal(16,2)").alias("order_repeat_rate")
    ).select(F.lit(as_date(as_of)).alias("dt"), F.lit(window).alias("recent_days"), "*")


def cart_top3_by_category(cart: DataFrame, sku: DataFrame, n: int = 3) -> DataFrame:
    """Products with the highest cart quantity in each category, ties kept."""
    per_sku = cart.groupBy(F.col("sku_id").alias("__s")).agg(F.sum("sku_num").alias("cart_num"))
    named = per_sku.join(
        sku.select("sku_id", "sku_name", "category_id", "category_name"), F.col("__s") == F.col("sku_id"), "left"
    ).select(F.col("__s").alias("sku_id"), "sku_name", "category_id", "category_name", "cart_num")
    return top_in_group(named, ["category_id"], "cart_num", n)


def favor_top3_by_brand(daily: DataFrame, n: int = 3) -> DataFrame:
    """Products with the most favourites in each brand, ties kept."""
    rows = daily.select("tm_id", "tm_name", "sku_id", "sku_name", F.col("favor_add_count").alias("favor_add_count_1d"))
    return top_in_group(rows, ["tm_id"], "favor_add_count_1d", n)


def channel_traffic(sessions: DataFrame, as_of: DayText, days: Sequence[int] = REPORT_WINDOWS) -> DataFrame:
    """Per channel and window: visitors, mean stay and pages, sessions, share of one-page sessions.

    Folded per visitor first, so visitors are counted without a distinct.
    """
    per_visitor = in_windows(sessions, as_of, days).groupBy("recent_days", "channel", "mid_id").agg(
        F.sum("during_time").alias("stay"),
        F.sum("page_count").alias("pages"),
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("page_count") == 1).alias("bounces"),
    )
    total = F.sum("sessions")
    return per_visitor.groupBy("recent_days", "channel").agg(
        F.count("mid_id").alias("uv_count"),
        F.floor(F.sum("stay") / total / 1000).cast("bigint").alias("avg_duration_sec"),
        F.floor(F.sum("pages") / total).cast("bigint").alias("avg_page_count"),
        total.alias("sv_count"),
        (F.sum("bounces") / total).cast("decimal(16,2)").alias("bounce_rate"),
    )


def action_funnel(
    pages: DataFrame, cart: DataFrame, orders: DataFrame, payments: DataFrame, home: str, detail: str
) -> DataFrame:
    """Per day: home and detail visitors, cart users, order users, paying users; 0 for a step nobody took."""
    steps = [
        pages.where(F.col("page_id").isin(home, detail)).groupBy("dt").agg(
            F.count_if(F.col("page_id") == home).alias("home_count"),
            F.count_if(F.col("page_id") == detail).alias("good_detail_count"),
        )
    ]
    for df, name in ((cart, "cart_count"), (orders, "order_count"), (payments, "payment_count")):
        steps.append(df.groupBy("dt").agg(F.count(F.lit(1)).alias(name)))
    out = steps[0]
    for step in steps[1:]:
        out = out.join(step, "dt", "full_outer")
    return out.na.fill(0)


def churn_and_return(today: DataFrame, yesterday: DataFrame, as_of: DayText) -> DataFrame:
    """Users last seen exactly 7 days ago, and users back today after 8 or more days away.

    Both inputs are to-date login tables, of ``as_of`` and of the day before.
    """
    day = as_date(as_of)
    lost = today.where(F.col("login_date_last") == F.lit(day - dt.timedelta(days=7))).agg(
        F.count(F.lit(1)).alias("user_churn_count")
    )
    active = today.where(F.col("login_date_last") == F.lit(day)).select("user_id")
    away = yesterday.where(F.col("login_date_last") <= F.lit(day - dt.timedelta(days=8))).select("user_id")
    back = active.join(away, "user_id", "left_semi").agg(F.count(F.lit(1)).alias("user_back_count"))
    return lost.select(F.lit(day).alias("dt"), "user_churn_count", back.scalar().alias("user_back_count"))


def retention(login_td: DataFrame, as_of: DayText, span: int = 7) -> DataFrame:
    """For each register day of the last ``span``: new users, those active today, and the rate in percent."""
    day = as_date(as_of)
    recent = login_td.where(
        (F.col("login_date_first") >= F.lit(day - dt.timedelta(days=span))) & (F.col("login_date_first") < F.lit(day))
    )
    kept = F.count_if(F.col("login_date_last") == F.lit(day))
    return recent.groupBy(F.col("login_date_first").alias("create_date")).agg(
        kept.alias("retention_count"),
        F.count(F.lit(1)).alias("new_user_count"),
        (kept / F.count(F.lit(1)) * 100).cast("decimal(16,2)").alias("retention_rate"),
    ).select(F.lit(day).alias("dt"), "*", F.datediff(F.lit(day), "create_date").alias("retention_day"))


def user_activity(login_td: DataFrame, as_of: DayText, days: Sequence[int] = REPORT_WINDOWS) -> DataFrame:
    """New and active users for windows of days."""
    new = F.datediff(F.lit(as_date(as_of)), "login_date_first") < F.col("recent_days")
    return in_windows(login_td, as_of, days, "login_date_last").groupBy("recent_days").agg(
        F.count_if(new).alias("new_user_count"), F.count(F.lit(1)).alias("active_user_count")
    )



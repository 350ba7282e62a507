"""Customer-service offers: campaigns, sends, redemptions, agents.

A sent offer may be redeemed several times.  Redemptions are folded to one
row per sent offer before they are joined, so neither counts of sends nor
amounts are multiplied.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import REPORT_WINDOWS, Days, as_date, hours_between, in_windows, iso_week, raw_within
from daymill.functions.values import MONEY, decimal_ratio, money, ratio
from daymill.operators.dimensions import with_names
from daymill.operators.ranking import rank_in_group

UNUSED, USED, EXPIRED = 1, 2, 3


def _instant(as_of: dt.datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def offer_activity_fact(activities: DataFrame, as_of: dt.datetime, test_pattern: str = "%测试%") -> DataFrame:
    """Campaign with its length in hours, whether it still runs, and whether it is test data."""
    running = (F.col("status") == 1) & (F.col("end_time") > _instant(as_of))
    return activities.withColumns(
        {
            "activity_duration": F.round(hours_between("start_time", "end_time"), 2),
            "is_valid": F.when(running, 1).otherwise(0),
            "is_test_data": F.when(F.col("activity_name").like(test_pattern), 1).otherwise(0),
        }
    )


def offer_send_fact(sends: DataFrame, activities: DataFrame, as_of: dt.datetime, days: Days | None = None) -> DataFrame:
    """Sent offer with its campaign; ``remaining_time`` is null without a limit, 0 once it is over.

    ``days`` (first, last) bounds the scan of the sends.
    """
    sends = sends.where(raw_within("send_time", days))
    now = _instant(as_of)
    over = F.col("expire_time") < now
    named = with_names(
        sends, activities, "activity_id", "activity_id", {"activity_name": "activity_name", "offer_type": "offer_type"}
    )
    return named.withColumns(
        {
            "dt": F.to_date("send_time"),
            "hour_str": F.date_format("send_time", "HH"),
            "is_used": F.when(F.col("status") == USED, 1).otherwise(0),
            "is_expired": F.when((F.col("status") == EXPIRED) | F.coalesce(over, F.lit(False)), 1).otherwise(0),
            "remaining_time": F.when(F.col("expire_time").isNull(), F.lit(None).cast("double"))
            .when(over, F.lit(0.0))
            .otherwise(F.round(hours_between(now, "expire_time"), 2)),
        }
    )


def offer_redemption_fact(redemptions: DataFrame) -> DataFrame:
    """Redeemed offer with its rate (null when nothing was paid) and the amount before the offer."""
    return redemptions.withColumns(
        {
            "redemption_date": F.to_date("redemption_time"),
            "redemption_hour": F.date_format("redemption_time", "HH"),
            "offer_rate": decimal_ratio("actual_offer_amount", "payment_amount", 4),
            "original_amount": money(F.col("payment_amount") + F.col("actual_offer_amount")),
        }
    )


def agent_daily_fact(sends: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Per agent and day: offers sent and offers redeemed, either of which may be missing."""
    sent = sends.groupBy("cs_id", F.to_date("send_time").alias("stat_date")).agg(
        F.count(F.lit(1)).alias("send_count"), F.sum("offer_amount").alias("total_offer_amount")
    )
    per_record = redemptions.groupBy("record_id", F.to_date("redemption_time").alias("stat_date")).agg(
        F.count("redemption_id").alias("n"), F.sum("payment_amount").alias("sales")
    )
    redeemed = (
        per_record.join(sends.select("record_id", "cs_id"), "record_id")
        .groupBy("cs_id", "stat_date")
        .agg(F.sum("n").alias("redemption_count"), F.sum("sales").alias("total_sales"))
    )
    counts, sums = ["send_count", "redemption_count"], ["total_offer_amount", "total_sales"]
    both = sent.join(redeemed, ["cs_id", "stat_date"], "full_outer").withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts}
        | {c: F.coalesce(c, F.lit(0)).cast(MONEY) for c in sums}
    )
    zero = F.lit(0.0)
    return both.withColumns(
        {
            "avg_offer_amount": F.coalesce(money(decimal_ratio("total_offer_amount", "send_count")), money(zero)),
            "avg_order_amount": F.coalesce(money(decimal_ratio("total_sales", "redemption_count")), money(zero)),
            "redemption_rate": F.coalesce(ratio("redemption_count", "send_count", 4), zero),
        }
    )


def with_redemptions(sends: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Sends with the number, sales, waiting seconds and rates of their redemptions."""
    rate = F.when(
        F.col("payment_amount") > 0, F.col("actual_offer_amount").cast("double") / F.col("payment_amount").cast("double")
    )
    folded = redemptions.groupBy(F.col("record_id").alias("__r")).agg(
        F.count("redemption_id").alias("redemptions"),
        F.sum("payment_amount").alias("sales"),
        F.sum(F.unix_timestamp("redemption_time")).alias("__seconds"),
        F.sum(rate).alias("rate_sum"),
        F.count(rate).alias("rate_count"),
    )
    return (
        sends.join(folded, F.col("record_id") == F.col("__r"), "left")
        .withColumn("wait_seconds", F.col("__seconds") - F.col("redemptions") * F.unix_timestamp("send_time"))
        .drop("__r", "__seconds")
    )


def _send_measures() -> list[Column]:
    return [
        F.count("record_id").alias("send_count"),
        F.coalesce(F.sum("redemptions"), F.lit(0)).alias("redemption_count"),
        ratio(F.sum("redemptions"), F.count("record_id"), 4).alias("__rate"),
        F.sum("sales").alias("total_sales"),
        decimal_ratio(F.sum("offer_amount"), F.count("offer_amount")).alias("avg_offer_amount"),
        F.max("offer_amount").alias("max_offer_amount"),
        F.min("offer_amount").alias("min_offer_amount"),
        ratio(F.sum("wait_seconds"), F.sum("redemptions") * 3600, 2).alias("avg_redemption_time"),
        ratio(F.sum("rate_sum"), F.sum("rate_count"), 4).alias("avg_offer_rate"),
    ]


def _summed(rows: DataFrame, keys: Sequence[str | Column], *extra: Column) -> DataFrame:
    out = rows.groupBy(*keys).agg(*_send_measures(), *extra)
    return out.withColumn("redemption_rate", F.coalesce("__rate", F.lit(0.0))).drop("__rate")


def offer_activity_stats(activities: DataFrame, sends: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Per campaign: sends, redemptions, customers, sales, offers and the wait until redemption."""
    per = _summed(
        with_redemptions(sends, redemptions),
        [F.col("activity_id").alias("__a")],
        F.count_distinct("customer_id").alias("total_customers"),
    ).drop("avg_offer_rate")
    return (
        activities.select(
            "activity_id",
            "activity_name",
            F.to_date("start_time").alias("start_date"),
            F.to_date("end_time").alias("end_date"),
            "status",
        )
        .join(per, F.col("activity_id") == F.col("__a"), "left")
        .drop("__a")
        .na.fill(0, ["send_count", "redemption_count", "total_customers"])
    )


def offer_product_stats(sends: DataFrame, redemptions: DataFrame, products: DataFrame) -> DataFrame:
    """Per product and day of sending; a product in several campaigns is not counted twice.

    Sends of products that are in no campaign are kept under a null product.
    """
    listed = products.select(F.col("product_id").alias("__p")).distinct()
    rows = with_redemptions(sends, redemptions).join(listed, F.col("product_id") == F.col("__p"), "left")
    stats = _summed(rows, [F.col("__p").alias("product_id"), F.to_date("send_time").alias("stat_date")])
    return stats.withColumn(
        "product_name", F.concat(F.lit("商品-"), F.col("product_id").cast("string"))
    ).drop("avg_offer_amount")


# Sums that add up over any split of the sends, and what is made of them.
_SUMS = {
    "__sends": lambda: F.count("record_id"),
    "__uses": lambda: F.sum("redemptions"),
    "__sales": lambda: F.sum("sales"),
    "__offered": lambda: F.sum("offer_amount"),
    "__offers": lambda: F.count("offer_amount"),
    "__wait": lambda: F.sum("wait_seconds"),
}


def offer_time_stats(sends: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Per day, week and month in one table.

    Sends are folded to plain sums per day and hour first; only these few
    rows are unfolded to the three grains, and the median and the most
    frequent hour come from the counts of at most 24 hours.
    """
    sent = F.col("send_time")
    hourly = (
        with_redemptions(sends, redemptions)
        .groupBy(F.to_date(sent).alias("day"), F.hour(sent).alias("hour"))
        .agg(*[made().alias(name) for name, made in _SUMS.items()])
    )
    grains = F.array(
        F.struct(F.lit("day").alias("time_type"), F.date_format("day", "yyyy-MM-dd").alias("time_value")),
        F.struct(F.lit("week").alias("time_type"), iso_week("day").alias("time_value")),
        F.struct(F.lit("month").alias("time_type"), F.date_format("day", "yyyy-MM").alias("time_value")),
    )
    by_hour = (
        hourly.select("*", F.inline(grains))
        .groupBy("time_type", "time_value", "hour")
        .agg(*[F.sum(name).alias(name) for name in _SUMS])
    )
    # Rows with an hour, in order: (hour, sends).
    hours = F.sort_array(F.collect_list(F.when(F.col("hour").isNotNull(), F.struct("hour", F.col("__sends").alias("n")))))
    total = by_hour.groupBy("time_type", "time_value").agg(*[F.sum(name).alias(name) for name in _SUMS], hours.alias("__hours"))

    def upto(h: Column) -> Column:
        return F.aggregate(F.filter("__hours", lambda x: x["hour"] <= h), F.lit(0).cast("bigint"), lambda a, x: a + x["n"])

    all_sends = F.aggregate("__hours", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    median = F.array_min(F.transform(F.filter("__hours", lambda x: upto(x["hour"]) * 2 >= all_sends), lambda x: x["hour"]))
    busiest = F.array_max(F.transform("__hours", lambda x: F.struct(x["n"].alias("n"), (-x["hour"]).alias("h"))))

    def hour_range(hour: Column) -> Column:
        text = F.lpad(hour.cast("int").cast("string"), 2, "0")
        return F.concat(text, F.lit(":00-"), text, F.lit(":59"))

    return total.select(
        "time_type",
        "time_value",
        F.col("__sends").alias("send_count"),
        F.coalesce("__uses", F.lit(0)).alias("redemption_count"),
        F.col("__sales").alias("total_sales"),
        decimal_ratio(F.col("__offered"), F.col("__offers")).alias("avg_offer_amount"),
        ratio(F.col("__wait"), F.col("__uses") * 3600, 2).alias("avg_process_time"),
        F.coalesce(ratio(F.col("__uses"), F.col("__sends"), 4), F.lit(0.0)).alias("redemption_rate"),
        hour_range(median).alias("peak_hour"),
        hour_range(-busiest["h"]).alias("busiest_hour"),
    )


def offer_trend(time_stats: DataFrame) -> DataFrame:
    return time_stats.select(
        F.col("time_type").alias("time_dimension"),
        "time_value",
        "send_count",
        "redemption_count",
        "redemption_rate",
        F.col("total_sales").alias("sales_amount"),
        "avg_offer_amount",
        "peak_hour",
    )


def agent_wide(sends: DataFrame, redemptions: DataFrame, agents: DataFrame) -> DataFrame:
    """Per agent and day: sends, uses, sales, averages and the rank by uses inside department and day."""
    rows = with_redemptions(sends, redemptions).withColumn("stat_date", F.to_date("send_time"))
    per = rows.groupBy("cs_id", "stat_date").agg(
        F.count("record_id").alias("send_count"),
        F.sum("is_used").alias("redemption_count"),
        ratio(F.sum("is_used"), F.count("record_id"), 4).alias("redemption_rate"),
        F.coalesce(F.sum("sales"), F.lit(0)).cast(MONEY).alias("total_sales"),
        decimal_ratio(F.sum("offer_amount"), F.count("offer_amount")).alias("avg_offer_amount"),
        ratio(F.sum("wait_seconds"), F.sum("redemptions") * 3600, 2).alias("avg_redemption_time"),
    )
    named = with_names(per, agents, "cs_id", "cs_id", {"cs_name": "cs_name", "department": "dept_name"}, "inner")
    dated = named.withColumns(
        {"stat_week": iso_week("stat_date"), "stat_month": F.date_format("stat_date", "yyyy-MM")}
    )
    return rank_in_group(dated, ["dept_name", "stat_date"], "redemption_count", "rank_in_dept")


def offer_overview(sends: DataFrame, as_of: str | dt.date, days: Sequence[int] = REPORT_WINDOWS) -> DataFrame:
    """Sends, uses, mean offer, active agents and customers for 1, 7 and 30 days, from one scan.

    Folded per agent and customer first, so the two distinct counts expand
    the pairs and not the sends.
    """
    pairs = in_windows(sends, as_of, days).groupBy("recent_days", "cs_id", "customer_id").agg(
        F.count("record_id").alias("sends"),
        F.sum("is_used").alias("used"),
        F.sum("offer_amount").alias("amount"),
        F.count("offer_amount").alias("offers"),
    )
    totals = pairs.groupBy("recent_days").agg(
        F.sum("sends").alias("total_send_count"),
        F.sum("used").alias("total_redemption_count"),
        ratio(F.sum("used"), F.sum("sends"), 4).alias("overall_redemption_rate"),
        decimal_ratio(F.sum("amount"), F.sum("offers")).alias("avg_offer_amount"),
        F.count_distinct("cs_id").alias("active_cs_count"),
        F.count_distinct("customer_id").alias("active_customer_count"),
    )
    return totals.withColumn("stat_date", F.lit(as_date(as_of)))


def offer_activity_effect(activities: DataFrame, sends: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Campaign effect with its best product: most redemptions, the smaller id on a tie."""
    per_product = (
        with_redemptions(sends, redemptions)
        .groupBy("activity_id", "product_id")
        .agg(
            F.count("record_id").alias("sends"),
            F.coalesce(F.sum("redemptions"), F.lit(0)).alias("redemptions"),
            F.sum("sales").alias("sales"),
            F.sum("wait_seconds").alias("wait_seconds"),
        )
    )
    per = per_product.groupBy(F.col("activity_id").alias("__a")).agg(
        F.sum("sends").alias("send_count"),
        F.sum("redemptions").alias("redemption_count"),
        ratio(F.sum("redemptions"), F.sum("sends"), 4).alias("redemption_rate"),
        F.sum("sales").alias("total_sales"),
        ratio(F.sum("wait_seconds"), F.sum("redemptions") * 3600, 2).alias("avg_redemption_time"),
        F.max_by("product_id", F.struct(F.col("redemptions"), -F.col("product_id"))).alias("top_product_id"),
    )
    return (
        activities.select(
            "activity_id",
            "activity_name",
            "status",
            F.to_date("start_time").alias("start_date"),
            F.to_date("end_time").alias("end_date"),
        )
        .join(per, F.col("activity_id") == F.col("__a"), "left")
        .drop("__a")
        .na.fill(0, ["send_count", "redemption_count"])
    )


def agent_rank_change(wide: DataFrame, day: str | dt.date) -> DataFrame:
    """Rank of each agent in the department on ``day`` and the change since the day before.

    The wide table holds the rank inside department and day.  The change is
    null for an agent without a rank in the same department the day before.
    """
    today = as_date(day)
    before = today - dt.timedelta(days=1)
    current = wide.where(F.col("stat_date") == F.lit(today)).withColumnRenamed("rank_in_dept", "rank")
    previous = wide.where(F.col("stat_date") == F.lit(before)).select(
        "cs_id", "dept_name", F.col("rank_in_dept").alias("previous_rank")
    )
    return (
        current.join(previous, ["cs_id", "dept_name"], "left")
        .withColumn("rank_change", F.col("rank") - F.col("previous_rank"))
        .drop("previous_rank", "stat_week", "stat_month")
    )


def offer_send_list(
    sends: DataFrame, redemptions: DataFrame, agents: DataFrame, activities: DataFrame, products: DataFrame
) -> DataFrame:
    """Listing of sent offers with their redemptions, status and remaining time in words."""
    # --- fixed values: status words ---
    words = {UNUSED: "未使用", USED: "已使用", EXPIRED: "已过期"}
    status = F.lit("未知")
    for code, word in words.items():
        status = F.when(F.col("status") == code, word).otherwise(status)
    remaining = F.concat(
        F.when(F.col("remaining_time").isNull(), F.lit("无限制"))
        .when(F.col("remaining_time") == 0, F.lit("已过期"))
        .otherwise(F.col("remaining_time").cast("decimal(16,2)").cast("string")),
        F.lit("小时"),
    )
    redeemed = redemptions.select(
        F.col("record_id").alias("__r"), "redemption_time", F.col("payment_amount").alias("order_amount")
    )
    listed = products.select(F.col("product_id").alias("__p")).distinct()
    out = sends.drop("activity_name").join(redeemed, F.col("record_id") == F.col("__r"), "left")
    out = with_names(out, agents, "cs_id", "cs_id", {"cs_name": "cs_name"})
    out = with_names(out, activities, "activity_id", "activity_id", {"activity_name": "activity_name"})
    out = out.join(listed, F.col("product_id") == F.col("__p"), "left")
    return out.select(
        "record_id",
        "send_time",
        "cs_name",
        "customer_id",
        F.when(F.col("__p").isNotNull(), F.concat(F.lit("活动商品-"), F.col("__p").cast("string")))
        .otherwise(F.lit("未知商品"))
        .alias("product_name"),
        "offer_amount",
        status.alias("status"),
        "redemption_time",
        "order_amount",
        "activity_name",
        "expire_time",
        remaining.alias("remaining_time"),
    )

"""Freight summaries: orders, hubs, dispatch, transport.

Every order is folded to one row before it is counted, because detail facts
hold one row per cargo line.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import in_windows
from daymill.functions.values import MONEY
from daymill.operators.dimensions import climb_regions, with_names
from daymill.operators.trade_facts import day_rows

Day = str | dt.date | None


def _hub_of_district(df: DataFrame, orgs: DataFrame, district: str) -> DataFrame:
    hub = {"id": "org_id", "org_name": "org_name", "region_id": "org_region_id"}
    return with_names(df, orgs, district, "region_id", hub)


def org_cargo_order_1d(detail: DataFrame, orgs: DataFrame, regions: DataFrame, day: Day = None) -> DataFrame:
    """Orders and amount per organisation and cargo type; an order counts once per cargo type."""
    keys = ["cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id", "dt"]
    once = day_rows(detail, day).groupBy("order_id", *keys).agg(F.max("amount").alias("amount"))
    areas = once.groupBy(*keys).agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))
    placed = _hub_of_district(areas, orgs, "sender_district_id")
    named = with_names(placed, regions, "sender_city_id", "id", {"name": "city_name"})
    return named.groupBy(
        "org_id", "org_name", F.col("sender_city_id").alias("city_id"), "city_name", "cargo_type", "cargo_type_name", "dt"
    ).agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def _per_hub(
    detail: DataFrame, orgs: DataFrame, regions: DataFrame, district: str, with_amount: bool, day: Day
) -> DataFrame:
    keys = [district, "dt"]
    amount = [F.max("amount").alias("amount")] if with_amount else []
    once = day_rows(detail, day).groupBy("order_id", *keys)
    once = once.agg(*amount) if amount else day_rows(detail, day).select("order_id", *keys).distinct()
    sums = [F.sum("amount").alias("order_amount")] if with_amount else []
    areas = once.groupBy(*keys).agg(F.count("order_id").alias("order_count"), *sums)
    hubs = climb_regions(_hub_of_district(areas, orgs, district), regions, "org_region_id")
    measures = [F.sum(c).alias(c) for c in ["order_count"] + (["order_amount"] if with_amount else [])]
    return hubs.groupBy(
        "org_id", "org_name", "city_id", "city_name", "province_id", "province_name", "dt"
    ).agg(*measures)


def org_receive_1d(detail: DataFrame, orgs: DataFrame, regions: DataFrame, day: Day = None) -> DataFrame:
    """Picked-up orders and amount per hub with its city and province."""
    return _per_hub(detail, orgs, regions, "sender_district_id", True, day)


def org_deliver_1d(detail: DataFrame, orgs: DataFrame, regions: DataFrame, day: Day = None) -> DataFrame:
    """Delivered orders per hub with its city and province."""
    return _per_hub(detail, orgs, regions, "receiver_district_id", False, day)


def org_sort_1d(scans: DataFrame, orgs: DataFrame, regions: DataFrame, day: Day = None) -> DataFrame:
    """Sort scans per hub; where its city sits depends on the level of the hub."""
    counted = day_rows(scans, day).groupBy("org_id", "dt").agg(F.count(F.lit(1)).alias("sort_count"))
    hub = {"org_name": "org_name", "org_level": "org_level", "region_id": "org_region_id"}
    placed = with_names(counted, orgs, "org_id", "id", hub)
    return climb_regions(placed, regions, "org_region_id", F.col("org_level")).select(
        "org_id", "org_name", "city_id", "city_name", "province_id", "province_name", "sort_count", "dt"
    )


def dispatch_1d(detail: DataFrame, day: Day = None) -> DataFrame:
    """Dispatched orders and amount per day."""
    once = day_rows(detail, day).groupBy("order_id", "dt").agg(F.max("amount").alias("amount"))
    return once.groupBy("dt").agg(
        F.count("order_id").cast("bigint").alias("order_count"), F.sum("amount").cast(MONEY).alias("order_amount")
    )


def running_total_td(daily: DataFrame, as_of: str | dt.date, measures: Sequence[str] = ("order_count", "order_amount")):
    """To-date totals of a daily table."""
    return daily.where(F.col("dt") <= F.lit(as_of).cast("date")).agg(*[F.sum(m).alias(m) for m in measures])


def finished_orders_td(detail: DataFrame, as_of: str | dt.date) -> DataFrame:
    """To-date finished orders, each counted once over the whole history."""
    done = detail.where(F.col("dt") <= F.lit(as_of).cast("date"))
    once = done.groupBy("order_id").agg(F.max("amount").alias("amount"))
    return once.agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


def truck_finish_1d(finish: DataFrame, trucks: DataFrame, day: Day = None) -> DataFrame:
    """Finished trips, distance and seconds per organisation and truck type.

    Trips are folded per truck before the truck is looked up.
    """
    per_truck = (
        day_rows(finish, day)
        .groupBy(F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "truck_id", "dt")
        .agg(
            F.count("id").alias("trans_finish_count"),
            F.sum("actual_distance").alias("trans_finish_distance"),
            F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
        )
    )
    typed = with_names(
        per_truck, trucks, "truck_id", "id", {"model_type": "truck_model_type", "model_type_name": "truck_model_type_name"}
    )
    return typed.groupBy("org_id", "org_name", "truck_model_type", "truck_model_type_name", "dt").agg(
        F.sum("trans_finish_count").cast("bigint").alias("trans_finish_count"),
        F.sum("trans_finish_distance").cast(MONEY).alias("trans_finish_distance"),
        F.sum("trans_finish_dur_sec").cast("bigint").alias("trans_finish_dur_sec"),
    )


def hub_trips(
    finish: DataFrame, orgs: DataFrame, regions: DataFrame, as_of: str | dt.date, days: Sequence[int] = (1, 7, 30)
) -> DataFrame:
    """Trips, distance and seconds per starting hub, with its city, for windows of days in one pass."""
    trips = (
        in_windows(finish, as_of, days)
        .groupBy("recent_days", F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"))
        .agg(
            F.count("id").alias("trans_finish_count"),
            F.sum("actual_distance").alias("trans_finish_distance"),
            F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
        )
    )
    hub = {"org_level": "__level", "region_id": "__region"}
    placed = with_names(trips, orgs, "org_id", "id", hub)
    return climb_regions(placed, regions, "__region", F.col("__level")).drop("__level", "__region")


def shift_finish_nd(
    finish: DataFrame,
    orgs: DataFrame,
    regions: DataFrame,
    shifts: DataFrame,
    trucks: DataFrame,
    as_of: str | dt.date,
    days: Sequence[int] = (7, 30),
) -> DataFrame:
    """Trips per shift, line, drivers and truck for windows of days, with names.

    A trip is late when it took longer than the planned minutes of its shift.
    """
    late = F.col("actual_end_time") > F.col("actual_start_time") + F.make_dt_interval(mins=F.col("estimated_minutes"))
    keys = [
        "recent_days", "shift_id", "line_id", "start_org_id", "start_org_name", "driver1_emp_id", "driver1_name",
        "driver2_emp_id", "driver2_name", "truck_id",
    ]
    trips = (
        in_windows(finish, as_of, days)
        .groupBy(*keys)
        .agg(
            F.count("id").alias("trans_finish_count"),
            F.sum("actual_distance").alias("trans_finish_distance"),
            F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
            F.sum("order_num").alias("trans_finish_order_count"),
            F.sum(F.when(late, 1).otherwise(0)).alias("trans_finish_delay_count"),
        )
        .withColumnsRenamed({"start_org_id": "org_id", "start_org_name": "org_name"})
    )
    hub = {"org_level": "__level", "region_id": "__region"}
    placed = climb_regions(with_names(trips, orgs, "org_id", "id", hub), regions, "__region", F.col("__level"))
    named = with_names(placed, shifts, "shift_id", "id", {"line_name": "line_name"})
    named = with_names(
        named, trucks, "truck_id", "id", {"model_type": "truck_model_type", "model_type_name": "truck_model_type_name"}
    )
    return named.drop("__level", "__region", "province_id", "province_name")

"""Freight reports: full outer combinations, levels, drivers, orders in transit.

Every input is already one row per key, so the full outer joins here join
small aggregates and never raw facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import as_date
from daymill.functions.values import decimal_ratio, ratio

DayText = str | dt.date


def one_day(daily: DataFrame, as_of: DayText) -> DataFrame:
    """The report day of a daily table, in the shape of a window table."""
    return daily.where(F.col("dt") == F.lit(as_date(as_of))).withColumn("recent_days", F.lit(1)).drop("dt")


def windows(daily: DataFrame, longer: DataFrame, as_of: DayText) -> DataFrame:
    """The report day and the longer windows in one frame; columns only one side has are dropped."""
    today = one_day(daily, as_of)
    shared = [c for c in today.columns if c in longer.columns]
    return today.select(shared).unionByName(longer.select(shared))


def _sums(measures: Mapping[str, str]) -> list[Column]:
    return [F.sum(c).alias(name) for c, name in measures.items()]


def _trip_averages(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "avg_trans_finish_distance": decimal_ratio("trans_finish_distance", "trans_finish_count"),
            "avg_trans_finish_dur_sec": ratio("trans_finish_dur_sec", "trans_finish_count", 2),
        }
    )


TRIPS = {c: c for c in ("trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec")}
ORDERS = {"order_count": "order_count", "order_amount": "order_amount"}


def area_trade_transport(orders: DataFrame, trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Orders next to transport per area and window; either side may be missing.

    Both inputs hold ``recent_days``.  Areas without a known key are left out
    of the transport side; averages are per trip.
    """
    grouping = ["recent_days", *keys]
    traded = orders.groupBy(*grouping).agg(*_sums(ORDERS))
    moved = trips.where(F.col(keys[0]).isNotNull()).groupBy(*grouping).agg(*_sums(TRIPS))
    return traded.join(_trip_averages(moved), grouping, "full_outer")


def express_report(
    receive: DataFrame | None, deliver: DataFrame, sort: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Pick-up, delivery and sort counts side by side per area and window.

    Without ``keys`` the whole network is one row per window.  Null areas of
    the three sides do not match each other and stay separate rows.
    """
    grouping = ["recent_days", *keys]
    sides = [
        deliver.groupBy(*grouping).agg(F.sum("order_count").alias("deliver_suc_count")),
        sort.groupBy(*grouping).agg(F.sum("sort_count").alias("sort_count")),
    ]
    if receive is not None:
        sides.append(
            receive.groupBy(*grouping).agg(
                F.sum("order_count").alias("receive_order_count"),
                F.round(F.sum("order_amount"), 2).alias("receive_order_amount"),
            )
        )
    return reduce(lambda a, b: a.join(b, grouping, "full_outer"), sides)


def order_report(orders: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Orders and amount per window, in total or by cargo type."""
    return orders.groupBy("recent_days", *keys).agg(*_sums(ORDERS))


def transport_report(trips: DataFrame, keys: Sequence[str] = (), with_orders: bool = False) -> DataFrame:
    """Trips, distance and seconds per window, in total, by line or by shift."""
    measures = dict(TRIPS)
    if with_orders:
        measures["trans_finish_order_count"] = "trans_finish_order_count"
    return trips.groupBy("recent_days", *keys).agg(*_sums(measures))


def truck_report(trips: DataFrame) -> DataFrame:
    """Per truck type: sums and averages, 0 where there were no trips, empty text for an unknown type."""
    keys = ["truck_model_type", "truck_model_type_name"]
    summed = trips.groupBy("recent_days", *keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TRIPS]
    )
    averages = _trip_averages(summed)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("avg_trans_finish_distance", "avg_trans_finish_dur_sec")}
    return averages.withColumns(zero).na.fill("", keys)


def driver_report(trips: DataFrame) -> DataFrame:
    """Per driver and window: trips, distance, seconds, late trips.

    A trip with two drivers counts for both, with half the distance and half
    the time each; the trip and the late count are not halved.
    """
    paired = F.col("driver2_emp_id").isNotNull()
    first = F.struct(F.col("driver1_emp_id").alias("driver_id"), F.col("driver1_name").alias("driver_name"))
    second = F.struct(F.col("driver2_emp_id").alias("driver_id"), F.col("driver2_name").alias("driver_name"))
    share = F.when(paired, 2).otherwise(1)
    rows = trips.select(
        "recent_days",
        "trans_finish_count",
        "trans_finish_delay_count",
        (F.col("trans_finish_distance") / share).cast("decimal(18,4)").alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec") / share).alias("trans_finish_dur_sec"),
        F.inline(F.when(paired, F.array(first, second)).otherwise(F.array(first))),
    )
    summed = rows.groupBy("recent_days", "driver_id", "driver_name").agg(
        *_sums(TRIPS), F.sum("trans_finish_delay_count").alias("trans_finish_late_count")
    )
    return _trip_averages(summed).withColumnRenamed("driver_id", "driver_emp_id")


def order_flow_report(receive: DataFrame, dispatch: DataFrame) -> DataFrame:
    """Picked-up next to dispatched orders and amounts per window."""
    picked = receive.groupBy("recent_days").agg(
        F.sum("order_count").alias("receive_order_count"), F.sum("order_amount").alias("receive_order_amount")
    )
    sent = dispatch.groupBy("recent_days").agg(
        F.sum("order_count").alias("dispatch_order_count"), F.sum("order_amount").alias("dispatch_order_amount")
    )
    return picked.join(sent, "recent_days", "full_outer")


def in_transit_td(dispatched: DataFrame, finished: DataFrame) -> DataFrame:
    """Orders still under way: dispatched to date less finished to date."""
    less = finished.select((-F.col("order_count")).alias("order_count"), (-F.col("order_amount")).alias("order_amount"))
    return dispatched.select("order_count", "order_amount").unionByName(less).agg(
        F.sum("order_count").alias("bounding_order_count"), F.sum("order_amount").alias("bounding_order_amount")
    )

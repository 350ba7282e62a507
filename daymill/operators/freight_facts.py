"""Freight facts: order lines, open-order snapshot, milestones, scans, transport."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import OPEN_END, Days, millis_to_timestamp, raw_within, seconds_to_timestamp
from daymill.functions.values import mask_name
from daymill.operators.dimensions import code_lookup

# --- fixed values: order states ---
PLACED, PAID, PICKED_UP, SENT_OUT, DISPATCHED, ARRIVED, DELIVERING, SIGNED, CANCELLED = (
    "60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999",
)
FINAL_STATES = (SIGNED, CANCELLED)


@dataclass(frozen=True)
class Milestone:
    """A state reached, the states an open order may come from, the name of its time."""

    status: str
    prior: tuple[str, ...]
    time_name: str


MILESTONES = {
    "pay": Milestone(PAID, (PLACED,), "payment_time"),
    "receive": Milestone(PICKED_UP, (PLACED, PAID), "receive_time"),
    "dispatch": Milestone(DISPATCHED, (PLACED, PAID, PICKED_UP, SENT_OUT), "dispatch_time"),
    "bound_finish": Milestone(ARRIVED, (PLACED, PAID, PICKED_UP, SENT_OUT, DISPATCHED), "bound_finish_time"),
    "cancel": Milestone(CANCELLED, (PLACED, PAID, PICKED_UP, SENT_OUT, DISPATCHED, ARRIVED, DELIVERING), "cancel_time"),
}

CARGO_COLUMNS = ["id", "order_id", "cargo_type", "volume_length", "volume_width", "volume_height", "weight"]
ORDER_COLUMNS = [
    "order_no", "status", "collect_type", "user_id", "receiver_complex_id", "receiver_province_id", "receiver_city_id",
    "receiver_district_id", "sender_complex_id", "sender_province_id", "sender_city_id", "sender_district_id",
    "cargo_num", "amount", "estimate_arrive_time", "distance",
]


def _live(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_deleted") == "0")


def _cargo_with_order(cargo: DataFrame, orders: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Cargo lines of known orders; person names are masked."""
    header = orders.select(
        F.col("id").alias("__o"),
        *ORDER_COLUMNS,
        mask_name("receiver_name").alias("receiver_name"),
        mask_name("sender_name").alias("sender_name"),
        *extra,
    )
    return cargo.join(header, F.col("order_id") == F.col("__o"), "inner").drop("__o")


def _decoded(df: DataFrame, codes: DataFrame) -> DataFrame:
    return code_lookup(
        df,
        codes,
        {"cargo_type": "cargo_type_name", "status": "status_name", "collect_type": "collect_type_name"},
    )


#: Local time is that much ahead of the stored one.
LOCAL = dt.timedelta(hours=8)


def _local(c: str | Column) -> Column:
    return F.from_utc_timestamp(c, "GMT+8")


def _local_days(c: str, days: Days | None) -> Column:
    """Rows whose local day lies in ``days``, as bounds on the stored time."""
    return raw_within(c, days, later=LOCAL)


def order_cargo_fact(cargo: DataFrame, orders: DataFrame, codes: DataFrame, days: Days | None = None) -> DataFrame:
    """Freight order line: cargo of live orders, three codes decoded, order time in local time.

    ``days`` (first, last) bounds the scan of the cargo.
    """
    lines = _cargo_with_order(_live(cargo).where(_local_days("create_time", days)).select(*CARGO_COLUMNS, "create_time"), _live(orders))
    return _decoded(lines, codes).select(
        *CARGO_COLUMNS,
        "cargo_type_name",
        *ORDER_COLUMNS,
        "status_name",
        "collect_type_name",
        "receiver_name",
        "sender_name",
        _local("create_time").alias("order_time"),
        F.to_date(_local("create_time")).alias("dt"),
    )


def order_process_snapshot(cargo: DataFrame, orders: DataFrame, codes: DataFrame) -> DataFrame:
    """All order lines by the day they ended: the far date while the order is open."""
    lines = _cargo_with_order(_live(cargo).select(*CARGO_COLUMNS, "create_time"), _live(orders), ["update_time"])
    ended = F.when(F.col("status").isin(*FINAL_STATES), F.to_date("update_time")).otherwise(F.lit(OPEN_END))
    return (
        _decoded(lines, codes)
        .withColumns({"start_date": F.to_date("create_time"), "end_date": ended, "dt": ended})
        .drop("create_time", "update_time")
    )


def order_milestones(
    cargo: DataFrame, orders: DataFrame, open_orders: DataFrame, codes: DataFrame, kinds: Sequence[str] = tuple(MILESTONES),
    days: Days | None = None,
) -> DataFrame:
    """Order lines whose order reached one of several states today, with ``kind`` and ``milestone_time``.

    Today's rows of ``orders`` give state and time.  The line itself comes
    from the still open rows of earlier days, if their state allows the step,
    or from today's new cargo.  An order is in one state at a time, so all
    kinds come out of one pass.  ``days`` (first, last) bounds the scan of the
    orders to those that changed then.
    """
    chosen = {kind: MILESTONES[kind] for kind in kinds}

    def by_status(value: dict[str, Column], default: Column) -> Column:
        out = default
        for kind, m in chosen.items():
            out = F.when(F.col("status") == m.status, value[kind]).otherwise(out)
        return out

    columns = [*CARGO_COLUMNS, *[c for c in ORDER_COLUMNS if c != "status"], "receiver_name", "sender_name"]
    reached = _live(orders).where(F.col("status").isin(*[m.status for m in chosen.values()]) & _local_days("update_time", days))
    new = _cargo_with_order(cargo.select(CARGO_COLUMNS), reached, ["update_time"])

    allowed = sorted({p for m in chosen.values() for p in m.prior})
    earlier = open_orders.where((F.col("end_date") == F.lit(OPEN_END)) & F.col("status").isin(*allowed))
    prior = by_status(
        {k: F.array(*[F.lit(p) for p in m.prior]) for k, m in chosen.items()}, F.array().cast("array<string>")
    )
    step = reached.select(F.col("id").alias("__r"), "status", "update_time", prior.alias("__prior"))
    moved = earlier.withColumnRenamed("status", "__was").join(
        step, (F.col("order_id") == F.col("__r")) & F.array_contains("__prior", F.col("__was")), "inner"
    )
    lines = new.select(*columns, "status", "update_time").unionByName(moved.select(*columns, "status", "update_time"))
    named = lines.withColumns(
        {
            "kind": by_status({k: F.lit(k) for k in chosen}, F.lit(None).cast("string")),
            "milestone_time": _local("update_time"),
            "dt": F.to_date(_local("update_time")),
        }
    )
    return _decoded(named.drop("update_time"), codes)


def order_milestone_fact(
    cargo: DataFrame, orders: DataFrame, open_orders: DataFrame, codes: DataFrame, kind: str, days: Days | None = None
) -> DataFrame:
    """Order lines whose order reached one state today, the time under the name of the milestone."""
    rows = order_milestones(cargo, orders, open_orders, codes, [kind], days)
    return rows.drop("kind").withColumnRenamed("milestone_time", MILESTONES[kind].time_name)


def order_milestone_by_exclusion(
    cargo: DataFrame, orders: DataFrame, codes: DataFrame, excluded: Sequence[str], time_name: str, days: Days | None = None
) -> DataFrame:
    """Order lines of orders past a point, that is in none of the ``excluded`` states; ``days`` as above."""
    past = _live(orders).where(~F.col("status").isin(*excluded) & _local_days("update_time", days))
    lines = _cargo_with_order(_live(cargo).select(CARGO_COLUMNS), past, ["update_time"])
    return (
        _decoded(lines, codes)
        .withColumn(time_name, _local("update_time"))
        .withColumn("dt", F.to_date(time_name))
        .drop("update_time")
    )


NOT_YET_DELIVERED = (PLACED, PAID, PICKED_UP, SENT_OUT, DISPATCHED, ARRIVED, CANCELLED)
NOT_YET_SIGNED = (*NOT_YET_DELIVERED, DELIVERING)

SCAN_COLUMNS = {
    "inbound": ("inbound_time", "inbound_emp_id"),
    "sort": ("sort_time", "sorter_emp_id"),
    "outbound": ("outbound_time", "outbound_emp_id"),
}


def hub_scan_fact(scans: DataFrame, kinds: Sequence[str] = tuple(SCAN_COLUMNS), days: Days | None = None) -> DataFrame:
    """Inbound, sort and outbound scans from one wide row each; scans without a time are left out.

    Times are epoch seconds.  The wide table is read once and unfolded; with
    ``days`` (first, last) only rows with a scan in that time are.
    """
    near = reduce(lambda a, b: a | b, [raw_within(SCAN_COLUMNS[k][0], days, "seconds") for k in kinds])
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                seconds_to_timestamp(SCAN_COLUMNS[kind][0]).alias("scan_time"),
                F.col(SCAN_COLUMNS[kind][1]).alias("emp_id"),
            )
            for kind in kinds
        ]
    )
    return (
        scans.where(near)
        .select("id", "order_id", "org_id", F.inline(rows))
        .where(F.col("scan_time").isNotNull() & raw_within("scan_time", days))
        .withColumn("dt", F.to_date("scan_time"))
    )


def transport_finish_fact(tasks: DataFrame, shifts: DataFrame, days: Days | None = None) -> DataFrame:
    """Finished transport tasks with duration and planned minutes; times are epoch milliseconds.

    ``days`` (first, last) bounds the scan of the tasks by the time they ended.
    """
    planned = shifts.select(F.col("id").alias("__s"), F.col("estimated_time").alias("estimated_minutes"))
    started, ended = millis_to_timestamp("actual_start_time"), millis_to_timestamp("actual_end_time")
    return (
        _live(tasks)
        .where(F.col("actual_end_time").isNotNull() & raw_within("actual_end_time", days, "millis"))
        .join(planned, F.col("shift_id") == F.col("__s"), "left")
        .select(
            "id",
            "shift_id",
            "line_id",
            "start_org_id",
            "start_org_name",
            "end_org_id",
            "end_org_name",
            "order_num",
            "driver1_emp_id",
            mask_name("driver1_name").alias("driver1_name"),
            "driver2_emp_id",
            mask_name("driver2_name").alias("driver2_name"),
            "truck_id",
            F.md5("truck_no").alias("truck_no"),
            started.alias("actual_start_time"),
            ended.alias("actual_end_time"),
            "estimated_minutes",
            "actual_distance",
            ((F.col("actual_end_time") - F.col("actual_start_time")) / F.lit(1000)).alias("finish_dur_sec"),
            F.to_date(ended).alias("dt"),
        )
    )

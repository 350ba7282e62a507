"""Queries over freight facts, summaries and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import Days, window_days
from daymill.operators import freight_facts as ff
from daymill.operators import freight_reports as fr
from daymill.operators import freight_summaries as fs
from daymill.operators.summaries import rolling_window_rollup
from daymill.plans import literals as lit
from daymill.plans import roles
from daymill.plans.ctes import cents, rounded
from daymill.plans.registry import Tables, query

ASOF = f"DATE '{lit.ORDERS_AS_OF}'"
WINDOWS = "(VALUES (1), (7), (30)) w(recent_days)"
#: The days that reports over windows read.
WINDOW = window_days(lit.ORDERS_AS_OF)
IN_WINDOW = f"dt > {ASOF} - recent_days AND dt <= {ASOF}"


@query("order_cargo_fact", "SELECT * FROM fdet", "fdet", "dt", "weight amount", "order_time estimate_arrive_time")
def order_cargo_fact(t: Tables):
    return roles.freight_details(t)


@query("order_process_snapshot",
       """SELECT cargo.id, order_id, cargo_type, volume_length, volume_width, volume_height, weight, c1.dic_name AS cargo_type_name, order_no, status, collect_type, user_id,
       sender_complex_id, sender_province_id, sender_city_id,
        sender_district_id, receiver_complex_id, receiver_province_id, receiver_city_id, receiver_district_id, cargo_num, amount,
        estimate_arrive_time, distance, c2.dic_name AS status_name,
       c3.dic_name AS collect_type_name, receiver_name, sender_name, CAST(create_time AS DATE) AS start_date,
       CASE WHEN status IN ('60080', '60999') THEN CAST(update_time AS DATE) ELSE DATE '9999-12-31' END AS end_date,
       CASE WHEN status IN ('60080', '60999') THEN CAST(update_time AS DATE) ELSE DATE '9999-12-31' END AS dt
       FROM cargo JOIN ford ON ford.id = order_id LEFT JOIN codes c1 ON c1.dic_code = cargo_type LEFT JOIN codes c2 ON c2.dic_code = status
       LEFT JOIN codes c3 ON c3.dic_code = collect_type WHERE NOT cargo.gone AND NOT ford.gone""",
       "cargo ford codes", "start_date end_date dt", "weight amount", "estimate_arrive_time")
def order_process_snapshot(t: Tables):
    return ff.order_process_snapshot(roles.cargo(t), roles.freight_orders(t), roles.codes(t))


@query("order_milestone_fact", "SELECT * FROM milestones", "milestones", "dt", "weight amount", "milestone_time estimate_arrive_time")
def order_milestone_fact(t: Tables):
    """All five milestones under one time name."""
    return ff.order_milestones(roles.todays_cargo(t), roles.freight_orders(t), roles.open_orders(t), roles.codes(t))


@query("order_milestone_by_exclusion", "SELECT * FROM delivered", "delivered", "dt", "weight amount", "deliver_suc_time estimate_arrive_time")
def order_milestone_by_exclusion(t: Tables):
    return roles.delivered(t)


@query("order_signed_by_exclusion", "SELECT * RENAME (deliver_suc_time AS sign_time) FROM delivered WHERE status <> '60070'",
       "delivered", "dt", "weight amount", "sign_time estimate_arrive_time")
def order_signed_by_exclusion(t: Tables):
    return ff.order_milestone_by_exclusion(
        roles.cargo(t), roles.freight_orders(t), roles.codes(t), ff.NOT_YET_SIGNED, "sign_time"
    )


@query("hub_scan_fact", "SELECT * FROM scans", "scans", "dt", times="scan_time")
def hub_scan_fact(t: Tables):
    return ff.hub_scan_fact(roles.hub_scans(t))


@query("transport_finish_fact", "SELECT * FROM fin", "fin", "dt", "actual_distance", "actual_start_time actual_end_time")
def transport_finish_fact(t: Tables):
    return roles.transport_facts(t)


# ---- summaries ----------------------------------------------------------------


def _org_cargo(t: Tables, days: Days | None = None) -> DataFrame:
    return fs.org_cargo_order_1d(roles.freight_details(t, days), roles.orgs(t), roles.regions(t))


def _receive(t: Tables, days: Days | None = None) -> DataFrame:
    return fs.org_receive_1d(roles.milestone(t, "receive", days), roles.orgs(t), roles.regions(t))


def _deliver(t: Tables, days: Days | None = None) -> DataFrame:
    return fs.org_deliver_1d(roles.delivered(t, days), roles.orgs(t), roles.regions(t))


def _sort(t: Tables, days: Days | None = None) -> DataFrame:
    return fs.org_sort_1d(ff.hub_scan_fact(roles.hub_scans(t, days), ["sort"], days), roles.orgs(t), roles.regions(t))


def _dispatch(t: Tables, days: Days | None = None) -> DataFrame:
    return fs.dispatch_1d(roles.milestone(t, "dispatch", days))


def _truck_days(t: Tables) -> DataFrame:
    return fs.truck_finish_1d(roles.transport_facts(t), roles.trucks(t))


def _shift_nd(t: Tables) -> DataFrame:
    return fs.shift_finish_nd(
        roles.transport_facts(t, WINDOW), roles.orgs(t), roles.regions(t), roles.shifts(t), roles.trucks(t), lit.ORDERS_AS_OF
    )


HUB = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name"]


def _nd(daily: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """The longer windows of a daily table."""
    return rolling_window_rollup(daily, keys, measures, lit.ORDERS_AS_OF, shape="long")


def _all_windows(daily: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Report day and longer windows from one pass over the daily table."""
    return rolling_window_rollup(daily, keys, measures, lit.ORDERS_AS_OF, (1, 7, 30), "long")


@query("org_cargo_order_1d", "SELECT * FROM org_cargo_day", "org_cargo_day", "dt", "order_amount")
def org_cargo_order_1d(t: Tables):
    return _org_cargo(t)


@query("org_receive_1d", "SELECT * FROM receive_day", "receive_day", "dt", "order_amount")
def org_receive_1d(t: Tables):
    return _receive(t)


@query("org_deliver_1d", "SELECT * FROM deliver_day", "deliver_day", "dt")
def org_deliver_1d(t: Tables):
    return _deliver(t)


@query("org_sort_1d", "SELECT * FROM sort_day", "sort_day", "dt")
def org_sort_1d(t: Tables):
    return _sort(t)


@query("rolling_window_rollup_freight",
       " UNION ALL ".join(
           f"SELECT '{n}' AS kind, org_id, city_id, recent_days, CAST(SUM({m}) AS DOUBLE) AS measure FROM {n}, (VALUES (7), (30)) w(recent_days) WHERE {IN_WINDOW} GROUP BY ALL"
           for n, m in (("org_cargo_day", "order_amount"), ("receive_day", "order_amount"), ("deliver_day", "order_count"), ("sort_day", "sort_count"))
       ), "org_cargo_day receive_day deliver_day sort_day")
def rolling_window_rollup_freight(t: Tables):
    """The four hub tables over 7 and 30 days."""
    tables = {
        "org_cargo_day": (_org_cargo(t), "order_amount"),
        "receive_day": (_receive(t), "order_amount"),
        "deliver_day": (_deliver(t), "order_count"),
        "sort_day": (_sort(t), "sort_count"),
    }
    parts = [
        _nd(daily, ["org_id", "city_id"], [m]).select(
            F.lit(n).alias("kind"), "org_id", "city_id", "recent_days", F.col(m).cast("double").alias("measure")
        )
        for n, (daily, m) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("dispatch_1d", "SELECT * FROM dispatch_day", "dispatch_day", "dt", "order_amount")
def dispatch_1d(t: Tables):
    return _dispatch(t)


_FINISHED = f"""SELECT COUNT(*) AS order_count, SUM(amount) AS order_amount FROM (SELECT order_id, MAX(amount) AS amount FROM milestones
    WHERE kind = 'bound_finish' AND dt <= {ASOF} GROUP BY order_id)"""


@query("running_total_td",
       f"""SELECT 'dispatch' AS kind, CAST(SUM(order_count) AS BIGINT) AS order_count, SUM(order_amount) AS order_amount FROM dispatch_day
       WHERE dt <= {ASOF} UNION ALL SELECT 'finish' AS kind, * FROM ({_FINISHED})""", "dispatch_day milestones", money="order_amount")
def running_total_td(t: Tables):
    sent = fs.running_total_td(_dispatch(t), lit.ORDERS_AS_OF).select(F.lit("dispatch").alias("kind"), "*")
    done = fs.finished_orders_td(roles.milestone(t, "bound_finish"), lit.ORDERS_AS_OF)
    return sent.unionByName(done.select(F.lit("finish").alias("kind"), "*"))


@query("truck_finish_1d", "SELECT * FROM truck_day", "truck_day", "dt", "trans_finish_distance")
def truck_finish_1d(t: Tables):
    return _truck_days(t)


@query("shift_finish_nd", "SELECT * FROM shift_nd", "shift_nd", money="trans_finish_distance")
def shift_finish_nd(t: Tables):
    return _shift_nd(t)


# ---- reports ------------------------------------------------------------------


def _trip_windows(t: Tables) -> DataFrame:
    return fs.hub_trips(roles.transport_facts(t, WINDOW), roles.orgs(t), roles.regions(t), lit.ORDERS_AS_OF)


_TRIPS_SQL = f"""SELECT recent_days, fin.start_org_id AS org_id, start_org_name AS org_name, city_id, city_name, COUNT(*) AS n,
    SUM(actual_distance) AS dist, SUM(finish_dur_sec) AS secs FROM fin CROSS JOIN {WINDOWS} LEFT JOIN hubs_by_level h ON h.org_id = fin.start_org_id
    WHERE {IN_WINDOW} GROUP BY ALL"""


def _area_sql(keys: str) -> str:
    first = keys.split(",")[0]
    return f"""SELECT * FROM (SELECT recent_days, {keys}, CAST(SUM(order_count) AS BIGINT) AS order_count, SUM(order_amount) AS order_amount
        FROM org_cargo_day, {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL) FULL OUTER JOIN (SELECT recent_days, {keys}, CAST(SUM(n) AS BIGINT) AS trans_finish_count,
        SUM(dist) AS trans_finish_distance, SUM(secs) AS trans_finish_dur_sec, {rounded(cents("SUM(dist)"), "100 * SUM(n)", 2)} AS avg_trans_finish_distance,
        {rounded("SUM(secs)", "SUM(n)", 2)} AS avg_trans_finish_dur_sec FROM ({_TRIPS_SQL}) WHERE {first} IS NOT NULL GROUP BY ALL)
        USING (recent_days, {keys})"""


def _area(t: Tables, keys: list[str]) -> DataFrame:
    orders = _all_windows(
        _org_cargo(t, WINDOW), ["org_id", "org_name", "city_id", "city_name"], ["order_count", "order_amount"]
    )
    return fr.area_trade_transport(orders, _trip_windows(t), keys)


@query("area_trade_transport", _area_sql("city_id, city_name"), "org_cargo_day fin hubs_by_level", money="order_amount trans_finish_distance")
def area_trade_transport(t: Tables):
    return _area(t, ["city_id", "city_name"])


@query("area_trade_transport_by_org", _area_sql("org_id, org_name"), "org_cargo_day fin hubs_by_level", money="order_amount trans_finish_distance")
def area_trade_transport_by_org(t: Tables):
    return _area(t, ["org_id", "org_name"])


def _express_sides(t: Tables):
    return (
        _all_windows(_receive(t, WINDOW), HUB, ["order_count", "order_amount"]),
        _all_windows(_deliver(t, WINDOW), HUB, ["order_count"]),
        _all_windows(_sort(t, WINDOW), HUB, ["sort_count"]),
    )


def _express_sql(keys: str) -> str:
    def side(table: str, cols: str) -> str:
        return f"(SELECT recent_days, {keys}, {cols} FROM {table}, {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL)"

    return f"""SELECT * FROM {side("deliver_day", "CAST(SUM(order_count) AS BIGINT) AS deliver_suc_count")}
        FULL OUTER JOIN {side("sort_day", "CAST(SUM(sort_count) AS BIGINT) AS sort_count")} USING (recent_days, {keys})
        FULL OUTER JOIN {side("receive_day", "CAST(SUM(order_count) AS BIGINT) AS receive_order_count, ROUND(SUM(order_amount), 2) AS receive_order_amount")}
        USING (recent_days, {keys})"""


@query("express_report", _express_sql("city_id, city_name"), "deliver_day sort_day receive_day", money="receive_order_amount")
def express_report(t: Tables):
    return fr.express_report(*_express_sides(t), ["city_id", "city_name"])


@query("express_report_province", _express_sql("province_id, province_name"), "deliver_day sort_day receive_day", money="receive_order_amount")
def express_report_province(t: Tables):
    return fr.express_report(*_express_sides(t), ["province_id", "province_name"])


@query("express_report_total",
       f"""SELECT * FROM (SELECT recent_days, CAST(SUM(order_count) AS BIGINT) AS deliver_suc_count FROM deliver_day, {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL)
       FULL OUTER JOIN (SELECT recent_days, CAST(SUM(sort_count) AS BIGINT) AS sort_count FROM sort_day, {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL)
       USING (recent_days)""", "deliver_day sort_day")
def express_report_total(t: Tables):
    _, deliver, sort = _express_sides(t)
    return fr.express_report(None, deliver, sort)


def _order_report_sql(keys: str) -> str:
    return f"""SELECT recent_days, {keys} CAST(SUM(order_count) AS BIGINT) AS order_count, SUM(order_amount) AS order_amount
        FROM org_cargo_day, {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL"""


@query("order_report", _order_report_sql(""), "org_cargo_day", money="order_amount")
def order_report(t: Tables):
    return fr.order_report(_all_windows(_org_cargo(t, WINDOW), [], ["order_count", "order_amount"]))


@query("order_report_cargo_type", _order_report_sql("cargo_type, cargo_type_name,"), "org_cargo_day", money="order_amount")
def order_report_cargo_type(t: Tables):
    keys = ["cargo_type", "cargo_type_name"]
    return fr.order_report(_all_windows(_org_cargo(t, WINDOW), keys, ["order_count", "order_amount"]), keys)


def _transport_sql(keys: str) -> str:
    return f"""SELECT recent_days, {keys} CAST(SUM(trans_finish_count) AS BIGINT) AS trans_finish_count, SUM(trans_finish_distance) AS trans_finish_distance,
        SUM(trans_finish_dur_sec) AS trans_finish_dur_sec, CAST(SUM(trans_finish_order_count) AS BIGINT) AS trans_finish_order_count
        FROM shift_nd GROUP BY ALL"""


@query("transport_report",
       f"""SELECT recent_days, CAST(SUM(n) AS BIGINT) AS trans_finish_count, SUM(dist) AS trans_finish_distance, SUM(secs) AS trans_finish_dur_sec
       FROM ({_TRIPS_SQL}) GROUP BY recent_days""", "fin hubs_by_level", money="trans_finish_distance")
def transport_report(t: Tables):
    """In total: the report day and the longer windows."""
    return fr.transport_report(_trip_windows(t))


@query("transport_report_line", _transport_sql("line_id, line_name,"), "shift_nd", money="trans_finish_distance")
def transport_report_line(t: Tables):
    return fr.transport_report(_shift_nd(t), ["line_id", "line_name"], with_orders=True)


@query("transport_report_shift", _transport_sql("shift_id,"), "shift_nd", money="trans_finish_distance")
def transport_report_shift(t: Tables):
    return fr.transport_report(_shift_nd(t), ["shift_id"], with_orders=True)


@query("truck_report",
       f"""SELECT recent_days, COALESCE(truck_model_type, '') AS truck_model_type, COALESCE(truck_model_type_name, '') AS truck_model_type_name,
       CAST(SUM(trans_finish_count) AS BIGINT) AS trans_finish_count, SUM(trans_finish_distance) AS trans_finish_distance,
       SUM(trans_finish_dur_sec) AS trans_finish_dur_sec, {rounded(cents("SUM(trans_finish_distance)"), "100 * SUM(trans_finish_count)", 2)} AS avg_trans_finish_distance,
       {rounded("SUM(trans_finish_dur_sec)", "SUM(trans_finish_count)", 2)} AS avg_trans_finish_dur_sec FROM shift_nd GROUP BY ALL""",
       "shift_nd", money="trans_finish_distance")
def truck_report(t: Tables):
    return fr.truck_report(_shift_nd(t))


@query("driver_report",
       f"""SELECT recent_days, driver_emp_id, driver_name, CAST(SUM(n) AS BIGINT) AS trans_finish_count, SUM(dist) AS trans_finish_distance,
       SUM(secs) AS trans_finish_dur_sec, CAST(SUM(late) AS BIGINT) AS trans_finish_late_count, {rounded("SUM(dist) * 1000", "1000 * SUM(n)", 2)} AS avg_trans_finish_distance,
       {rounded("SUM(secs)", "SUM(n)", 2)} AS avg_trans_finish_dur_sec FROM (
       SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count AS n,
        CAST(trans_finish_distance AS DOUBLE) / (CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END) AS dist,
        trans_finish_dur_sec / (CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END) AS secs, trans_finish_delay_count AS late FROM shift_nd
       UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, CAST(trans_finish_distance AS DOUBLE) / 2, trans_finish_dur_sec / 2,
        trans_finish_delay_count FROM shift_nd WHERE driver2_emp_id IS NOT NULL) GROUP BY ALL""", "shift_nd")
def driver_report(t: Tables):
    return fr.driver_report(_shift_nd(t))


@query("order_flow_report",
       f"""SELECT * FROM (SELECT recent_days, CAST(SUM(order_count) AS BIGINT) AS receive_order_count, SUM(order_amount) AS receive_order_amount FROM receive_day,
       {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL) FULL OUTER JOIN (SELECT recent_days, CAST(SUM(order_count) AS BIGINT) AS dispatch_order_count,
       SUM(order_amount) AS dispatch_order_amount FROM dispatch_day, {WINDOWS} WHERE {IN_WINDOW} GROUP BY ALL) USING (recent_days)""",
       "receive_day dispatch_day", money="receive_order_amount dispatch_order_amount")
def order_flow_report(t: Tables):
    measures = ["order_count", "order_amount"]
    return fr.order_flow_report(_all_windows(_receive(t, WINDOW), HUB, measures), _all_windows(_dispatch(t, WINDOW), [], measures))


@query("in_transit_td",
       f"""SELECT CAST(d.order_count - f.order_count AS BIGINT) AS bounding_order_count, d.order_amount - f.order_amount AS bounding_order_amount
       FROM (SELECT SUM(order_count) AS order_count, SUM(order_amount) AS order_amount FROM dispatch_day WHERE dt <= {ASOF}) d, ({_FINISHED}) f""",
       "dispatch_day milestones", money="bounding_order_amount")
def in_transit_td(t: Tables):
    return fr.in_transit_td(
        fs.running_total_td(_dispatch(t), lit.ORDERS_AS_OF),
        fs.finished_orders_td(roles.milestone(t, "bound_finish"), lit.ORDERS_AS_OF),
    )

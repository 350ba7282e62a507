"""Queries over retail facts, summaries and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.functions.days import as_date, window_days
from daymill.operators import activity
from daymill.operators import reports as rp
from daymill.operators import summaries as sm
from daymill.operators import trade_facts as tf
from daymill.operators.dimensions import benefit_dim
from daymill.plans import literals as lit
from daymill.plans import roles
from daymill.plans.ctes import rounded
from daymill.plans.registry import Tables, query

ASOF = f"DATE '{lit.ORDERS_AS_OF}'"
EASOF = f"DATE '{lit.EVENTS_AS_OF}'"
AMOUNTS = "original_amount activity_reduce_amount coupon_reduce_amount total_amount"


@query("order_detail_fact",
       """SELECT fact.*, act.activity_id, act.activity_rule_id, cou.coupon_id FROM fact
       LEFT JOIN act ON act.order_detail_id = fact.id LEFT JOIN cou ON cou.order_detail_id = fact.id""",
       "fact act cou", "dt", AMOUNTS, "create_time")
def order_detail_fact(t: Tables):
    return tf.order_detail_fact(
        roles.order_lines(t), roles.order_headers(t), roles.line_activities(t), roles.line_coupons(t)
    )


@query("payment_fact",
       """SELECT payfact.*, act.activity_id, act.activity_rule_id, cou.coupon_id FROM payfact
       LEFT JOIN act ON act.order_detail_id = payfact.id LEFT JOIN cou ON cou.order_detail_id = payfact.id""",
       "payfact act cou", "dt", "original_amount activity_reduce_amount coupon_reduce_amount payment_amount", "callback_time")
def payment_fact(t: Tables):
    return tf.payment_fact(
        roles.order_lines(t), roles.order_headers(t), roles.payments(t), roles.codes(t), roles.line_activities(t),
        roles.line_coupons(t),
    )


_FLOW = """SELECT hdr.order_id, hdr.user_id, province_id, hdr.dt AS order_date_id, create_time AS order_time,
    CAST(callback_time AS DATE) AS payment_date_id, callback_time AS payment_time, CAST(done AS DATE) AS finish_date_id,
    done AS finish_time, amount + 2 AS original_amount, 1 AS activity_reduce_amount, 1 AS coupon_reduce_amount,
    amount AS total_amount, payment_amount FROM hdr
    LEFT JOIN (SELECT * FROM pay WHERE payment_status = '1602') p ON p.order_id = hdr.order_id
    LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS done FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = hdr.order_id"""


def _flow(t: Tables):
    one = F.lit(1).cast("decimal(16,2)")
    headers = roles.order_headers(t).withColumns({"activity_reduce_amount": one, "coupon_reduce_amount": one})
    log = (
        t.lineitem.where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.min(roles.instant("l_shipdate")).alias("create_time"))
        .withColumn("order_status", F.lit(tf.RECEIVED))
    )
    return tf.trade_flow_fact(headers, roles.payments(t), log)


@query("trade_flow_fact", _FLOW, "hdr pay", "order_date_id payment_date_id finish_date_id",
       AMOUNTS + " payment_amount", "order_time payment_time finish_time")
def trade_flow_fact(t: Tables):
    return _flow(t)


@query("filtered_event_fact",
       """SELECT 'favor' AS kind, event_id, user_id, CAST(ts AS DATE) AS date_id, ts AS event_time FROM events WHERE event_type = 'click' AND value < 50
       UNION ALL SELECT 'cart', event_id, user_id, CAST(ts AS DATE), ts FROM events WHERE event_type = 'view'
       UNION ALL SELECT 'coupon', event_id, user_id, CAST(ts AS DATE), ts FROM events WHERE event_type = 'purchase'""",
       days="date_id", times="event_time")
def filtered_event_fact(t: Tables):
    """Favourites not cancelled, cart adds, and vouchers with a use time, from the events."""
    events = t.events.select("event_id", "user_id", "event_type", "value", roles.instant("ts").alias("create_time")).withColumn(
        "used_time", F.when(F.col("event_type") == "purchase", F.col("create_time"))
    )
    kind = F.col("event_type")
    columns = ["event_id", "user_id"]
    favor = tf.filtered_event_fact(events, "create_time", columns, (kind == "click") & (F.col("value") < 50), timed=False)
    cart = tf.filtered_event_fact(events, "create_time", columns, kind == "view", timed=False)
    coupon = tf.filtered_event_fact(events, "used_time", columns)
    out = [df.select(F.lit(n).alias("kind"), "*") for n, df in (("favor", favor), ("cart", cart), ("coupon", coupon))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("page_view_fact", "SELECT * FROM views", "views", "dt", times="view_time")
def page_view_fact(t: Tables):
    return roles.page_views(t)


@query("login_fact", "SELECT * FROM logins", "logins", "date_id")
def login_fact(t: Tables):
    return roles.logins(t)


@query("register_fact",
       """SELECT users.id AS user_id, CAST(create_time AS DATE) AS date_id, create_time, channel, province_id, version_code, mid_id,
       brand, model, operate_system FROM users LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY view_time, event_id) AS rn
       FROM views WHERE user_id IS NOT NULL) v ON v.user_id = CAST(users.id AS VARCHAR) AND rn = 1""",
       "users views", "date_id", times="create_time")
def register_fact(t: Tables):
    return tf.register_fact(roles.users(t), roles.page_views(t), "event_id")


# ---- summaries ----------------------------------------------------------------


@query("user_order_1d", "SELECT * FROM user_day", "user_day", "dt", AMOUNTS)
def user_order_1d(t: Tables):
    return sm.user_order_1d(roles.order_facts(t))


@query("user_payment_1d",
       """SELECT user_id, dt, COUNT(DISTINCT order_id) AS payment_count, CAST(SUM(sku_num) AS BIGINT) AS payment_num,
       SUM(payment_amount) AS payment_amount FROM payfact WHERE order_id IS NOT NULL GROUP BY user_id, dt""",
       "payfact", "dt", "payment_amount")
def user_payment_1d(t: Tables):
    return sm.user_payment_1d(roles.payment_facts(t))


@query("user_cart_1d",
       """SELECT user_id, CAST(ts AS DATE) AS dt, COUNT(*) AS cart_add_count, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS cart_add_num
       FROM events WHERE event_type = 'click' GROUP BY 1, 2""", days="dt")
def user_cart_1d(t: Tables):
    return sm.user_cart_1d(_cart_adds(t))


def _cart_adds(t: Tables):
    return t.events.where(F.col("event_type") == "click").select(
        "user_id", F.to_date("ts").alias("dt"), F.get_json_object("props", "$.k").cast("bigint").alias("sku_num")
    )


@query("geo_order_1d", "SELECT * FROM geo_day", "geo_day", "dt", AMOUNTS)
def geo_order_1d(t: Tables):
    return sm.geo_order_1d(roles.order_facts(t, True), roles.geo(t))


@query("user_sku_order_1d", "SELECT * FROM usku_day", "usku_day", "dt", AMOUNTS)
def user_sku_order_1d(t: Tables):
    return sm.user_sku_order_1d(roles.order_facts(t), roles.products(t))


def _favors(t: Tables):
    return t.lineitem.select(F.col("l_partkey").alias("sku_id"), F.to_date("l_shipdate").alias("dt"))


@query("sku_favor_1d",
       """SELECT l_partkey AS sku_id, CAST(l_shipdate AS DATE) AS dt, COUNT(*) AS favor_add_count, sku_name,
       category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name FROM lineitem LEFT JOIN sku ON sku_id = l_partkey GROUP BY ALL""", "sku", "dt")
def sku_favor_1d(t: Tables):
    return sm.sku_favor_1d(_favors(t), roles.products(t))


def _coupon_days(t: Tables):
    coupons = benefit_dim(roles.coupon_rules(t), roles.codes(t), "coupon")
    return sm.user_coupon_1d(roles.coupon_uses(t), coupons)


@query("user_coupon_1d",
       """SELECT user_id, coupon_id, dt, COUNT(*) AS used_count, coupon_name, rule_type_name AS coupon_type_name, benefit_rule
       FROM uses LEFT JOIN coupons ON coupons.id = coupon_id GROUP BY ALL""", "uses coupons", "dt")
def user_coupon_1d(t: Tables):
    return _coupon_days(t)


@query("session_page_1d", "SELECT * FROM sess", "sess", "dt")
def session_page_1d(t: Tables):
    return sm.session_page_1d(roles.page_views(t))


@query("visitor_page_1d",
       """SELECT mid_id, brand, model, operate_system, page_id, dt, CAST(SUM(during_time) AS BIGINT) AS during_time, COUNT(*) AS view_count
       FROM views GROUP BY ALL""", "views", "dt")
def visitor_page_1d(t: Tables):
    return sm.visitor_page_1d(roles.page_views(t))


def _windows_sql(table: str, keys: str, measures: list[str], label: str = "") -> str:
    cols = ", ".join(
        f"SUM(CASE WHEN dt > {ASOF} - {n} THEN {m} END) AS {m}_{n}d" for n in (7, 30) for m in measures
    )
    return f"SELECT {keys}, {cols} FROM {table} WHERE dt > {ASOF} - 30 AND dt <= {ASOF} GROUP BY {keys}"


@query("rolling_window_rollup",
       f"""SELECT w.*, l.n7, l.n30 FROM ({_windows_sql("geo_day", "province_id, province_name", ["order_count", "total_amount"])}) w
       JOIN (SELECT province_id, SUM(CASE WHEN dt > {ASOF} - 7 THEN order_count END) AS n7, SUM(order_count) AS n30 FROM geo_day
       WHERE dt > {ASOF} - 30 AND dt <= {ASOF} GROUP BY province_id) l ON l.province_id = w.province_id""",
       "geo_day", money="order_count_7d order_count_30d total_amount_7d total_amount_30d n7 n30")
def rolling_window_rollup(t: Tables):
    """Both shapes of the rollup, next to each other."""
    daily = sm.geo_order_1d(roles.order_facts(t, True), roles.geo(t))
    keys, measures = ["province_id", "province_name"], ["order_count", "total_amount"]
    wide = sm.rolling_window_rollup(daily, keys, measures, lit.ORDERS_AS_OF)
    long = sm.rolling_window_rollup(daily, ["province_id"], ["order_count"], lit.ORDERS_AS_OF, shape="long")
    side = long.groupBy(F.col("province_id").alias("__p")).agg(
        F.sum(F.when(F.col("recent_days") == 7, F.col("order_count"))).cast("double").alias("n7"),
        F.sum(F.when(F.col("recent_days") == 30, F.col("order_count"))).cast("double").alias("n30"),
    )
    out = wide.join(side, F.col("province_id") == F.col("__p")).drop("__p")
    return out.withColumns({c: F.col(c).cast("double") for c in ("order_count_7d", "order_count_30d")})


_TD = """SELECT user_id, MIN(dt) AS order_date_first, MAX(dt) AS order_date_last, CAST(SUM(order_count) AS BIGINT) AS order_count,
    CAST(SUM(order_num) AS BIGINT) AS order_num, SUM(original_amount) AS original_amount, SUM(activity_reduce_amount) AS activity_reduce_amount,
    SUM(coupon_reduce_amount) AS coupon_reduce_amount, SUM(total_amount) AS total_amount FROM user_day GROUP BY user_id"""


@query("user_order_td", _TD, "user_day", "order_date_first order_date_last", AMOUNTS)
def user_order_td(t: Tables):
    return sm.user_order_td(sm.user_order_1d(roles.order_facts(t)))


@query("user_order_td_incremental", _TD, "user_day", "order_date_first order_date_last", AMOUNTS)
def user_order_td_incremental(t: Tables):
    """The same table from the table of an earlier day and the days since."""
    daily = sm.user_order_1d(roles.order_facts(t))
    cut = F.lit("2001-01-01").cast("date")
    rules = {"order_date_first": "min", "order_date_last": "max", "order_count": "sum", "order_num": "sum"}
    rules |= {c: "sum" for c in sm.AMOUNTS}
    return sm.roll_forward(
        sm.user_order_td(daily.where(F.col("dt") < cut)), sm.user_order_td(daily.where(F.col("dt") >= cut)), ["user_id"], rules
    )


def _login_td(t: Tables, as_of: str = lit.EVENTS_AS_OF):
    day = F.lit(as_of).cast("date")
    users = roles.users(t).where(F.to_date("create_time") <= day)
    return sm.user_login_td(users, roles.logins(t).where(F.col("date_id") <= day))


@query("user_login_td", "SELECT * FROM login_td", "login_td", "login_date_last login_date_first")
def user_login_td(t: Tables):
    return _login_td(t)


# ---- reports ------------------------------------------------------------------


@query("coupon_report",
       """SELECT coupon_id, coupon_name, COUNT(*) AS used_count, COUNT(DISTINCT user_id) AS used_user_count FROM uses
       LEFT JOIN coupons ON coupons.id = coupon_id GROUP BY ALL""", "uses coupons")
def coupon_report(t: Tables):
    return rp.coupon_report(_coupon_days(t))


@query("new_order_users",
       f"""SELECT recent_days, COUNT(*) AS new_order_user_count FROM ({_TD}), (VALUES (1), (7), (30)) w(recent_days)
       WHERE order_date_first > DATE '1995-02-15' - recent_days AND order_date_first <= DATE '1995-02-15' GROUP BY recent_days""", "user_day")
def new_order_users(t: Tables):
    """Reported for an early day; by the last days of the data every user has ordered before."""
    return rp.new_order_users(sm.user_order_td(sm.user_order_1d(roles.order_facts(t))), "1995-02-15")


@query("geo_order_report",
       f"""SELECT recent_days, province_id, province_name, area_code, iso_code, iso_3166_2, CAST(SUM(order_count) AS BIGINT) AS order_count,
       SUM(total_amount) AS order_total_amount FROM geo_day, (VALUES (1), (7), (30)) w(recent_days)
       WHERE dt > {ASOF} - recent_days AND dt <= {ASOF} GROUP BY ALL""", "geo_day", money="order_total_amount")
def geo_order_report(t: Tables):
    daily = sm.geo_order_1d(roles.order_facts(t, True), roles.geo(t))
    keys = ["province_id", *sm.GEO_NAMES]
    wide = sm.rolling_window_rollup(daily, keys, ["order_count", "total_amount"], lit.ORDERS_AS_OF, (1, 7, 30))
    return rp.geo_order_report(wide)


@query("consecutive_order_users",
       f"""SELECT {EASOF} AS dt, 7 AS recent_days, COUNT(DISTINCT a.user_id) AS user_count FROM
       (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase') a
       JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase') b ON b.user_id = a.user_id AND b.d = a.d + 1
       JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase') c ON c.user_id = a.user_id AND c.d = a.d + 2
       WHERE a.d > {EASOF} - 7 AND c.d <= {EASOF}""", days="dt")
def consecutive_order_users(t: Tables):
    bought = t.events.where(F.col("event_type") == "purchase").select("user_id", F.to_date("ts").alias("dt"))
    return activity.active_in_a_row(activity.activity_map(bought, "user_id", "dt", lit.EVENTS_AS_OF), lit.EVENTS_AS_OF)


def _usku(t: Tables):
    return sm.user_sku_order_1d(roles.order_facts(t), roles.products(t))


def _by_group_sql(kind: str, key: str, name: str) -> str:
    return f"""SELECT '{kind}' AS kind, recent_days, {key} AS group_id, {name} AS group_name, CAST(SUM(order_count) AS BIGINT) AS order_count,
        COUNT(DISTINCT user_id) AS order_user_count FROM usku_day, (VALUES (1), (7), (30)) w(recent_days)
        WHERE dt > {ASOF} - recent_days AND dt <= {ASOF} GROUP BY ALL"""


@query("order_report_by_group",
       _by_group_sql("category", "CAST(category3_id AS VARCHAR)", "category3_name") + " UNION ALL " + _by_group_sql("brand", "tm_id", "tm_name"), "usku_day")
def order_report_by_group(t: Tables):
    daily = _usku(t)

    def one(kind: str, keys: list[str]):
        out = rp.order_report_by_group(daily, keys, lit.ORDERS_AS_OF)
        return out.select(
            F.lit(kind).alias("kind"), "recent_days", F.col(keys[0]).cast("string").alias("group_id"), F.col(keys[1]).alias("group_name"),
            "order_count", "order_user_count",
        )

    return one("category", ["category3_id", "category3_name"]).unionByName(one("brand", ["tm_id", "tm_name"]))


_LEVELS = ["category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name"]


@query("order_report_by_category",
       f"""SELECT recent_days, {', '.join(_LEVELS)}, CAST(SUM(order_count) AS BIGINT) AS order_count, COUNT(DISTINCT user_id) AS order_user_count
       FROM usku_day, (VALUES (1), (7), (30)) w(recent_days) WHERE dt > {ASOF} - recent_days AND dt <= {ASOF} GROUP BY ALL""", "usku_day")
def order_report_by_category(t: Tables):
    """Three levels of category with their names."""
    return rp.order_report_by_group(_usku(t), _LEVELS, lit.ORDERS_AS_OF)


@query("order_to_pay_avg",
       f"""SELECT payment_date_id AS dt, CAST(SUM(epoch(payment_time) - epoch(order_time)) AS BIGINT) // COUNT(*) AS order_to_pay_interval_avg
       FROM ({_FLOW}) WHERE payment_date_id IS NOT NULL GROUP BY 1""", "hdr pay", "dt")
def order_to_pay_avg(t: Tables):
    return rp.order_to_pay_avg(_flow(t))


@query("page_path",
       """SELECT source, target, COUNT(*) AS path_count FROM (SELECT 'step-' || rn || ':' || page_id AS source,
       COALESCE('step-' || (rn + 1) || ':' || nxt, 'null') AS target FROM (SELECT page_id,
       lead(page_id) OVER (PARTITION BY session_id ORDER BY view_time, event_id) AS nxt,
       row_number() OVER (PARTITION BY session_id ORDER BY view_time, event_id) AS rn FROM views)) GROUP BY 1, 2""", "views")
def page_path(t: Tables):
    return rp.page_path(roles.page_views(t), "session_id", "view_time", "event_id", "page_id")


@query("repeat_purchase_rate",
       f"""SELECT {ASOF} AS dt, 30 AS recent_days, tm_id, tm_name, {rounded("COUNT(CASE WHEN n >= 2 THEN 1 END)", "COUNT(CASE WHEN n >= 1 THEN 1 END)", 2)}
       AS order_repeat_rate FROM (SELECT user_id, tm_id, tm_name, SUM(order_count) AS n FROM usku_day WHERE dt > {ASOF} - 30 AND dt <= {ASOF}
       GROUP BY 1, 2, 3) GROUP BY tm_id, tm_name""", "usku_day", "dt")
def repeat_purchase_rate(t: Tables):
    nd = sm.rolling_window_rollup(
        _usku(t), ["user_id", "sku_id", "tm_id", "tm_name"], ["order_count"], lit.ORDERS_AS_OF
    )
    return rp.repeat_purchase_rate(nd, lit.ORDERS_AS_OF)


@query("cart_top3_by_category",
       """SELECT * FROM (SELECT c.sku_id, sku_name, category_id, category_name, cart_num,
       rank() OVER (PARTITION BY category_id ORDER BY cart_num DESC) AS rk FROM (SELECT l_partkey AS sku_id,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cart_num FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) c
       LEFT JOIN sku ON sku.sku_id = c.sku_id) WHERE rk <= 3""", "sku")
def cart_top3_by_category(t: Tables):
    cart = t.lineitem.where(F.col("l_linestatus") == "O").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("bigint").alias("sku_num")
    )
    return rp.cart_top3_by_category(cart, roles.products(t))


@query("favor_top3_by_brand",
       """SELECT * FROM (SELECT tm_id, tm_name, f.sku_id, sku_name, favor_add_count_1d,
       rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS rk FROM (SELECT l_partkey AS sku_id,
       COUNT(*) AS favor_add_count_1d FROM lineitem GROUP BY 1) f LEFT JOIN sku ON sku.sku_id = f.sku_id) WHERE rk <= 3""", "sku")
def favor_top3_by_brand(t: Tables):
    """Favourites of the whole period as one report day."""
    period = _favors(t).withColumn("dt", F.lit(lit.ORDERS_AS_OF).cast("date"))
    return rp.favor_top3_by_brand(sm.sku_favor_1d(period, roles.products(t)))


@query("channel_traffic",
       f"""SELECT recent_days, channel, COUNT(DISTINCT mid_id) AS uv_count, CAST(SUM(during_time) AS BIGINT) // (COUNT(*) * 1000) AS avg_duration_sec,
       CAST(SUM(page_count) AS BIGINT) // COUNT(*) AS avg_page_count, COUNT(*) AS sv_count,
       {rounded("COUNT(CASE WHEN page_count = 1 THEN 1 END)", "COUNT(*)", 2)} AS bounce_rate FROM sess, (VALUES (1), (7), (30)) w(recent_days)
       WHERE dt > {EASOF} - recent_days AND dt <= {EASOF} GROUP BY ALL""", "sess")
def channel_traffic(t: Tables):
    return rp.channel_traffic(sm.session_page_1d(roles.page_views(t, window_days(lit.EVENTS_AS_OF))), lit.EVENTS_AS_OF)


_FUNNEL_STEPS = {"cart_count": "click", "order_count": "signup", "payment_count": "purchase"}


@query("action_funnel",
       """SELECT CAST(dt AS VARCHAR) AS dt, COALESCE(home_count, 0) AS home_count, COALESCE(good_detail_count, 0) AS good_detail_count,
       COALESCE(cart_count, 0) AS cart_count, COALESCE(order_count, 0) AS order_count, COALESCE(payment_count, 0) AS payment_count FROM
       (SELECT dt, COUNT(DISTINCT CASE WHEN page_id = 'view' THEN mid_id END) AS home_count,
        COUNT(DISTINCT CASE WHEN page_id = 'click' THEN mid_id END) AS good_detail_count FROM views WHERE page_id IN ('view', 'click') GROUP BY dt)"""
       + "".join(
           f""" FULL OUTER JOIN (SELECT CAST(ts AS DATE) AS dt, COUNT(DISTINCT user_id) AS {name} FROM events
           WHERE event_type = '{event}' GROUP BY 1) USING (dt)"""
           for name, event in _FUNNEL_STEPS.items()
       ), "views")
def action_funnel(t: Tables):
    day = F.to_date("ts").alias("dt")

    def per_user(event: str):
        return t.events.where(F.col("event_type") == event).select("user_id", day).distinct()

    pages = sm.visitor_page_1d(roles.page_views(t))
    return rp.action_funnel(pages, sm.user_cart_1d(_cart_adds(t)), per_user("signup"), per_user("purchase"), "view", "click")


def _login_map(t: Tables) -> DataFrame:
    """The days each user was active on; three reports read it."""
    held = activity.activity_map(roles.logins(t).withColumn("user_id", F.col("user_id").cast("bigint")), "user_id", "date_id", lit.EVENTS_AS_OF)
    users = roles.users(t).select(F.col("id").cast("bigint").alias("user_id"), F.to_date("create_time").alias("made"))
    return activity.with_register_day(users.where(F.col("made") <= F.lit(lit.EVENTS_AS_OF).cast("date")), held, "user_id", "made", lit.EVENTS_AS_OF)


@query("activity_map",
       f"""SELECT user_id, CAST(SUM(DISTINCT CAST(power(2, {EASOF} - d) AS BIGINT)) AS BIGINT) AS days FROM
       (SELECT user_id, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) <= {EASOF}) GROUP BY user_id""")
def activity_map(t: Tables):
    """Days of action of each user, rolled on from the map of ten days before a day at a time."""
    rows = t.events.select("user_id", F.to_date("ts").alias("dt"))
    last = as_date(lit.EVENTS_AS_OF)
    day = last - dt.timedelta(days=10)
    made = activity.activity_map(rows, "user_id", "dt", day)
    while day < last:
        day += dt.timedelta(days=1)
        made = activity.rolled(made, rows.where(F.col("dt") == F.lit(day)), "user_id", day)
    return made.select("user_id", "days")


@query("churn_and_return",
       f"""SELECT {EASOF} AS dt, (SELECT COUNT(*) FROM login_td WHERE login_date_last = {EASOF} - 7) AS user_churn_count,
       (SELECT COUNT(*) FROM login_td a JOIN (SELECT id, COALESCE(last, CAST(create_time AS DATE)) AS last_before FROM users
         LEFT JOIN (SELECT user_id AS u, MAX(date_id) AS last FROM logins WHERE date_id <= {EASOF} - 1 GROUP BY 1) ON u = CAST(id AS VARCHAR)
         WHERE CAST(create_time AS DATE) <= {EASOF} - 1) b ON b.id = a.user_id
        WHERE login_date_last = {EASOF} AND last_before <= {EASOF} - 8) AS user_back_count""", "login_td", "dt")
def churn_and_return(t: Tables):
    return activity.churn_and_return(_login_map(t), lit.EVENTS_AS_OF)


@query("retention",
       f"""SELECT {EASOF} AS dt, login_date_first AS create_date, COUNT(CASE WHEN login_date_last = {EASOF} THEN 1 END) AS retention_count,
       COUNT(*) AS new_user_count, {rounded(f"100 * COUNT(CASE WHEN login_date_last = {EASOF} THEN 1 END)", "COUNT(*)", 2)} AS retention_rate,
       CAST({EASOF} - login_date_first AS INTEGER) AS retention_day FROM login_td
       WHERE login_date_first >= {EASOF} - 7 AND login_date_first < {EASOF} GROUP BY login_date_first""", "login_td", "dt create_date")
def retention(t: Tables):
    return activity.retention(_login_map(t), lit.EVENTS_AS_OF)


@query("user_activity",
       f"""SELECT recent_days, COUNT(CASE WHEN login_date_first > {EASOF} - recent_days THEN 1 END) AS new_user_count, COUNT(*) AS active_user_count
       FROM login_td, (VALUES (1), (7), (30)) w(recent_days) WHERE login_date_last > {EASOF} - recent_days GROUP BY recent_days""", "login_td")
def user_activity(t: Tables):
    return activity.user_activity(_login_map(t), lit.EVENTS_AS_OF)

"""Queries over customer-service offers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymill.functions import days
from daymill.operators import offers as of
from daymill.plans import literals as lit
from daymill.plans import roles
from daymill.plans.ctes import cents, rounded
from daymill.plans.registry import Tables, query

ASOF = f"DATE '{lit.ORDERS_AS_OF}'"


@query("offer_activity_fact",
       f"""SELECT *, {rounded("epoch(end_time) - epoch(start_time)", "3600", 2)} AS activity_duration,
       CASE WHEN status = 1 AND end_time > TIMESTAMP '{lit.OFFERS_NOW}' THEN 1 ELSE 0 END AS is_valid,
       CASE WHEN activity_name LIKE '%hot%' THEN 1 ELSE 0 END AS is_test_data FROM acts""", "acts", times="start_time end_time")
def offer_activity_fact(t: Tables):
    return of.offer_activity_fact(roles.activities(t), roles.offers_now(), "%hot%")


@query("offer_send_fact", "SELECT * FROM sendfact", "sendfact", "dt", "offer_amount", "send_time expire_time")
def offer_send_fact(t: Tables):
    return roles.send_facts(t)


@query("offer_redemption_fact",
       f"""SELECT *, CAST(redemption_time AS DATE) AS redemption_date, strftime(redemption_time, '%H') AS redemption_hour,
       {rounded(cents("actual_offer_amount"), cents("payment_amount"), 4)} AS offer_rate,
       payment_amount + actual_offer_amount AS original_amount FROM reds""",
       "reds", "redemption_date", "actual_offer_amount payment_amount original_amount", "redemption_time")
def offer_redemption_fact(t: Tables):
    return of.offer_redemption_fact(roles.redemptions(t))


@query("agent_daily_fact",
       f"""SELECT cs_id, stat_date, COALESCE(send_count, 0) AS send_count, COALESCE(redemption_count, 0) AS redemption_count,
       COALESCE(total_offer_amount, 0) AS total_offer_amount, COALESCE(total_sales, 0) AS total_sales,
       COALESCE({rounded(cents("total_offer_amount"), "100 * send_count", 2)}, 0) AS avg_offer_amount,
       COALESCE({rounded(cents("total_sales"), "100 * redemption_count", 2)}, 0) AS avg_order_amount,
       COALESCE({rounded("COALESCE(redemption_count, 0)", "send_count", 4)}, 0) AS redemption_rate
       FROM (SELECT cs_id, CAST(send_time AS DATE) AS stat_date, COUNT(*) AS send_count, SUM(offer_amount) AS total_offer_amount FROM sends GROUP BY 1, 2)
       FULL OUTER JOIN (SELECT cs_id, CAST(redemption_time AS DATE) AS stat_date, COUNT(*) AS redemption_count, SUM(payment_amount) AS total_sales
       FROM reds JOIN sends ON sends.record_id = reds.record_id GROUP BY 1, 2) USING (cs_id, stat_date)""",
       "sends reds", "stat_date", "total_offer_amount total_sales")
def agent_daily_fact(t: Tables):
    return of.agent_daily_fact(roles.sends(t), roles.redemptions(t))


_PER = f"""COUNT(record_id) AS send_count, COALESCE(CAST(SUM(n) AS BIGINT), 0) AS redemption_count,
    COALESCE({rounded("SUM(n)", "COUNT(record_id)", 4)}, 0) AS redemption_rate, SUM(sales) AS total_sales"""
_AVG = f"{rounded(cents('SUM(offer_amount)'), '100 * COUNT(*)', 2)} AS avg_offer_amount"
_WAIT = rounded("SUM(wait)", "SUM(n) * 3600", 2)


@query("offer_activity_stats",
       f"""SELECT acts.activity_id, acts.activity_name, CAST(start_time AS DATE) AS start_date, CAST(end_time AS DATE) AS end_date, acts.status,
       COALESCE(send_count, 0) AS send_count, COALESCE(redemption_count, 0) AS redemption_count, redemption_rate, total_sales, avg_offer_amount,
       max_offer_amount, min_offer_amount, COALESCE(total_customers, 0) AS total_customers, avg_redemption_time FROM acts
       LEFT JOIN (SELECT activity_id, {_PER}, {_AVG}, MAX(offer_amount) AS max_offer_amount, MIN(offer_amount) AS min_offer_amount,
       COUNT(DISTINCT customer_id) AS total_customers, {_WAIT} AS avg_redemption_time FROM sendred GROUP BY activity_id) p ON p.activity_id = acts.activity_id""",
       "acts sendred", "start_date end_date", "total_sales max_offer_amount min_offer_amount")
def offer_activity_stats(t: Tables):
    return of.offer_activity_stats(roles.activities(t), roles.send_facts(t), roles.redemptions(t))


@query("offer_product_stats",
       f"""SELECT p.product_id, dt AS stat_date, {_PER}, MAX(offer_amount) AS max_offer_amount, MIN(offer_amount) AS min_offer_amount,
       {_WAIT} AS avg_redemption_time, ROUND(SUM(rates) / SUM(rated), 4) AS avg_offer_rate, '商品-' || p.product_id AS product_name
       FROM sendred LEFT JOIN (SELECT DISTINCT product_id FROM offprod) p ON p.product_id = sendred.product_id GROUP BY p.product_id, dt""",
       "sendred offprod", "stat_date", "total_sales max_offer_amount min_offer_amount")
def offer_product_stats(t: Tables):
    return of.offer_product_stats(roles.send_facts(t), roles.redemptions(t), roles.offer_products(t))


_TIME = f"""SELECT a.*, lpad(CAST(h AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(h AS VARCHAR), 2, '0') || ':59' AS busiest_hour FROM (
    SELECT time_type, time_value, {_PER}, {_AVG}, {_WAIT} AS avg_process_time,
    lpad(CAST(quantile_disc(hour(send_time), 0.5) AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(quantile_disc(hour(send_time), 0.5) AS VARCHAR), 2, '0') || ':59' AS peak_hour
    FROM grains GROUP BY 1, 2) a
    JOIN (SELECT time_type, time_value, h FROM (SELECT time_type, time_value, hour(send_time) AS h,
      row_number() OVER (PARTITION BY time_type, time_value ORDER BY COUNT(*) DESC, hour(send_time)) AS rn FROM grains GROUP BY 1, 2, 3) WHERE rn = 1) b
    USING (time_type, time_value)"""
_GRAINS = """(SELECT 'day' AS time_type, strftime(send_time, '%Y-%m-%d') AS time_value, * FROM sendred UNION ALL
    SELECT 'week', isoyear(send_time) || '-' || lpad(CAST(week(send_time) AS VARCHAR), 2, '0'), * FROM sendred UNION ALL
    SELECT 'month', strftime(send_time, '%Y-%m'), * FROM sendred)"""


@query("offer_time_stats", _TIME.replace("grains", _GRAINS), "sendred", money="total_sales")
def offer_time_stats(t: Tables):
    return of.offer_time_stats(roles.send_facts(t), roles.redemptions(t))


@query("offer_trend",
       f"""SELECT time_type AS time_dimension, time_value, send_count, redemption_count, redemption_rate, total_sales AS sales_amount,
       avg_offer_amount, peak_hour FROM ({_TIME.replace("grains", _GRAINS)})""", "sendred", money="sales_amount")
def offer_trend(t: Tables):
    return of.offer_trend(of.offer_time_stats(roles.send_facts(t), roles.redemptions(t)))


@query("agent_wide", "SELECT * FROM wide", "wide", "stat_date", "total_sales")
def agent_wide(t: Tables):
    return of.agent_wide(roles.send_facts(t), roles.redemptions(t), roles.agents(t))


@query("offer_overview",
       f"""SELECT recent_days, COUNT(*) AS total_send_count, CAST(SUM(is_used) AS BIGINT) AS total_redemption_count,
       {rounded("SUM(is_used)", "COUNT(*)", 4)} AS overall_redemption_rate, {_AVG}, COUNT(DISTINCT cs_id) AS active_cs_count,
       COUNT(DISTINCT customer_id) AS active_customer_count, {ASOF} AS stat_date FROM sendfact, (VALUES (1), (7), (30)) w(recent_days)
       WHERE dt > {ASOF} - recent_days AND dt <= {ASOF} GROUP BY recent_days""", "sendfact", "stat_date")
def offer_overview(t: Tables):
    return of.offer_overview(roles.send_facts(t, days.window_days(lit.ORDERS_AS_OF)), lit.ORDERS_AS_OF)


@query("offer_activity_effect",
       f"""SELECT acts.activity_id, acts.activity_name, acts.status, CAST(start_time AS DATE) AS start_date, CAST(end_time AS DATE) AS end_date,
       COALESCE(send_count, 0) AS send_count, COALESCE(redemption_count, 0) AS redemption_count, redemption_rate, total_sales, avg_redemption_time,
       top_product_id FROM acts LEFT JOIN (SELECT activity_id, {_PER},
       {_WAIT} AS avg_redemption_time FROM sendred GROUP BY activity_id) p ON p.activity_id = acts.activity_id
       LEFT JOIN (SELECT activity_id, product_id AS top_product_id FROM (SELECT activity_id, product_id, row_number() OVER (PARTITION BY activity_id
       ORDER BY COALESCE(SUM(n), 0) DESC, product_id) AS rn FROM sendred GROUP BY 1, 2) WHERE rn = 1) b ON b.activity_id = acts.activity_id""",
       "acts sendred", "start_date end_date", "total_sales")
def offer_activity_effect(t: Tables):
    return of.offer_activity_effect(roles.activities(t), roles.send_facts(t), roles.redemptions(t))


@query("agent_rank_change",
       f"""SELECT a.* EXCLUDE (rank_in_dept, stat_week, stat_month), a.rank_in_dept AS rank, a.rank_in_dept - b.rank_in_dept AS rank_change
       FROM wide a LEFT JOIN wide b ON b.cs_id = a.cs_id AND b.dept_name = a.dept_name AND b.stat_date = a.stat_date - 1
       WHERE a.stat_date = {ASOF}""", "wide", "stat_date", "total_sales")
def agent_rank_change(t: Tables):
    # Two days are ranked; the day before has nothing to be compared with.
    two = (days.as_date(lit.ORDERS_AS_OF) - dt.timedelta(days=1), lit.ORDERS_AS_OF)
    wide = of.agent_wide(roles.send_facts(t, two), roles.redemptions(t), roles.agents(t))
    return of.agent_rank_change(wide, lit.ORDERS_AS_OF)


@query("offer_send_list",
       """SELECT s.record_id, send_time, cs_name, customer_id, CASE WHEN p.product_id IS NOT NULL THEN '活动商品-' || p.product_id ELSE '未知商品' END AS product_name,
       offer_amount, CASE s.status WHEN 1 THEN '未使用' WHEN 2 THEN '已使用' WHEN 3 THEN '已过期' ELSE '未知' END AS status, redemption_time,
       payment_amount AS order_amount, s.activity_name, expire_time, (CASE WHEN remaining_time IS NULL THEN '无限制' WHEN remaining_time = 0 THEN '已过期'
       ELSE CAST(CAST(remaining_time AS DECIMAL(16,2)) AS VARCHAR) END) || '小时' AS remaining_time FROM sendfact s
       LEFT JOIN reds ON reds.record_id = s.record_id LEFT JOIN agents ON agents.cs_id = s.cs_id
       LEFT JOIN (SELECT DISTINCT product_id FROM offprod) p ON p.product_id = s.product_id""",
       "sendfact reds agents offprod", "", "offer_amount order_amount", "send_time redemption_time expire_time")
def offer_send_list(t: Tables):
    return of.offer_send_list(
        roles.send_facts(t), roles.redemptions(t), roles.agents(t), roles.activities(t), roles.offer_products(t)
    )

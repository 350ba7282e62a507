"""The same roles as SQL, for the comparison queries only."""

from __future__ import annotations

from daymill.plans import literals as lit

def rounded(top: str, bottom: str, digits: int) -> str:
    """SQL of a quotient of whole numbers, rounded half up in whole-number arithmetic."""
    a, b = f"CAST({top} AS HUGEINT)", f"NULLIF(CAST({bottom} AS HUGEINT), 0)"
    return f"(sign({a}) * ((2 * abs({a}) * {10**digits} + {b}) // (2 * {b})) / {10**digits}.0)"


def cents(amount: str) -> str:
    return f"({amount}) * 100"


# name: (names it needs, body)
CTES: dict[str, tuple[str, str]] = {
    "codes": ("", f"SELECT * FROM (VALUES {lit.CODE_ROWS}) AS v(dic_code, dic_name, parent_code)"),
    "hdr": (
        "",
        """SELECT o_orderkey AS order_id, o_custkey AS user_id, c_nationkey AS province_id, o_orderstatus AS state,
        CAST(o_totalprice AS DECIMAL(16,2)) AS amount, o_orderdate AS create_time, CAST(o_orderdate AS DATE) AS dt
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    ),
    "lin0": (
        "",
        """SELECT l_orderkey*10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
        l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS sku_num,
        CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_discount AS DECIMAL(4,2)) AS discount,
        CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS gross,
        l_linestatus, l_returnflag, l_shipdate FROM lineitem""",
    ),
    "det": (
        "lin0",
        """SELECT *, CASE WHEN l_linestatus = 'O' THEN reduction END AS split_activity_amount,
        CASE WHEN l_linestatus = 'F' THEN reduction END AS split_coupon_amount,
        CAST(gross - reduction AS DECIMAL(16,2)) AS split_total_amount
        FROM (SELECT *, CAST(gross * discount AS DECIMAL(16,2)) AS reduction FROM lin0)""",
    ),
    "act": (
        "lin0",
        """SELECT id AS order_detail_id, MIN(supplier_id) AS activity_id, MIN(supplier_id) % 7 AS activity_rule_id
        FROM lin0 WHERE l_linestatus = 'O' GROUP BY id""",
    ),
    "cou": (
        "lin0",
        """SELECT id AS order_detail_id, MIN(CAST(discount*100 AS INT)) AS coupon_id
        FROM lin0 WHERE l_linestatus = 'F' AND discount > 0 GROUP BY id""",
    ),
    "fact": (
        "det hdr",
        """SELECT det.id, det.order_id, user_id, sku_id, province_id, CAST(l_shipdate AS DATE) AS dt,
        l_shipdate AS create_time, sku_num, gross AS original_amount,
        COALESCE(split_activity_amount, 0) AS activity_reduce_amount,
        COALESCE(split_coupon_amount, 0) AS coupon_reduce_amount, split_total_amount AS total_amount
        FROM det LEFT JOIN hdr ON hdr.order_id = det.order_id""",
    ),
    "pay": (
        "",
        """SELECT o_orderkey AS order_id, o_custkey AS user_id, '110' || (o_orderkey % 4) AS payment_type,
        CASE WHEN o_orderstatus = 'F' THEN '1602' ELSE '1601' END AS payment_status,
        o_orderdate + to_hours(CAST(o_orderkey % 72 AS INT)) AS callback_time,
        CAST(o_totalprice AS DECIMAL(16,2)) AS payment_amount FROM orders""",
    ),
    "payfact": (
        "det pay hdr codes",
        """SELECT det.id, p.order_id, p.user_id, sku_id, province_id, payment_type, dic_name AS payment_type_name,
        CAST(callback_time AS DATE) AS dt, callback_time, sku_num,
        CAST(COALESCE(split_activity_amount,0) + COALESCE(split_coupon_amount,0) + split_total_amount
             AS DECIMAL(16,2)) AS original_amount,
        COALESCE(split_activity_amount, 0) AS activity_reduce_amount,
        COALESCE(split_coupon_amount, 0) AS coupon_reduce_amount, split_total_amount AS payment_amount
        FROM det LEFT JOIN hdr ON hdr.order_id = det.order_id
        LEFT JOIN (SELECT * FROM pay WHERE payment_status = '1602') p ON p.order_id = det.order_id
        LEFT JOIN (SELECT * FROM codes WHERE parent_code = '11') c ON c.dic_code = p.payment_type""",
    ),
    "sku": (
        "",
        """SELECT p_partkey AS sku_id, p_name AS sku_name, p_type AS category_id, lower(p_type) AS category_name,
        p_size % 2 AS category1_id, 'root ' || (p_size % 2) AS category1_name, p_size % 10 AS category2_id,
        'group ' || (p_size % 10) AS category2_name, p_size AS category3_id, 'size ' || p_size AS category3_name,
        p_brand AS tm_id, lower(p_brand) AS tm_name FROM part""",
    ),
    "geo": (
        "",
        """SELECT n_nationkey AS province_id, n_name AS province_name, n_regionkey AS region_id, r_name AS region_name,
        CAST(n_nationkey + 100 AS VARCHAR) AS area_code, 'C-' || n_nationkey AS iso_code, 'C-' || left(n_name, 2) AS iso_3166_2
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    ),
    "coupons": (
        "codes",
        """SELECT id, 'coupon ' || id AS coupon_name, rule_type, dic_name AS rule_type_name,
        CASE rule_type WHEN '3201' THEN '满' || (id*10) || '元减' || id || '元'
        WHEN '3202' THEN '满' || (CASE WHEN id % 5 <> 0 THEN id END) || '件打' || (10 - id % 10) || ' 折'
        WHEN '3203' THEN '减' || id || '元' END AS benefit_rule,
        id*10 AS condition_amount, CASE WHEN id % 5 <> 0 THEN id END AS condition_num, id AS benefit_amount,
        10 - id % 10 AS benefit_discount
        FROM (SELECT DISTINCT CAST(CAST(l_discount AS DECIMAL(4,2))*100 AS INT) AS id,
              '320' || (CAST(CAST(l_discount AS DECIMAL(4,2))*100 AS INT) % 4) AS rule_type FROM lineitem)
        LEFT JOIN (SELECT * FROM codes WHERE parent_code = '32') ON dic_code = rule_type""",
    ),
    "uses": (
        "lin0 hdr",
        """SELECT lin0.id, CAST(discount*100 AS INT) AS coupon_id, user_id, lin0.order_id,
        CAST(l_shipdate AS DATE) AS dt, l_shipdate AS used_time
        FROM lin0 JOIN hdr ON hdr.order_id = lin0.order_id WHERE discount > 0""",
    ),
    "user_day": (
        "fact",
        """SELECT user_id, dt, COUNT(DISTINCT order_id) AS order_count, CAST(SUM(sku_num) AS BIGINT) AS order_num,
        SUM(original_amount) AS original_amount, SUM(activity_reduce_amount) AS activity_reduce_amount,
        SUM(coupon_reduce_amount) AS coupon_reduce_amount, SUM(total_amount) AS total_amount
        FROM fact GROUP BY user_id, dt""",
    ),
    "geo_day": (
        "fact geo",
        """SELECT g.*, geo.province_name, area_code, iso_code, iso_3166_2 FROM (SELECT province_id, dt, COUNT(DISTINCT order_id) AS order_count,
        SUM(original_amount) AS original_amount, SUM(activity_reduce_amount) AS activity_reduce_amount,
        SUM(coupon_reduce_amount) AS coupon_reduce_amount, SUM(total_amount) AS total_amount
        FROM fact GROUP BY province_id, dt) g LEFT JOIN geo ON geo.province_id = g.province_id""",
    ),
    "usku_day": (
        "fact sku",
        """SELECT d.*, sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name,
        tm_id, tm_name FROM (SELECT user_id, sku_id, dt,
        COUNT(id) AS order_count, CAST(SUM(sku_num) AS BIGINT) AS order_num, SUM(original_amount) AS original_amount,
        SUM(activity_reduce_amount) AS activity_reduce_amount, SUM(coupon_reduce_amount) AS coupon_reduce_amount,
        SUM(total_amount) AS total_amount FROM fact GROUP BY user_id, sku_id, dt) d
        LEFT JOIN sku ON sku.sku_id = d.sku_id""",
    ),
    "views": (
        "",
        """SELECT event_id, CAST(user_id % 34 AS VARCHAR) AS province_id, 'brand' || (user_id % 3) AS brand,
        'ch' || (user_id % 5) AS channel, CASE WHEN user_id % 2 = 0 THEN '1' ELSE '0' END AS is_new,
        'model' || (user_id % 4) AS model, 'mid_' || user_id AS mid_id, 'os' || (user_id % 2) AS operate_system,
        CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, 'v' || (user_id % 6) AS version_code,
        json_extract_string(props, '$.k') AS page_item, 'sku_id' AS page_item_type,
        CAST(NULL AS VARCHAR) AS last_page_id, event_type AS page_id, CAST(NULL AS VARCHAR) AS from_pos_id,
        CAST(NULL AS VARCHAR) AS from_pos_seq, CAST(NULL AS VARCHAR) AS refer_id,
        user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, CAST(ROUND(value*1000) AS BIGINT) AS during_time,
        date_trunc('milliseconds', ts) AS view_time, CAST(ts AS DATE) AS dt
        FROM events WHERE event_type <> 'error'""",
    ),
    "logins": (
        "views",
        """SELECT user_id, session_id, CAST(view_time + INTERVAL 8 HOUR AS DATE) AS date_id,
        strftime(view_time + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS login_time, channel, province_id, version_code,
        mid_id, brand, model, operate_system FROM (SELECT *, row_number() OVER (PARTITION BY session_id
        ORDER BY view_time, event_id) AS rn FROM views WHERE user_id IS NOT NULL) WHERE rn = 1""",
    ),
    "users": (
        "",
        """SELECT c_custkey AS id, TIMESTAMP '2024-01-01 06:00:00' + to_days(CAST(c_custkey % 30 AS INT)) AS create_time
        FROM customer""",
    ),
    "login_td": (
        "users logins",
        f"""SELECT id AS user_id, COALESCE(last, CAST(create_time AS DATE)) AS login_date_last,
        CAST(create_time AS DATE) AS login_date_first, COALESCE(n, 1) AS login_count_td
        FROM users LEFT JOIN (SELECT user_id AS u, MAX(date_id) AS last, COUNT(*) AS n FROM logins
        WHERE date_id <= DATE '{lit.EVENTS_AS_OF}' GROUP BY user_id) ON CAST(id AS VARCHAR) = u""",
    ),
    "sess": (
        "views",
        """SELECT session_id, mid_id, brand, model, operate_system, version_code, channel, dt,
        CAST(SUM(during_time) AS BIGINT) AS during_time, COUNT(*) AS page_count FROM views GROUP BY ALL""",
    ),
    "regions": (
        "",
        """SELECT id, name, parent_id, 'C' || id AS dict_code FROM (
        SELECT CAST(r_regionkey AS BIGINT) + 1 AS id, r_name AS name, CAST(NULL AS BIGINT) AS parent_id FROM region
        UNION ALL SELECT CAST(n_nationkey AS BIGINT) + 1000, n_name, CAST(n_regionkey AS BIGINT) + 1 FROM nation
        UNION ALL SELECT s_suppkey + 100000, 'District of ' || s_name, CAST(s_nationkey AS BIGINT) + 1000 FROM supplier)""",
    ),
    "orgs": (
        "",
        """SELECT s_suppkey AS id, s_name AS org_name, CAST(s_suppkey % 2 + 1 AS INT) AS org_level,
        CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS BIGINT) + 1000 ELSE s_suppkey + 100000 END AS region_id,
        s_suppkey // 10 AS org_parent_id FROM supplier""",
    ),
    "ford": (
        "",
        f"""SELECT o_orderkey AS id, 'NO' || o_orderkey AS order_no, [{lit.STATE_LIST}][o_orderkey % 9 + 1] AS status,
        [{lit.STATE_LIST}][(o_orderkey // 9) % 9 + 1] AS earlier_status,
        '8000' || substr(o_orderpriority, 1, 1) AS collect_type, o_custkey AS user_id,
        o_custkey % 400 + 100000 AS sender_district_id, o_custkey % 25 + 1000 AS sender_city_id, o_custkey % 25 AS sender_complex_id,
        o_custkey % 5 + 1 AS sender_province_id, o_orderkey % 25 AS receiver_complex_id, o_orderkey % 5 + 1 AS receiver_province_id,
        o_orderkey % 25 + 1000 AS receiver_city_id, o_orderdate + INTERVAL 5 DAY AS estimate_arrive_time,
        o_orderkey % 400 + 100000 AS receiver_district_id, substr(o_orderpriority, 1, 1) || '*' AS receiver_name,
        o_orderstatus || '*' AS sender_name, 1 AS cargo_num, CAST(o_totalprice AS DECIMAL(16,2)) AS amount,
        o_orderkey % 3000 AS distance, o_orderdate + INTERVAL 90 HOUR AS update_time,
        o_orderkey % 50 = 0 AS gone FROM orders""",
    ),
    "cargo": (
        "",
        """SELECT l_orderkey*10 + l_linenumber AS id, l_orderkey AS order_id,
        CASE l_returnflag WHEN 'A' THEN '70001' WHEN 'N' THEN '70002' ELSE '70003' END AS cargo_type,
        l_partkey % 100 + 1 AS volume_length, l_suppkey % 50 + 1 AS volume_width, l_linenumber * 5 AS volume_height,
        CAST(l_quantity AS DECIMAL(16,2)) AS weight, l_shipdate AS create_time, l_linenumber = 7 AS gone FROM lineitem""",
    ),
    "fdet": (
        "cargo ford codes",
        """SELECT cargo.id, order_id, cargo_type, volume_length, volume_width, volume_height, weight, c1.dic_name AS cargo_type_name, order_no, status, collect_type,
        user_id, sender_complex_id, sender_province_id, sender_city_id,
        sender_district_id, receiver_complex_id, receiver_province_id, receiver_city_id, receiver_district_id, cargo_num, amount,
        estimate_arrive_time, distance,
        c2.dic_name AS status_name, c3.dic_name AS collect_type_name, receiver_name, sender_name,
        create_time + INTERVAL 8 HOUR AS order_time, CAST(create_time + INTERVAL 8 HOUR AS DATE) AS dt
        FROM cargo JOIN ford ON ford.id = order_id LEFT JOIN codes c1 ON c1.dic_code = cargo_type
        LEFT JOIN codes c2 ON c2.dic_code = status LEFT JOIN codes c3 ON c3.dic_code = collect_type
        WHERE NOT cargo.gone AND NOT ford.gone""",
    ),
    "delivered": (
        "cargo ford codes",
        """SELECT cargo.id, order_id, cargo_type, volume_length, volume_width, volume_height, weight, order_no, status, collect_type, user_id, sender_complex_id, sender_province_id, sender_city_id,
        sender_district_id, receiver_complex_id, receiver_province_id, receiver_city_id, receiver_district_id, cargo_num, amount,
        estimate_arrive_time, distance, receiver_name, sender_name,
        c1.dic_name AS cargo_type_name, c2.dic_name AS status_name, c3.dic_name AS collect_type_name,
        update_time + INTERVAL 8 HOUR AS deliver_suc_time, CAST(update_time + INTERVAL 8 HOUR AS DATE) AS dt
        FROM cargo JOIN ford ON ford.id = order_id LEFT JOIN codes c1 ON c1.dic_code = cargo_type
        LEFT JOIN codes c2 ON c2.dic_code = status LEFT JOIN codes c3 ON c3.dic_code = collect_type
        WHERE NOT cargo.gone AND NOT ford.gone
        AND status NOT IN ('60010','60020','60030','60040','60050','60060','60999')""",
    ),
    "milestones": (
        "cargo ford codes",
        f"""SELECT kind, l.id, order_id, cargo_type, volume_length, volume_width, volume_height, weight, order_no, collect_type, user_id, sender_complex_id, sender_province_id, sender_city_id,
        sender_district_id, receiver_complex_id, receiver_province_id, receiver_city_id, receiver_district_id, cargo_num, amount,
        estimate_arrive_time, distance, receiver_name, sender_name,
        ford.status, c1.dic_name AS cargo_type_name, c2.dic_name AS status_name, c3.dic_name AS collect_type_name,
        update_time + INTERVAL 8 HOUR AS milestone_time, CAST(update_time + INTERVAL 8 HOUR AS DATE) AS dt
        FROM (VALUES ('pay', '60020', ['60010']), ('receive', '60030', ['60010','60020']),
          ('dispatch', '60050', ['60010','60020','60030','60040']),
          ('bound_finish', '60060', ['60010','60020','60030','60040','60050']),
          ('cancel', '60999', ['60010','60020','60030','60040','60050','60060','60070'])) m(kind, reached, prior)
        JOIN ford ON ford.status = reached AND NOT ford.gone
        JOIN (SELECT id, order_id, cargo_type, volume_length, volume_width, volume_height, weight, create_time, gone FROM cargo) l ON l.order_id = ford.id
         AND (l.create_time >= TIMESTAMP '{lit.OPEN_SNAPSHOT_CUT}'
           OR (NOT l.gone AND list_contains(prior, earlier_status)))
        LEFT JOIN codes c1 ON c1.dic_code = cargo_type LEFT JOIN codes c2 ON c2.dic_code = ford.status
        LEFT JOIN codes c3 ON c3.dic_code = collect_type""",
    ),
    "scans": (
        "",
        """SELECT id, order_id, org_id, kind, scan_time, emp_id, CAST(scan_time AS DATE) AS dt FROM (
        SELECT l_orderkey*10 + l_linenumber AS id, l_orderkey AS order_id, l_suppkey AS org_id, 'inbound' AS kind,
          l_shipdate AS scan_time, l_partkey AS emp_id FROM lineitem
        UNION ALL SELECT l_orderkey*10 + l_linenumber, l_orderkey, l_suppkey, 'sort',
          l_shipdate + INTERVAL 1 DAY + to_minutes(l_linenumber), l_partkey + 1 FROM lineitem WHERE l_returnflag <> 'N'
        UNION ALL SELECT l_orderkey*10 + l_linenumber, l_orderkey, l_suppkey, 'outbound',
          l_shipdate + INTERVAL 2 DAY, l_partkey + 2 FROM lineitem WHERE l_linestatus = 'F')""",
    ),
    "shifts": (
        "codes",
        """SELECT s_suppkey AS id, s_nationkey AS line_id, 'Line ' || n_name AS line_name,
        CAST(n_regionkey AS VARCHAR) AS line_type_id, CAST(n_nationkey AS BIGINT) AS start_org_id,
        CAST((n_nationkey + 1) % 25 AS BIGINT) AS end_org_id, n_nationkey*100 + 50 AS distance,
        n_nationkey*10 + 5 AS cost, (n_nationkey*40 + 200)*1440 AS estimated_time, dic_name AS line_type_name
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN codes ON dic_code = CAST(n_regionkey AS VARCHAR)""",
    ),
    "trucks": (
        "codes",
        """SELECT p_partkey AS id, p_size AS team_id, p_brand || '/' || p_type AS model_id,
        md5('T' || p_partkey) AS truck_no, 'Team ' || p_size AS team_name, p_size % 25 AS org_id, n_name AS org_name,
        p_type || ' ' || p_brand AS model_name, p_type AS model_type, p_brand AS brand,
        'TN' || p_size AS team_no, p_size + 1000 AS manager_emp_id, p_partkey + 5000 AS device_gps_id, 'E' || p_partkey AS engine_no,
        DATE '2015-01-01' + CAST(p_size AS INT) AS license_registration_date, DATE '2024-01-01' + CAST(p_size AS INT) AS license_last_check_date,
        DATE '2026-01-01' + CAST(p_size AS INT) AS license_expire_date, CAST(p_partkey % 2 AS VARCHAR) AS is_enabled,
        'no ' || p_brand AS model_no, CAST(length(p_type) AS INT) AS truck_weight, CAST(length(p_type) * 2 AS INT) AS load_weight,
        CAST(length(p_type) * 3 AS INT) AS total_weight, '5' AS eev, CAST(length(p_brand) + 1 AS INT) AS boxcar_len,
        CAST(length(p_brand) + 2 AS INT) AS boxcar_wd, CAST(length(p_brand) + 3 AS INT) AS boxcar_hg,
        CAST(length(p_type) + 80 AS INT) AS max_speed, CAST(length(p_type) * 10 AS INT) AS oil_vol, c1.dic_name AS model_type_name, c2.dic_name AS brand_name
        FROM part JOIN nation ON n_nationkey = p_size % 25 JOIN codes c1 ON c1.dic_code = p_type
        JOIN codes c2 ON c2.dic_code = p_brand""",
    ),
    "fin": (
        "shifts",
        """SELECT l_orderkey*10 + l_linenumber AS id, l_suppkey AS shift_id, l_suppkey % 25 AS line_id,
        l_suppkey AS start_org_id, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS start_org_name,
        l_partkey % 10 AS end_org_id, 'End ' || (l_partkey % 10) AS end_org_name, l_linenumber AS order_num, l_suppkey AS driver1_emp_id, 'S*' AS driver1_name,
        CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS driver2_emp_id,
        CASE WHEN o_orderkey % 2 = 0 THEN 'C*' END AS driver2_name, l_partkey AS truck_id,
        md5('T' || l_partkey) AS truck_no, o_orderdate AS actual_start_time, l_shipdate AS actual_end_time,
        s.estimated_time AS estimated_minutes, CAST(l_quantity AS DECIMAL(16,2)) AS actual_distance,
        epoch(l_shipdate) - epoch(o_orderdate) AS finish_dur_sec, CAST(l_shipdate AS DATE) AS dt
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN shifts s ON s.id = l_suppkey
        WHERE l_shipdate >= o_orderdate AND l_linenumber <> 7""",
    ),
    "hubs_by_district": (
        "orgs regions",
        """SELECT orgs.region_id AS district, orgs.id AS org_id, org_name, b.id AS city_id, b.name AS city_name,
        c.id AS province_id, c.name AS province_name FROM orgs LEFT JOIN regions a ON a.id = orgs.region_id
        LEFT JOIN regions b ON b.id = a.parent_id LEFT JOIN regions c ON c.id = b.parent_id""",
    ),
    "hubs_by_level": (
        "orgs regions",
        """SELECT orgs.id AS org_id, org_name, org_level, CASE WHEN org_level = 1 THEN a.id ELSE b.id END AS city_id,
        CASE WHEN org_level = 1 THEN a.name ELSE b.name END AS city_name,
        CASE WHEN org_level = 1 THEN b.id ELSE c.id END AS province_id,
        CASE WHEN org_level = 1 THEN b.name ELSE c.name END AS province_name
        FROM orgs LEFT JOIN regions a ON a.id = orgs.region_id
        LEFT JOIN regions b ON b.id = a.parent_id LEFT JOIN regions c ON c.id = b.parent_id""",
    ),
    "org_cargo_day": (
        "fdet orgs regions",
        """SELECT orgs.id AS org_id, org_name, sender_city_id AS city_id, r.name AS city_name, cargo_type,
        cargo_type_name, dt, COUNT(order_id) AS order_count, SUM(amount) AS order_amount
        FROM (SELECT order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id, dt, MAX(amount) AS amount
              FROM fdet GROUP BY ALL) d LEFT JOIN orgs ON orgs.region_id = d.sender_district_id
        LEFT JOIN regions r ON r.id = d.sender_city_id GROUP BY ALL""",
    ),
    "receive_day": (
        "milestones hubs_by_district",
        """SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, COUNT(order_id) AS order_count,
        SUM(amount) AS order_amount FROM (SELECT order_id, sender_district_id, dt, MAX(amount) AS amount FROM milestones
        WHERE kind = 'receive' GROUP BY ALL) LEFT JOIN hubs_by_district ON district = sender_district_id GROUP BY ALL""",
    ),
    "deliver_day": (
        "delivered hubs_by_district",
        """SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, COUNT(order_id) AS order_count
        FROM (SELECT DISTINCT order_id, receiver_district_id, dt FROM delivered)
        LEFT JOIN hubs_by_district ON district = receiver_district_id GROUP BY ALL""",
    ),
    "sort_day": (
        "scans hubs_by_level",
        """SELECT s.org_id, org_name, city_id, city_name, province_id, province_name, sort_count, dt
        FROM (SELECT org_id, dt, COUNT(*) AS sort_count FROM scans WHERE kind = 'sort' GROUP BY org_id, dt) s
        LEFT JOIN hubs_by_level h ON h.org_id = s.org_id""",
    ),
    "dispatch_day": (
        "milestones",
        """SELECT dt, COUNT(order_id) AS order_count, SUM(amount) AS order_amount FROM (SELECT order_id, dt,
        MAX(amount) AS amount FROM milestones WHERE kind = 'dispatch' GROUP BY order_id, dt) GROUP BY dt""",
    ),
    "truck_day": (
        "fin trucks",
        """SELECT start_org_id AS org_id, start_org_name AS org_name, model_type AS truck_model_type,
        model_type_name AS truck_model_type_name, dt, COUNT(fin.id) AS trans_finish_count,
        SUM(actual_distance) AS trans_finish_distance, CAST(SUM(finish_dur_sec) AS BIGINT) AS trans_finish_dur_sec
        FROM fin LEFT JOIN trucks ON trucks.id = truck_id GROUP BY ALL""",
    ),
    "shift_nd": (
        "fin hubs_by_level shifts trucks",
        f"""SELECT a.recent_days, shift_id, a.line_id, a.start_org_id AS org_id, start_org_name AS org_name,
        driver1_emp_id, driver1_name, driver2_emp_id, driver2_name, truck_id, trans_finish_count, trans_finish_distance,
        trans_finish_dur_sec, trans_finish_order_count, trans_finish_delay_count, city_id, city_name, s.line_name,
        t.model_type AS truck_model_type, t.model_type_name AS truck_model_type_name
        FROM (SELECT recent_days, shift_id, line_id, start_org_id, start_org_name, driver1_emp_id, driver1_name,
          driver2_emp_id, driver2_name, truck_id, COUNT(id) AS trans_finish_count,
          SUM(actual_distance) AS trans_finish_distance, SUM(finish_dur_sec) AS trans_finish_dur_sec,
          CAST(SUM(order_num) AS BIGINT) AS trans_finish_order_count,
          CAST(SUM(CASE WHEN actual_end_time > actual_start_time + to_minutes(estimated_minutes) THEN 1 ELSE 0 END) AS BIGINT)
            AS trans_finish_delay_count
          FROM fin, (VALUES (7), (30)) w(recent_days)
          WHERE dt > DATE '{lit.ORDERS_AS_OF}' - recent_days AND dt <= DATE '{lit.ORDERS_AS_OF}' GROUP BY ALL) a
        LEFT JOIN hubs_by_level h ON h.org_id = a.start_org_id LEFT JOIN shifts s ON s.id = a.shift_id
        LEFT JOIN trucks t ON t.id = a.truck_id""",
    ),
    "acts": (
        "",
        """SELECT p_partkey AS activity_id, p_name AS activity_name, p_size % 3 + 1 AS offer_type,
        TIMESTAMP '1995-01-01' + to_days(p_size) AS start_time,
        TIMESTAMP '1995-01-01' + to_days(p_size) + to_days(CAST(p_partkey % 2500 AS INT)) + to_hours(p_size)
          + to_minutes(p_size) AS end_time, p_size % 2 AS status, p_size % 5 AS shop_id FROM part""",
    ),
    "sends": (
        "",
        """SELECT *, CASE WHEN record_id % 5 <> 0 THEN send_time + to_hours(CAST(record_id % 2000 AS INT)) END AS expire_time
        FROM (SELECT o_orderkey AS record_id, o_custkey AS activity_id, o_orderkey % 97 AS product_id,
        o_custkey AS customer_id, o_custkey % 40 AS cs_id, CAST(o_totalprice AS DECIMAL(16,2)) AS offer_amount,
        o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) + to_minutes(CAST(o_orderkey % 60 AS INT)) AS send_time,
        CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS status FROM orders)""",
    ),
    "sendfact": (
        "sends acts",
        f"""SELECT s.*, activity_name, offer_type, CAST(send_time AS DATE) AS dt, strftime(send_time, '%H') AS hour_str,
        CASE WHEN s.status = 2 THEN 1 ELSE 0 END AS is_used,
        CASE WHEN s.status = 3 OR COALESCE(expire_time < TIMESTAMP '{lit.OFFERS_NOW}', FALSE) THEN 1 ELSE 0 END AS is_expired,
        CASE WHEN expire_time IS NULL THEN NULL WHEN expire_time < TIMESTAMP '{lit.OFFERS_NOW}' THEN 0
          ELSE {rounded(f"epoch(expire_time) - epoch(TIMESTAMP '{lit.OFFERS_NOW}')", "3600", 2)} END AS remaining_time
        FROM sends s LEFT JOIN acts ON acts.activity_id = s.activity_id""",
    ),
    "reds": (
        "",
        """SELECT l_orderkey*10 + l_linenumber AS redemption_id, l_orderkey AS record_id, l_orderkey AS order_id,
        ship + to_hours(l_linenumber) AS redemption_time, CAST(offer AS DECIMAL(16,2)) AS actual_offer_amount,
        CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(price - offer AS DECIMAL(16,2)) END AS payment_amount
        FROM (SELECT l_orderkey, l_linenumber, MAX(l_shipdate) AS ship, SUM(CAST(l_extendedprice AS DECIMAL(16,2))) AS price,
        SUM(CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2))) AS offer
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber)""",
    ),
    "red1": (
        "reds",
        """SELECT record_id, COUNT(*) AS n, SUM(payment_amount) AS sales, SUM(CAST(epoch(redemption_time) AS BIGINT)) AS secs,
        SUM(CASE WHEN payment_amount > 0 THEN CAST(actual_offer_amount AS DOUBLE) / CAST(payment_amount AS DOUBLE) END) AS rates,
        COUNT(CASE WHEN payment_amount > 0 THEN 1 END) AS rated FROM reds GROUP BY record_id""",
    ),
    "sendred": (
        "sendfact red1",
        """SELECT s.*, n, sales, rates, rated, secs - n * CAST(epoch(send_time) AS BIGINT) AS wait FROM sendfact s
        LEFT JOIN red1 ON red1.record_id = s.record_id""",
    ),
    "agents": (
        "",
        "SELECT s_suppkey AS cs_id, s_name AS cs_name, 'D' || (s_nationkey % 5) AS department FROM supplier",
    ),
    "offprod": ("", "SELECT p_partkey % 200 AS product_id FROM part WHERE p_partkey % 2 = 0"),
    "wide": (
        "sendred agents",
        f"""SELECT w.*, rank() OVER (PARTITION BY dept_name, stat_date ORDER BY redemption_count DESC) AS rank_in_dept FROM (
        SELECT p.*, cs_name, department AS dept_name, isoyear(stat_date) || '-' || lpad(CAST(week(stat_date) AS VARCHAR), 2, '0')
          AS stat_week, strftime(stat_date, '%Y-%m') AS stat_month FROM (SELECT cs_id, dt AS stat_date,
        COUNT(record_id) AS send_count, CAST(SUM(is_used) AS BIGINT) AS redemption_count,
        {rounded("SUM(is_used)", "COUNT(record_id)", 4)} AS redemption_rate, COALESCE(SUM(sales), 0) AS total_sales,
        {rounded(cents("SUM(offer_amount)"), "100 * COUNT(record_id)", 2)} AS avg_offer_amount,
        {rounded("SUM(wait)", "SUM(n) * 3600", 2)} AS avg_redemption_time FROM sendred GROUP BY cs_id, dt) p
        JOIN agents ON agents.cs_id = p.cs_id) w""",
    ),
    "entries": (
        "",
        f"""SELECT user_id || '-' || event_type AS entry_id, COUNT(*) AS visitor_count,
        COUNT(CASE WHEN dayofmonth(ts) <= 15 THEN 1 END) AS new_visitor_count,
        COUNT(CASE WHEN value > 20 THEN 1 END) AS order_buyer_count,
        {rounded("COUNT(CASE WHEN value > 20 THEN 1 END)", "COUNT(*)", 4)} AS order_conversion_rate,
        {rounded(cents("SUM(CAST(value AS DECIMAL(16,2)))"), "100 * COUNT(*)", 4)} AS avg_stay_duration,
        'P' || (user_id % 4) AS time_period, event_type AS entry_page_name FROM events GROUP BY user_id, event_type""",
    ),
}


def with_ctes(sql: str, names: list[str]) -> str:
    """Put the named roles and all they need before a query."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name not in ordered:
            for other in CTES[name][0].split():
                need(other)
            ordered.append(name)

    for name in names:
        need(name)
    if not ordered:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + " " + sql

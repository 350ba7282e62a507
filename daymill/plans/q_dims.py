"""Queries over dimensions, history, column and key operators."""

from __future__ import annotations

import secrets

from pyspark.sql import functions as F

from daymill.functions import days, keys, text

from daymill.operators import dimensions as dims
from daymill.operators import history
from daymill.operators import trees
from daymill.plans import literals as lit
from daymill.plans import roles
from daymill.plans.registry import Tables, query


@query("sku_dim",
       """SELECT p_partkey AS sku_id, p_retailprice AS price, p_size % 2 = 1 AS is_sale, p_partkey // 4 AS spu_id,
       'spu ' || (p_partkey // 4) AS spu_name, (p_partkey // 4) % 25 AS category3_id, n_name AS category3_name,
       n_regionkey AS category2_id, r_name AS category2_name, n_regionkey % 2 AS category1_id,
       'root ' || (n_regionkey % 2) AS category1_name, p_brand AS tm_id, lower(p_brand) AS tm_name, attrs, sale_attrs
       FROM part JOIN nation ON n_nationkey = (p_partkey // 4) % 25 JOIN region ON r_regionkey = n_regionkey
       LEFT JOIN (SELECT l_partkey, string_agg(l_returnflag || '=' || l_linestatus || ' attr ' || l_returnflag || '=value ' || l_linestatus, ',' ORDER BY l_returnflag, l_linestatus) AS attrs
         FROM (SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem) GROUP BY 1) a ON a.l_partkey = p_partkey
       LEFT JOIN (SELECT l_partkey, string_agg(l_linenumber || '=' || l_returnflag || ' sale ' || l_linenumber || '=kind ' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS sale_attrs
         FROM (SELECT DISTINCT l_partkey, l_linenumber, l_returnflag FROM lineitem) GROUP BY 1) s ON s.l_partkey = p_partkey""")
def sku_dim(t: Tables):
    key = F.col("p_partkey")
    sku = t.part.select(
        key.alias("id"), F.col("p_retailprice").alias("price"), (F.col("p_size") % 2).alias("is_sale"),
        F.floor(key / 4).alias("spu_id"), F.col("p_brand").alias("tm_id"),
    )
    spu = sku.select(F.col("spu_id").alias("id")).distinct().select(
        "id", F.concat(F.lit("spu "), F.col("id").cast("string")).alias("spu_name"), (F.col("id") % 25).alias("category3_id")
    )
    cat3 = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("category2_id"))
    cat2 = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), (F.col("r_regionkey") % 2).alias("category1_id"))
    cat1 = cat2.select(F.col("category1_id").alias("id")).distinct().withColumn("name", F.concat(F.lit("root "), F.col("id").cast("string")))
    brands = t.part.select(F.col("p_brand").alias("id")).distinct().withColumn("tm_name", F.lower("id"))
    attrs = t.lineitem.select(
        F.col("l_partkey").alias("sku_id"), F.col("l_returnflag").alias("attr_id"), F.col("l_linestatus").alias("value_id"),
        F.concat(F.lit("attr "), "l_returnflag").alias("attr_name"), F.concat(F.lit("value "), "l_linestatus").alias("value_name"),
    )
    sales = t.lineitem.select(
        F.col("l_partkey").alias("sku_id"), F.col("l_linenumber").alias("sale_attr_id"), F.col("l_returnflag").alias("sale_attr_value_id"),
        F.concat(F.lit("sale "), F.col("l_linenumber").cast("string")).alias("sale_attr_name"),
        F.concat(F.lit("kind "), "l_returnflag").alias("sale_attr_value_name"),
    )
    out = dims.sku_dim(sku, spu, cat3, cat2, cat1, brands, attrs, sales)

    def shown(name: str, *parts: str):
        """Ids, then names, of each attribute and its value."""
        pair = lambda a, left, right: F.concat(a[left].cast("string"), F.lit("="), a[right])
        return F.transform(name, lambda a: F.concat(pair(a, *parts[:2]), F.lit(" "), pair(a, *parts[2:]))).alias(name)

    plain = [c for c in out.columns if c not in ("attrs", "sale_attrs")]
    return out.select(*plain, shown("attrs", "attr_id", "value_id", "attr_name", "value_name"),
        shown("sale_attrs", "sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"))


@query("code_lookup",
       """SELECT id, order_no, status, collect_type, c1.dic_name AS status_name, c2.dic_name AS collect_type_name FROM ford
       LEFT JOIN codes c1 ON c1.dic_code = status LEFT JOIN codes c2 ON c2.dic_code = collect_type AND c2.parent_code = '800'""",
       "ford codes")
def code_lookup(t: Tables):
    rows = roles.freight_orders(t).select("id", "order_no", "status", "collect_type")
    return dims.code_lookup(
        rows, roles.codes(t), {"status": "status_name", "collect_type": "collect_type_name"}, {"collect_type": "800"}
    )


@query("benefit_rule",
       """SELECT 'coupon' AS kind, id, rule_type, rule_type_name, benefit_rule FROM coupons UNION ALL
       SELECT 'activity', id, replace(rule_type, '32', '31'), dic_name, CASE rule_type
       WHEN '3201' THEN '满' || condition_amount || '元减' || benefit_amount || '元'
       WHEN '3202' THEN '满' || condition_num || '件打' || benefit_discount || ' 折'
       WHEN '3203' THEN '打' || benefit_discount || '折' END FROM coupons
       LEFT JOIN (SELECT * FROM codes WHERE parent_code = '31') ON dic_code = replace(rule_type, '32', '31')""",
       "coupons codes")
def benefit_rule(t: Tables):
    columns = ["id", "rule_type", "rule_type_name", "benefit_rule"]
    coupons = dims.benefit_dim(roles.coupon_rules(t), roles.codes(t), "coupon")
    rules = roles.coupon_rules(t).withColumn("rule_type", F.replace("rule_type", F.lit("32"), F.lit("31")))
    activities = dims.benefit_dim(rules, roles.codes(t), "activity")
    return coupons.select(F.lit("coupon").alias("kind"), *columns).unionByName(
        activities.select(F.lit("activity").alias("kind"), *columns)
    )


@query("geo_dim", "SELECT * FROM geo", "geo")
def geo_dim(t: Tables):
    return roles.geo(t)


@query("snapshot_projection",
       "SELECT s_suppkey AS id, s_name AS pos_location, DATE '2001-07-31' AS ds FROM supplier WHERE s_suppkey % 10 <> 0", days="ds")
def snapshot_projection(t: Tables):
    rows = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("pos_location"),
        F.when(F.col("s_suppkey") % 10 == 0, "1").otherwise("0").alias("is_deleted"),
    )
    return dims.snapshot_projection(rows, lit.ORDERS_AS_OF, ["id", "pos_location"], "is_deleted")


_USER_SQL = r"""SELECT c_custkey AS id, c_name AS login_name, md5(c_name) AS passwd, md5(c_mktsegment) AS real_name,
    md5(CASE WHEN regexp_matches(phone, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$') THEN phone END) AS phone_num,
    md5(CASE WHEN regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$') THEN email END) AS email,
    CAST(c_nationkey % 3 AS INTEGER) AS user_level, DATE '1970-01-01' + CAST(c_custkey % 20000 AS INT) AS birthday,
    CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
    DATE '2020-01-01' + CAST(c_custkey % 700 AS INT) AS start_date, DATE '9999-12-31' AS end_date
    FROM (SELECT *, '1' || (30 + c_custkey % 70) || lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0') AS phone,
      CASE WHEN c_custkey % 3 = 0 THEN c_name || '@mail' ELSE 'u' || c_custkey || '@mail.example' END AS email FROM customer)"""


def _user_table(t: Tables):
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_name").alias("passwd"),
        F.col("c_mktsegment").alias("real_name"),
        F.concat(F.lit("1"), (key % 70 + 30).cast("string"), F.lpad((key % 100000000).cast("string"), 8, "0")).alias("phone_num"),
        F.when(key % 3 == 0, F.concat("c_name", F.lit("@mail")))
        .otherwise(F.concat(F.lit("u"), key.cast("string"), F.lit("@mail.example"))).alias("email"),
        (F.col("c_nationkey") % 3).alias("user_level"),
        (key % 20000).alias("birthday"),
        F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").alias("gender"),
        (F.lit(1577836800) + (key % 700) * 86400).cast("string").alias("create_time"),
    )


@query("user_zip_init", _USER_SQL, days="birthday start_date end_date")
def user_zip_init(t: Tables):
    return history.user_zip_init(_user_table(t))


@query("address_zip_init",
       r"""SELECT s_suppkey AS id, md5(CASE WHEN regexp_matches(phone, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$')
       THEN phone END) AS phone, s_name AS address, DATE '2020-01-01' + CAST(s_suppkey % 700 AS INT) AS start_date,
       DATE '9999-12-31' AS end_date FROM (SELECT *, '1' || (30 + s_suppkey % 70) || '12345678' AS phone FROM supplier)""",
       days="start_date end_date")
def address_zip_init(t: Tables):
    made = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s_suppkey") % 700).cast("int"))
    rows = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("1"), (F.col("s_suppkey") % 70 + 30).cast("string"), F.lit("12345678")).alias("phone"),
        F.col("s_name").alias("address"),
        F.concat(made.cast("string"), F.lit("T08:30:00Z")).alias("create_time"),
    )
    return history.address_zip_init(rows)


@query("user_zip_merge",
       """SELECT * FROM (
       SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, DATE '2020-01-01' AS start_date,
         CASE WHEN c_custkey % 10 = 0 AND c_custkey % 4 <> 1 THEN DATE '2024-01-30' ELSE DATE '9999-12-31' END AS end_date
       FROM customer WHERE c_custkey % 4 <> 1
       UNION ALL SELECT c_custkey, c_acctbal + 100, c_mktsegment, DATE '2024-01-31', DATE '9999-12-31' FROM customer
       WHERE c_custkey % 10 = 0 AND c_custkey % 4 <> 1
       UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, DATE '2024-01-31', DATE '9999-12-31' FROM customer
       WHERE c_custkey % 4 = 1)""", days="start_date end_date")
def user_zip_merge(t: Tables):
    """A tenth of the known users change, a quarter of all users is new; the merge runs twice."""
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    new = F.col("id") % 4 == 1
    stored = base.where(~new).withColumns(
        {"start_date": F.lit("2020-01-01").cast("date"), "end_date": F.lit("9999-12-31").cast("date")}
    )
    shifted = F.when((F.col("id") % 10 == 0) & ~new, F.col("balance") + 100).otherwise(F.col("balance"))
    stale = base.withColumn("balance", F.col("balance") - 1).withColumn("seq", F.lit(1))
    changes = stale.unionByName(base.withColumn("balance", shifted).withColumn("seq", F.lit(2)))
    once = history.user_zip_merge(stored, changes, "id", ["balance", "segment"], "2024-01-31", "seq")
    return history.user_zip_merge(once, changes, "id", ["balance", "segment"], "2024-01-31", "seq")


@query("user_zip_chain",
       """WITH c AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer), v AS (
       SELECT id, balance, segment, DATE '2020-01-01' AS start_date, FALSE AS lost FROM c WHERE id % 4 <> 1
       UNION ALL SELECT id, balance + 1, segment, DATE '2023-01-01', FALSE FROM c WHERE id % 4 <> 1
       UNION ALL SELECT id, balance + 5, segment, DATE '2021-06-01', FALSE FROM c WHERE id % 6 = 0
       UNION ALL SELECT id, balance + 10 * n, segment, DATE '2024-01-01' + CAST(10 * n AS INT), FALSE FROM c, range(1, 4) r(n) WHERE id % 10 = 0
       UNION ALL SELECT id, balance, segment, DATE '2024-01-31', FALSE FROM c WHERE id % 4 = 1)
       SELECT id, balance, segment, start_date, CAST(coalesce(lead(start_date) OVER (PARTITION BY id ORDER BY start_date) - 1, DATE '9999-12-31') AS DATE) AS end_date
       FROM v""", days="start_date end_date")
def user_zip_chain(t: Tables):
    """Three changes a customer in one batch, late ones inside a closed row, new customers; the merge runs twice."""
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    new = F.col("id") % 4 == 1

    def dated(rows, day, plus, seq):
        return rows.withColumns({"balance": (F.col("balance") + plus).cast(base.schema["balance"].dataType), "day": F.lit(day).cast("date"), "seq": F.lit(seq)})

    def version(start, end, plus):
        return dated(base.where(~new), start, plus, 0).select("id", "balance", "segment", F.col("day").alias("start_date"), F.lit(end).cast("date").alias("end_date"))

    stored = version("2020-01-01", "2022-12-31", 0).unionByName(version("2023-01-01", "9999-12-31", 1))
    changes = dated(base.where("id % 6 = 0"), "2021-06-01", 5, 9).unionByName(dated(base.where(new), "2024-01-31", 0, 1).where("id % 10 <> 0"))
    for n in (1, 2, 3):
        changes = changes.unionByName(dated(base.where("id % 10 = 0"), f"2024-01-{1 + 10 * n}", 10 * n, n))
    stale = dated(base.where("id % 10 = 0"), "2024-01-31", 99, 0)
    changes = changes.unionByName(stale)
    once = history.user_zip_chain(stored, changes, "id", ["balance", "segment"], "day", "seq")
    return history.user_zip_chain(once, changes, "id", ["balance", "segment"], "day", "seq")


@query("complex_dim",
       """SELECT n_nationkey AS id, n_name AS complex_name, p.name AS province_name, c.name AS city_name,
       n_regionkey + 1 AS province_id, n_nationkey + 1000 AS city_id
       FROM nation JOIN regions p ON p.id = n_regionkey + 1 JOIN regions c ON c.id = n_nationkey + 1000""", "regions")
def complex_dim(t: Tables):
    n = F.col("n_nationkey")
    areas = t.nation.select(
        n.alias("id"), F.col("n_name").alias("complex_name"), (F.col("n_regionkey") + 1).alias("province_id"),
        (n + 1000).alias("city_id"),
    )
    return dims.complex_dim(areas, roles.regions(t))


@query("region_closure",
       """SELECT * FROM (WITH RECURSIVE up AS (SELECT id, id AS ancestor, 0 AS distance FROM regions UNION ALL
       SELECT up.id, r.parent_id, up.distance + 1 FROM up JOIN regions r ON r.id = up.ancestor JOIN regions p ON p.id = r.parent_id)
       SELECT up.id, ancestor, CAST(distance AS BIGINT) AS distance, name AS ancestor_name FROM up JOIN regions a ON a.id = ancestor)""", "regions")
def region_closure(t: Tables):
    """Every region with all its ancestors, by name."""
    nodes = roles.regions(t)
    return dims.with_names(trees.closure(nodes), nodes, "ancestor", "id", {"name": "ancestor_name"}, "inner")


@query("complex_couriers", "SELECT DISTINCT s_nationkey AS complex_id, CAST(s_suppkey AS VARCHAR) AS courier_emp_id FROM supplier")
def complex_couriers(t: Tables):
    couriers = t.supplier.select(F.col("s_nationkey").alias("complex_id"), F.col("s_suppkey").alias("courier_emp_id"))
    return dims.complex_couriers(couriers.unionAll(couriers))


@query("org_dim",
       """SELECT o.id, o.org_name, o.org_level, o.region_id, o.org_parent_id, r.name AS region_name, r.dict_code AS region_code,
       p.org_name AS org_parent_name FROM orgs o LEFT JOIN regions r ON r.id = o.region_id
       LEFT JOIN orgs p ON p.id = o.org_parent_id""", "orgs regions")
def org_dim(t: Tables):
    return dims.org_dim(roles.orgs(t), roles.regions(t))


@query("courier_dim",
       """SELECT s_suppkey AS id, s_nationkey AS org_id, CAST(s_suppkey % 7 AS VARCHAR) AS express_type,
       md5('139' || s_suppkey) AS working_phone, n_name AS org_name, dic_name AS express_type_name
       FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN codes ON dic_code = CAST(s_suppkey % 7 AS VARCHAR)""", "codes")
def courier_dim(t: Tables):
    rows = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("org_id"),
        (F.col("s_suppkey") % 7).cast("string").alias("express_type"),
        F.concat(F.lit("139"), F.col("s_suppkey").cast("string")).alias("working_phone"),
    )
    bases = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("org_name"))
    return dims.courier_dim(rows, bases, roles.codes(t))


@query("shift_dim", "SELECT * FROM shifts", "shifts", money="distance cost")
def shift_dim(t: Tables):
    return roles.shifts(t)


@query("driver_dim",
       """SELECT c_custkey AS id, c_nationkey AS org_id, CAST(c_custkey % 7 AS INTEGER) AS truck_team_id, n_name AS org_name,
       r_name AS truck_team_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = c_custkey % 7""")
def driver_dim(t: Tables):
    rows = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("org_id"), (F.col("c_custkey") % 7).cast("int").alias("truck_team_id")
    )
    bases = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("org_name"))
    teams = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return dims.driver_dim(rows, bases, teams)


@query("truck_dim", "SELECT * FROM trucks", "trucks", "license_registration_date license_last_check_date license_expire_date")
def truck_dim(t: Tables):
    return roles.trucks(t)


# ---- columns and keys ---------------------------------------------------------


@query("hash_bucket",
       """SELECT c_custkey, lpad(CAST(CAST(('0x' || right(md5(c_name), 3)) AS INT) % 128 AS VARCHAR), 4, '0') AS bucket,
       CASE WHEN c_custkey % 100 = 0 THEN '9002' ELSE lpad(CAST(CAST(('0x' || right(md5(c_name), 3)) AS INT) % 128 AS VARCHAR), 4, '0') END
         AS hot_bucket FROM customer""")
def hash_bucket(t: Tables):
    account = F.when(F.col("c_custkey") % 100 == 0, "0xDAC17F958d2ee523a2206206994597c13d831ec7").otherwise(F.col("c_name"))
    return t.customer.select(
        "c_custkey",
        keys.hash_bucket("c_name").alias("bucket"),
        keys.hash_bucket(account, 128, keys.BUSY_ACCOUNT_BUCKETS).alias("hot_bucket"),
    )


@query("row_key",
       """SELECT o_orderkey, o_custkey || '_' || md5(o_orderstatus) || '_' || o_orderkey AS plain_key,
       md5(o_custkey || '_' || md5(o_orderstatus) || '_' || o_orderkey) AS hashed_key FROM orders""")
def row_key(t: Tables):
    fields, flags = ["o_custkey", "o_orderstatus", "o_orderkey"], [False, True, False]
    return t.orders.select(
        "o_orderkey", keys.row_key(fields, flags, "_").alias("plain_key"), keys.row_key(fields, flags, "_", True).alias("hashed_key")
    )


@query("hex_amount",
       """SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS amount, CAST(o_custkey AS DOUBLE) AS units,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_custkey END AS DOUBLE) AS decimal_amount, o_orderkey % 11 = 0 AS overflow,
       CASE WHEN o_orderkey % 11 = 0 THEN '115792089237316195423570985008687907853269984665640564039457584007913129639935'
         ELSE CAST(o_orderkey AS VARCHAR) END AS digits FROM orders""")
def hex_amount(t: Tables):
    hexed = F.concat(F.lit("0x"), F.hex("o_orderkey"))
    wei = F.concat(F.lit("0x"), F.conv((F.col("o_custkey").cast("decimal(20,0)") * F.lit(10**12).cast("decimal(13,0)")).cast("string"), 10, 16))
    text_amount = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("string"))
    wide = F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("0x"), F.repeat(F.lit("f"), 64))).otherwise(hexed)
    return t.orders.select(
        "o_orderkey",
        keys.hex_amount(hexed).alias("amount"),
        (keys.hex_amount(wei, in_units=True) * 1000000).alias("units"),
        keys.hex_amount(text_amount).alias("decimal_amount"),
        keys.hex_overflow(wide).alias("overflow"),
        keys.hex_text(wide).alias("digits"),
    )


@query("split_words",
       """SELECT c_custkey, len(w) AS n, array_to_string(w, ',') AS words FROM (SELECT c_custkey,
       ['0x' || sha256(c_name), '0x' || sha256(c_mktsegment)] AS w FROM customer)""")
def split_words(t: Tables):
    payload = F.concat(F.lit("0x"), F.sha2("c_name", 256), F.sha2("c_mktsegment", 256))
    return t.customer.select("c_custkey", keys.split_words(payload).alias("words")).withColumn("n", F.size("words").cast("bigint"))


@query("day_range",
       """SELECT CAST(strftime(d.day, '%Y%m%d') AS INTEGER) AS day, COALESCE(n, 0) AS order_count
       FROM (SELECT unnest(generate_series(MIN(dt), MAX(dt), INTERVAL 1 DAY)) AS day FROM hdr) d
       LEFT JOIN (SELECT dt, COUNT(*) AS n FROM hdr GROUP BY dt) c ON c.dt = CAST(d.day AS DATE)""", "hdr")
def day_range(t: Tables):
    """Every day between the first and the last order, with its orders, 0 on days without."""
    headers = roles.order_headers(t)
    span = headers.agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    calendar = days.day_range(span, "first", "last").select("day")
    counted = headers.groupBy(F.date_format("dt", "yyyyMMdd").cast("int").alias("day")).agg(F.count(F.lit(1)).alias("order_count"))
    return calendar.join(counted, "day", "left").na.fill(0, ["order_count"])


@query("append_hash_list",
       "SELECT DISTINCT o_custkey, o_orderkey AS seq, md5(CAST(o_orderkey AS VARCHAR)) AS item FROM orders")
def append_hash_list(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("hash"))
    return keys.append_hash_list(rows, "o_custkey", "hash", "o_orderkey")


@query("encrypt_columns",
       """SELECT c_custkey, c_name, c_mktsegment, CAST(length(c_name) + 28 AS INTEGER) AS name_bytes FROM customer""")
def encrypt_columns(t: Tables):
    """Round trip; the stored form is 28 bytes longer than the text."""
    secret = F.lit(secrets.token_bytes(32))  # a new key per run; the round trip does not depend on it
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    stored = keys.encrypt_columns(rows, ["c_name", "c_mktsegment"], secret).withColumn(
        "name_bytes", F.length(F.unbase64("c_name"))
    )
    return keys.decrypt_columns(stored, ["c_name", "c_mktsegment"], secret)


@query("text_quality",
       r"""SELECT doc_id, length(regexp_replace(text, '[\x00-\x20]+', '', 'g')) = 0 AS blank,
       regexp_matches(text, '^[一-龥a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]+$') AS allowed,
       md5(upper(substr(text, 1, 1)) || substr(text, 2)) AS capitalised, md5(lower(substr(text, 1, 1)) || substr(text, 2)) AS lowered,
       lang || ', ' || source AS joined FROM documents""")
def text_quality(t: Tables):
    return t.documents.select(
        "doc_id",
        text.is_blank("text").alias("blank"),
        text.is_allowed("text").alias("allowed"),
        F.md5(text.capitalise_first("text")).alias("capitalised"),
        F.md5(text.lowercase_first("text")).alias("lowered"),
        text.list_to_text(F.array("lang", "source")).alias("joined"),
    )


@query("sensitive_word_flag",
       rf"""SELECT doc_id, COUNT(word) AS hits, COALESCE(string_agg(word, ',' ORDER BY word), '') AS found, COUNT(word) > 0 AS flagged
       FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) AS token FROM documents)
       LEFT JOIN (VALUES {lit.DENY_ROWS}) v(word) ON word = token GROUP BY doc_id""")
def sensitive_word_flag(t: Tables):
    words = t.spark.sql(f"SELECT * FROM VALUES {lit.DENY_ROWS} AS t(word)")
    return text.sensitive_word_flag(t.documents, words, "doc_id", "text")



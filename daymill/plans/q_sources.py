"""Queries over readers and writers.

Writers run against a fresh path below the shared folder and the query reads
back what was written.  Relational databases are not opened here: the parts
that need one are tested as options and SQL text, the queries run the Spark
part over the test tables.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.functions.values import money
from daymill.operators import freight_reports as fr
from daymill.plans import literals as lit
from daymill.plans import roles
from daymill.plans.registry import Tables, query
from daymill.session import scratch_table
from daymill.sources import files, jdbc, partitions, schemas

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("province_id", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("amount", T.DecimalType(16, 2)),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("dt", T.DateType()),
    ]
)


def _months(t: Tables):
    """Order headers under the first day of their month, to keep test folders few."""
    return roles.order_headers(t).withColumn("dt", F.trunc("dt", "month").cast("date"))


def _stored_months(t: Tables) -> str:
    path = scratch_table(t.spark, "orders")
    partitions.overwrite_partitions(_months(t), path)
    return path


@query("read_partition", "SELECT order_id, user_id, state, amount, create_time FROM hdr WHERE dt BETWEEN DATE '2000-05-01' AND DATE '2000-05-31'",
       "hdr", money="amount", times="create_time")
def read_partition(t: Tables):
    rows = partitions.read_partition(t.spark, _stored_months(t), "2000-05-01", ORDER_SCHEMA)
    return rows.select("order_id", "user_id", "state", "amount", "create_time")


@query("partition_by_event_date", "SELECT dt, COUNT(*) AS n, SUM(amount) AS amount FROM hdr GROUP BY dt", "hdr", "dt", "amount")
def partition_by_event_date(t: Tables):
    rows = roles.order_headers(t).drop("dt")
    time_col = partitions.time_column("orders", rows.schema)
    return partitions.partition_by_event_date(rows, time_col).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )


@query("overwrite_partitions",
       """SELECT CAST(date_trunc('month', dt) AS DATE) AS dt, COUNT(*) AS n,
       SUM(CASE WHEN dt >= DATE '2000-01-01' THEN amount * 2 ELSE amount END) AS amount FROM hdr GROUP BY 1""",
       "hdr", "dt", "amount")
def overwrite_partitions(t: Tables):
    path = _stored_months(t)
    changed = _months(t).where(F.col("dt") >= "2000-01-01").withColumn("amount", money(F.col("amount") * 2))
    for _ in range(2):  # the second write must change nothing
        partitions.overwrite_partitions(changed, path)
    stored = t.spark.read.schema(ORDER_SCHEMA).parquet(path)
    return stored.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("verify_load",
       "SELECT CAST(date_trunc('month', dt) AS DATE) AS dt, COUNT(*) AS source_rows, COUNT(*) AS loaded_rows, TRUE AS matches FROM hdr GROUP BY 1",
       "hdr", "dt")
def verify_load(t: Tables):
    stored = t.spark.read.schema(ORDER_SCHEMA).parquet(_stored_months(t))
    return partitions.verify_load(_months(t), stored)


@query("verify_contents",
       """SELECT order_id, user_id, state, amount, CAST(date_trunc('month', dt) AS DATE) AS dt, side, CAST(1 AS BIGINT) AS times FROM (
       SELECT order_id, user_id, state, amount, dt, 'source' AS side FROM hdr WHERE order_id % 500 IN (1, 2)
       UNION ALL SELECT order_id, user_id, state, amount + 0.01, dt, 'loaded' FROM hdr WHERE order_id % 500 = 1
       UNION ALL SELECT order_id, user_id, state, amount, dt, 'loaded' FROM hdr WHERE order_id % 500 = 3)""", "hdr", "dt", "amount")
def verify_contents(t: Tables):
    """A load with as many rows as its source, of which some differ, some are missing and some are there twice."""
    columns = ["order_id", "user_id", "state", "amount", "dt"]
    path, part = scratch_table(t.spark, "loaded"), F.col("order_id") % 500
    good = _months(t).select(columns)
    changed = F.when(part == 1, F.col("amount") + F.lit("0.01").cast("decimal(16,2)")).otherwise(F.col("amount"))
    bad = good.where(part != 2).withColumn("amount", money(changed)).unionByName(good.where(part == 3))
    partitions.overwrite_partitions(bad, path)
    schema = T.StructType([f for f in ORDER_SCHEMA.fields if f.name in columns])
    return partitions.verify_contents(good, t.spark.read.schema(schema).parquet(path), "order_id")


@query("conform_to_table",
       "SELECT state, CAST(COUNT(*) AS INTEGER) AS order_count, SUM(amount) AS order_amount FROM hdr GROUP BY state",
       "hdr", money="order_amount")
def conform_to_table(t: Tables):
    report = roles.order_headers(t).groupBy("state").agg(
        F.sum("amount").alias("order_amount"), F.count(F.lit(1)).alias("order_count")
    )
    target = T.StructType(
        [
            T.StructField("state", T.StringType()),
            T.StructField("order_count", T.IntegerType()),
            T.StructField("order_amount", T.DecimalType(16, 2)),
        ]
    )
    return partitions.conform_to_table(report, target)


@query("publish_report",
       f"""SELECT DATE '{lit.ORDERS_AS_OF}' - k AS dt, province_id, COUNT(DISTINCT order_id) AS order_count
       FROM fact, (VALUES (0), (1)) v(k) WHERE dt <= DATE '{lit.ORDERS_AS_OF}' - k GROUP BY 1, 2""",
       "fact", "dt")
def publish_report(t: Tables):
    path = scratch_table(t.spark, "report")
    facts = roles.order_facts(t, True)
    for day in ("2001-07-30", lit.ORDERS_AS_OF, lit.ORDERS_AS_OF):  # the last day is published twice
        per_order = facts.where(F.col("dt") <= F.lit(day).cast("date")).select("province_id", "order_id").distinct()
        report = per_order.groupBy("province_id").agg(F.count("order_id").alias("order_count"))
        partitions.publish_report(report, path, day)
    return t.spark.read.parquet(path)


@query("fill_numeric_nulls",
       """SELECT det.id, order_id, COALESCE(split_activity_amount, 0) AS split_activity_amount,
       COALESCE(split_coupon_amount, 0) AS split_coupon_amount, COALESCE(p_size, 0) AS p_size, p_brand
       FROM det LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON p_partkey = sku_id""",
       "det", money="split_activity_amount split_coupon_amount")
def fill_numeric_nulls(t: Tables):
    big = t.part.where(F.col("p_size") > 25).select("p_partkey", "p_size", "p_brand")
    rows = roles.order_lines(t).join(big, F.col("sku_id") == F.col("p_partkey"), "left")
    return partitions.fill_numeric_nulls(
        rows.select("id", "order_id", "split_activity_amount", "split_coupon_amount", "p_size", "p_brand")
    )


@query("jdbc_snapshot",
       f"""SELECT o_orderkey, o_custkey, o_totalprice, CAST(LEAST(o_orderkey // 5000, 3) AS INTEGER) AS range_no, DATE '{lit.ORDERS_AS_OF}' AS dt
       FROM orders""", days="dt")
def jdbc_snapshot(t: Tables):
    """The key ranges of a parallel read, run over the stored table, give each row once."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    parts = [
        rows.where(condition).withColumn("range_no", F.lit(i))
        for i, condition in enumerate(jdbc.key_ranges("o_orderkey", 0, 20_000, 4))
    ]
    return jdbc.stamp_load_day(reduce(DataFrame.unionByName, parts), lit.ORDERS_AS_OF)


@query("jdbc_incremental",
       f"""SELECT event_id, user_id, event_type, 'source day' AS original_dt, DATE '{lit.EVENTS_AS_OF}' AS dt FROM events
       WHERE ts > (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')""", days="dt")
def jdbc_incremental(t: Tables):
    loaded = t.events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    new = jdbc.rows_past_watermark(t.events, loaded, "ts")
    source = new.select("event_id", "user_id", "event_type", F.lit("source day").alias("dt"))
    return jdbc.stamp_load_day(source, lit.EVENTS_AS_OF)


@query("export_jdbc",
       """SELECT column_name, longest, longest <= 512 AS fits FROM (
       SELECT 'p_name' AS column_name, MAX(length(p_name)) AS longest FROM part
       UNION ALL SELECT 'p_brand', MAX(length(p_brand)) FROM part
       UNION ALL SELECT 'p_type', MAX(length(p_type)) FROM part)""")
def export_jdbc(t: Tables):
    """Text columns of an exported table against the size the target gives them."""
    return jdbc.text_widths(t.part).withColumn("longest", F.col("longest").cast("bigint"))


@query("export_csv", "SELECT order_id, state, amount, create_time FROM hdr WHERE state <> 'P'", "hdr", money="amount", times="create_time")
def export_csv(t: Tables):
    path = scratch_table(t.spark, "csv")
    rows = roles.order_headers(t).select("order_id", "state", "amount", "create_time")
    files.export_csv(rows, path, "state <> 'P'")
    return files.read_csv(t.spark, path, rows.schema)


@query("rows_from_json_lines", "SELECT event_id, user_id, event_type, value FROM events")
def rows_from_json_lines(t: Tables):
    path = scratch_table(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    files.write_json_lines(rows, path)
    return files.rows_from_json_lines(t.spark, path, rows.schema)


@query("raw_table_copy", "SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS l_returnflag FROM lineitem")
def raw_table_copy(t: Tables):
    """Raw copy of a source table: tab-separated, bzip2, ``NULL`` for null."""
    path = scratch_table(t.spark, "raw")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", flag)
    files.write_raw_table(rows, path)
    return files.read_raw_table(t.spark, path, rows.schema)


LOADED = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Types of the test tables as one side names them, as the other does, and in the warehouse.
_TYPES = {
    "BIGINT": ("bigint", "bigint"), "INTEGER": ("int", "int"), "DOUBLE": ("double", "double"), "VARCHAR": ("string", "string"),
    "TIMESTAMP": ("timestamp_ntz", "timestamp"), "FLOAT[]": ("array<float>", "string"), "BOOLEAN": ("boolean", "string"),
}


def _type_sql(n: int) -> str:
    return "CASE data_type " + " ".join(f"WHEN '{k}' THEN '{v[n]}'" for k, v in _TYPES.items()) + " END"


@query("sync_schema",
       f"""SELECT c.table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal, {_type_sql(0)} AS column_type, '' AS comment,
       {_type_sql(1)} AS warehouse_type, source_rows FROM information_schema.columns c JOIN ("""
       + " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS source_rows FROM {n}" for n in LOADED)
       + ") n ON n.table_name = c.table_name")
def sync_schema(t: Tables):
    """Warehouse types for the columns of all loaded tables, with the rows each table brings."""
    catalogue = t.spark.createDataFrame(
        schemas.catalogue_of({n: t.read(n) for n in LOADED}),
        "table_name string, column_name string, ordinal int, column_type string, comment string",
    )
    counted = None
    for n in LOADED:
        one = t.read(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("source_rows"))
        counted = one if counted is None else counted.unionByName(one)
    return schemas.sync_schema(catalogue).join(counted, "table_name")


@query("table_ddl", "SELECT state, COUNT(*) AS n, SUM(amount) AS amount FROM hdr GROUP BY state", "hdr", money="amount")
def table_ddl(t: Tables):
    """A summary table in the catalogue, in ORC: made from its schema, written by name, read back by name."""
    table = f"daymill_orders_{uuid.uuid4().hex}"
    schema = T.StructType([f for f in ORDER_SCHEMA.fields if f.name != "dt"])
    schemas.create_day_table(t.spark, table, schema, scratch_table(t.spark, "orc"))
    schemas.write_day_table(_months(t), table)
    return t.spark.table(table).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


@query("union_with_history",
       f"""SELECT dt, order_count FROM (SELECT dt, COUNT(*) AS order_count FROM hdr WHERE dt <> DATE '{lit.ORDERS_AS_OF}'
       GROUP BY dt UNION ALL SELECT dt, COUNT(*) * 10 FROM hdr WHERE dt = DATE '{lit.ORDERS_AS_OF}' GROUP BY dt)""",
       "hdr", "dt")
def union_with_history(t: Tables):
    daily = roles.order_headers(t).groupBy("dt").agg(F.count(F.lit(1)).alias("order_count"))
    today = fr.one_day(daily, lit.ORDERS_AS_OF).select(
        F.lit(lit.ORDERS_AS_OF).cast("date").alias("dt"), (F.col("order_count") * 10).alias("order_count")
    )
    return partitions.union_with_history(daily, today, [lit.ORDERS_AS_OF])


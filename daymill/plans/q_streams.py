"""Queries over streams and label models.

Streams read files Spark has written from the test tables, drain them and
stop; the query returns what the sink holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.operators import labels as lb
from daymill.plans import roles
from daymill.plans.registry import Tables, query
from daymill.session import scratch_table
from daymill.streaming import changes as ch
from daymill.streaming import events as ev
from daymill.streaming import topics
from daymill.streaming.defaults import stream_defaults, use_rocksdb_state


def _text_files(t: Tables, rows: DataFrame, name: str) -> str:
    path = scratch_table(t.spark, name)
    rows.select("value").write.text(path)
    return path


def _event_lines(t: Tables) -> DataFrame:
    """Events as JSON lines: one in ten has its time in seconds, some have none, some are not JSON."""
    millis = F.unix_millis(roles.instant("ts"))
    slot = F.col("event_id") % 20
    time = F.when(slot < 2, F.floor(millis / 1000)).otherwise(millis)
    full = F.to_json(F.struct("event_id", "user_id", "event_type", time.cast("bigint").alias("time")))
    untimed = F.to_json(F.struct("event_id", "user_id", F.lit("soon").alias("time")))
    broken = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
    return t.events.select(F.when(slot == 18, untimed).when(slot == 19, broken).otherwise(full).alias("value"))


def _drain(writer) -> None:
    q = writer.start()
    q.awaitTermination()


@query("event_time",
       """SELECT CASE WHEN event_id % 20 >= 18 THEN 'dirty' ELSE strftime(CASE WHEN event_id % 20 < 2 THEN make_timestamp(epoch_ms(ts) // 1000 * 1000)
       ELSE ts END, '%Y-%m-%d') END AS day, COUNT(*) AS n FROM events GROUP BY 1""")
def event_time(t: Tables):
    """Records per day of event time from a stream, dirty records beside them."""
    source = t.spark.readStream.schema("value string").text(_text_files(t, _event_lines(t), "lines"))
    good, dirty = ev.event_time(source, "value", ["time"], delay_seconds=5)
    parts = []
    for name, stream in (("good", good.select("value", "event_time")), ("dirty", dirty.select("value"))):
        path, checkpoint = scratch_table(t.spark, name), scratch_table(t.spark, "checkpoint")
        _drain(stream_defaults(stream.writeStream.format("parquet").option("path", path), checkpoint, drain=True))
        parts.append(path)
    stored = t.spark.read.schema("value string, event_time timestamp").parquet(parts[0])
    per_day = stored.groupBy(F.date_format("event_time", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    left = t.spark.read.schema("value string").parquet(parts[1])
    return per_day.unionByName(left.groupBy(F.lit("dirty").alias("day")).agg(F.count(F.lit(1)).alias("n")))


_SECOND = "event_id % 10 = 0 OR ts >= TIMESTAMP '2024-01-20'"


@query("late_records",
       f"""SELECT side, COUNT(*) AS n, MIN(event_id) AS first_id, MAX(event_id) AS last_id FROM (SELECT event_id, CASE WHEN ({_SECOND}) AND ts <
       (SELECT MAX(ts) FROM events WHERE NOT ({_SECOND})) - INTERVAL 2 DAY THEN 'late' ELSE 'on_time' END AS side FROM events) GROUP BY side""")
def late_records(t: Tables):
    """Events that come in two deliveries, the second after a restart; old ones of the second are too late."""
    path, feed, checkpoint = (scratch_table(t.spark, n) for n in ("routed", "feed", "checkpoint"))
    rows = t.events.select("event_id", roles.instant("ts").alias("ts"))
    second = (F.col("event_id") % 10 == 0) | (F.col("ts") >= F.lit("2024-01-20").cast("timestamp"))
    for part in (rows.where(~second), rows.where(second)):
        part.write.mode("append").parquet(feed)
        source = t.spark.readStream.schema(rows.schema).parquet(feed)
        _drain(ev.route_late(source, "ts", dt.timedelta(days=2), path, checkpoint, drain=True))
    sides = [ev.routed(t.spark, path, s, rows.schema).select(F.lit(s).alias("side"), "event_id") for s in ("on_time", "late")]
    return sides[0].unionByName(sides[1]).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("counts_by_time",
       """SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, records FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS start,
       event_type, COUNT(*) AS records FROM events GROUP BY 1, 2) WHERE start + INTERVAL 6 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY""")
def counts_by_time(t: Tables):
    """Events of a feed that brings each of them twice, counted once by type for every six hours that are over."""
    use_rocksdb_state(t.spark)
    path, feed, checkpoint = (scratch_table(t.spark, n) for n in ("counts", "feed", "checkpoint"))
    rows = t.events.select("event_id", "event_type", roles.instant("ts").alias("ts"))
    rows.unionByName(rows).write.parquet(feed)
    once = ev.once_within(t.spark.readStream.schema(rows.schema).parquet(feed), ["event_id"], "ts", "1 day")
    counted = ev.counts_by_time(once, ["event_type"], "ts", "6 hours")
    _drain(stream_defaults(counted.writeStream.format("parquet").option("path", path), checkpoint, drain=True))
    return t.spark.read.schema(counted.schema).parquet(path).select("start", "event_type", "records")


@query("daily_bucket_sink",
       """SELECT CASE WHEN event_id % 20 >= 18 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, COUNT(*) AS n FROM events GROUP BY 1""")
def daily_bucket_sink(t: Tables):
    source = t.spark.readStream.schema("value string").text(_text_files(t, _event_lines(t), "lines"))
    path, checkpoint = scratch_table(t.spark, "days"), scratch_table(t.spark, "checkpoint")
    _drain(ev.daily_bucket_sink(source, "value", "time", path, checkpoint, drain=True))
    stored = t.spark.read.schema("value string, day string").option("basePath", path).text(path)
    return stored.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


CUSTOMER_ROW = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DoubleType())]
)


def _customer_feed(t: Tables) -> DataFrame:
    """Snapshot of all customers, then updates of every third and deletes of every seventh."""
    key = F.col("c_custkey")
    old = F.struct(key.alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = F.struct(key.alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") * 2).alias("balance"))
    nothing = F.lit(None).cast(CUSTOMER_ROW)

    def envelope(rows: DataFrame, before, after, op: str, step: int) -> DataFrame:
        body = F.struct(
            before.alias("before"), after.alias("after"), F.lit(op).alias("op"), (key * 10 + step).alias("pos"),
            F.lit(1700000000000 + step).alias("ts_ms"),
        )
        return rows.select(F.to_json(body).alias("value"))

    base = t.customer
    feed = envelope(base, nothing, old, "r", 0)
    feed = feed.unionByName(envelope(base.where(key % 7 == 0), old, nothing, "d", 2))
    return feed.unionByName(envelope(base.where(key % 3 == 0), old, new, "u", 1))


@query("apply_changes",
       """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS balance
       FROM customer WHERE c_custkey % 7 <> 0""")
def apply_changes(t: Tables):
    """Current customers after a feed whose updates arrive after the deletes."""
    source = t.spark.readStream.schema("value string").text(_text_files(t, _customer_feed(t), "feed"))
    path, checkpoint = scratch_table(t.spark, "state"), scratch_table(t.spark, "checkpoint")
    _drain(ch.apply_changes(source, "value", CUSTOMER_ROW, "id", path, checkpoint, drain=True))
    return ch.current_state(t.spark, path, CUSTOMER_ROW, "id")


@query("kafka_json_source",
       "SELECT event_type, COUNT(*) AS n, COUNT(CASE WHEN event_id % 5 <> 0 THEN 1 END) AS with_payload FROM events GROUP BY event_type")
def kafka_json_source(t: Tables):
    """Binary payloads of a file stream read as a topic's messages are; a null payload stays null."""
    path, out, checkpoint = (scratch_table(t.spark, n) for n in ("messages", "texts", "checkpoint"))
    payload = F.when(F.col("event_id") % 5 != 0, F.to_json(F.struct("event_id", "event_type")).cast("binary"))
    t.events.select(F.col("event_type").cast("binary").alias("key"), payload.alias("value")).write.parquet(path)
    messages = topics.text_payload(t.spark.readStream.schema("key binary, value binary").parquet(path))
    _drain(stream_defaults(messages.writeStream.format("parquet").option("path", out), checkpoint, drain=True))
    stored = t.spark.read.schema("key binary, value string").parquet(out)
    return stored.groupBy(F.col("key").cast("string").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("with_payload")
    )


@query("kafka_sink", "SELECT CAST(event_id AS VARCHAR) AS key, event_type AS value FROM events")
def kafka_sink(t: Tables):
    """Key and text of the messages a topic sink is given, written by a stream to files."""
    path, checkpoint = scratch_table(t.spark, "out"), scratch_table(t.spark, "checkpoint")
    source = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    messages = topics.as_messages(source, "event_id", "event_type")
    _drain(stream_defaults(messages.writeStream.format("parquet").option("path", path), checkpoint, drain=True))
    return t.spark.read.schema("key string, value string").parquet(path)


@query("stream_defaults", "SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def stream_defaults_query(t: Tables):
    """A stream stopped and started again on its checkpoint loses and repeats nothing.

    Every event arrives twice; the time in the key lets the watermark clear
    the state of the deduplication.
    """
    use_rocksdb_state(t.spark)
    path, out, checkpoint = (scratch_table(t.spark, n) for n in ("arriving", "seen", "checkpoint"))
    rows = t.events.select("event_id", "event_type", roles.instant("ts").alias("ts"))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    for arriving in (rows.where(early), rows.where(~early)):
        arriving.unionByName(arriving).write.mode("append").parquet(path)
        source = t.spark.readStream.schema(rows.schema).parquet(path)
        once = source.withWatermark("ts", "1 hour").dropDuplicates(["event_id", "ts"])
        _drain(stream_defaults(once.writeStream.format("parquet").option("path", out), checkpoint, drain=True))
    return t.spark.read.schema(rows.schema).parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids")
    )


# ---- labels -------------------------------------------------------------------

_LABELS = """SELECT entry_id, CAST(order_conversion_rate >= 0.05 AS INTEGER) AS high_conversion,
    CAST(visitor_count >= (SELECT quantile_cont(visitor_count, 0.75) FROM entries) AS INTEGER) AS high_visitor,
    CAST(avg_stay_duration >= (SELECT quantile_cont(avg_stay_duration, 0.7) FROM entries) AS INTEGER) AS high_duration,
    order_buyer_count, new_visitor_count FROM entries"""
NAMES = ["high_conversion", "high_visitor", "high_duration"]


@query("entry_labels", f"SELECT entry_id, high_conversion, high_visitor, high_duration FROM ({_LABELS})", "entries")
def entry_labels(t: Tables):
    return lb.entry_labels(roles.entry_stats(t)).select("entry_id", *NAMES)


def _scaled_sql(c: str) -> str:
    return f"ROUND(({c} - (SELECT AVG({c}) FROM entries)) / (SELECT stddev_pop({c}) FROM entries), 6)"


@query("entry_features",
       f"""SELECT entry_id, {", ".join(f"{_scaled_sql(c)} AS {c}_scaled" for c in lb.NUMERIC)},
       ROUND((visitor_count - (SELECT AVG(visitor_count) FROM entries)) / (SELECT stddev_pop(visitor_count) FROM entries)
       * (order_buyer_count - (SELECT AVG(order_buyer_count) FROM entries)) / (SELECT stddev_pop(order_buyer_count) FROM entries), 6)
       AS visitor_count_x_order_buyer_count FROM entries""", "entries")
def entry_features(t: Tables):
    out = lb.entry_features(roles.entry_stats(t))
    names = [f"{c}_scaled" for c in lb.NUMERIC] + ["visitor_count_x_order_buyer_count"]
    return out.select("entry_id", *[F.round(c, 6).alias(c) for c in names])


def _labelled(t: Tables) -> DataFrame:
    return lb.entry_features(lb.entry_labels(roles.entry_stats(t)))


_FEATURES = len(lb.NUMERIC) + len(lb.INTERACTIONS)


@query("train_label_models",
       f"""SELECT label, CASE label WHEN 'always' THEN 'constant' ELSE 'GBTClassificationModel' END AS kind,
       CASE WHEN label <> 'always' THEN {_FEATURES} + (SELECT COUNT(DISTINCT time_period) + COUNT(DISTINCT entry_page_name) FROM entries) END AS features,
       CASE WHEN label <> 'always' THEN CAST(1 AS DOUBLE) END AS importance, CAST(train_rows AS BIGINT) AS rows, TRUE AS better_than_the_larger_class
       FROM (VALUES ('always'), ('high_duration'), ('high_visitor')) v(label), (SELECT COUNT(*) AS train_rows FROM entries)""",
       "entries")
def train_label_models(t: Tables):
    """Boosted models of two labels and a label of one class: what was fitted, and whether it beats the larger class."""
    rows = _labelled(t).withColumn("always", F.lit(1))
    labels = ["high_visitor", "high_duration", "always"]
    fitted = lb.train_label_models(rows, labels, "entry_id", "gradient_boosting", trees=5)
    kinds = {label: "constant" for label in fitted.constants} | {label: type(m).__name__ for label, m in fitted.models.items()}
    weights = {label: m.featureImportances for label, m in fitted.models.items()}
    shapes = t.spark.createDataFrame(
        [(n, kinds[n], int(weights[n].size) if n in weights else None, round(float(weights[n].toArray().sum()), 6) if n in weights else None) for n in labels],
        "label string, kind string, features long, importance double",
    )
    scored = lb.score_labels(fitted, lb.without_decimals(rows))
    facts = F.inline(F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("is"), F.col(f"{n}_pred").alias("said")) for n in labels]))
    right = F.count_if(F.col("is") == F.col("said"))
    larger = F.greatest(F.sum("is"), F.sum(1 - F.col("is")))
    told = scored.select(facts).groupBy("label").agg(F.count(F.lit(1)).alias("rows"), (right >= larger).alias("better_than_the_larger_class"))
    return shapes.join(told, "label")


@query("score_labels",
       "SELECT entry_id, " + ", ".join(f"TRUE AS {n}_in_range, TRUE AS {n}_follows, TRUE AS {n}_same" for n in NAMES)
       + ", '2024-01-31 00:00:00' AS prediction_time FROM entries", "entries")
def score_labels(t: Tables):
    """Scores of every entry by models that were saved and loaded: chances from 0 to 1, the likelier class predicted,
    the same as before saving."""
    rows = _labelled(t)
    fitted = lb.train_label_models(rows, NAMES, "entry_id", trees=5, depth=5)
    path = scratch_table(t.spark, "models")
    lb.save_label_models(fitted, path)
    when = F.lit("2024-01-31 00:00:00").cast("timestamp")
    scored = lb.score_labels(lb.load_label_models(t.spark, path), lb.without_decimals(rows), when)
    before = lb.score_labels(fitted, lb.without_decimals(rows)).select(F.col("entry_id").alias("__id"), *[F.col(f"{n}_prob").alias(f"__{n}") for n in NAMES])
    both = scored.join(before, F.col("entry_id") == F.col("__id"), "left")
    facts = []
    for n in NAMES:
        chance, said = F.col(f"{n}_prob"), F.col(f"{n}_pred")
        facts += [
            chance.between(0, 1).alias(f"{n}_in_range"),
            ((chance == 0.5) | (said == (chance > 0.5).cast("int"))).alias(f"{n}_follows"),
            chance.eqNullSafe(F.col(f"__{n}")).alias(f"{n}_same"),
        ]
    return both.select("entry_id", *facts, "prediction_time")


def _confusion_sql(label: str, guess: str) -> str:
    return f"""SELECT '{label}' AS label, ROUND(SUM(hit) / SUM(support), 4) AS accuracy, ROUND(AVG(CASE WHEN guessed + support = 0 THEN 1
        ELSE 2 * hit / (guessed + support) END), 4) AS macro_f1, CAST(SUM(support) AS BIGINT) AS rows FROM (SELECT class,
        SUM(CASE WHEN y = class THEN 1 ELSE 0 END) AS support, SUM(CASE WHEN p = class THEN 1 ELSE 0 END) AS guessed,
        SUM(CASE WHEN y = class AND p = class THEN 1 ELSE 0 END) AS hit
        FROM (SELECT {label} AS y, {guess} AS p FROM ({_LABELS})), (VALUES (0), (1)) v(class)
        GROUP BY class HAVING SUM(CASE WHEN y = class OR p = class THEN 1 ELSE 0 END) > 0)"""


@query("evaluate_labels",
       _confusion_sql("high_visitor", "CASE WHEN new_visitor_count > 5 THEN 1 ELSE 0 END") + " UNION ALL "
       + _confusion_sql("high_conversion", "CASE WHEN order_buyer_count > 1 THEN 1 ELSE 0 END"), "entries")
def evaluate_labels(t: Tables):
    """Scores of two fixed guesses, so that both engines evaluate the same predictions."""
    rows = lb.entry_labels(roles.entry_stats(t)).withColumns(
        {
            "guess_visitor": (F.col("new_visitor_count") > 5).cast("int"),
            "guess_conversion": (F.col("order_buyer_count") > 1).cast("int"),
        }
    )
    return lb.evaluate_labels(rows, [("high_visitor", "guess_visitor"), ("high_conversion", "guess_conversion")])

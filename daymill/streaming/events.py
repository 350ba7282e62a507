"""Event time of JSON records: late and repeated records, counts by time, and text files in one folder per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from daymill.sources import folders
from daymill.streaming.defaults import stream_defaults

#: Batches whose latest time is kept for a batch that runs again.
KEPT_PROGRESS = 10
ERROR_BUCKET = "error_bucket"
ROLL_INTERVAL = "10 minutes"
SECONDS_LIMIT = 10_000_000_000


def _number(text: str, field: str) -> Column:
    return F.get_json_object(text, f"$.{field}").try_cast("bigint")


def time_of_record(text: str, fields: Sequence[str], unit: str) -> Column:
    """Time from the first of ``fields`` that is present, in ``seconds`` or ``millis``."""
    value = F.coalesce(*[_number(text, f) for f in fields])
    return F.timestamp_millis(value) if unit == "millis" else F.timestamp_seconds(value)


def split_by_time(df: DataFrame, text: str, fields: Sequence[str], unit: str = "millis") -> tuple[DataFrame, DataFrame]:
    """Records with an event time, and the dirty records without one."""
    timed = df.withColumn("event_time", time_of_record(text, fields, unit))
    return timed.where(F.col("event_time").isNotNull()), timed.where(F.col("event_time").isNull()).drop("event_time")


def event_time(
    df: DataFrame, text: str, fields: Sequence[str], delay_seconds: int, unit: str = "millis"
) -> tuple[DataFrame, DataFrame]:
    """As :func:`split_by_time`, with a watermark that allows ``delay_seconds`` of disorder."""
    good, dirty = split_by_time(df, text, fields, unit)
    return good.withWatermark("event_time", f"{delay_seconds} seconds"), dirty


def once_within(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Stream without repeats: of records with equal ``keys`` that come within ``delay`` of each other the first.

    The state holds the keys of that time only; a null key is a value like any other.
    """
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def counts_by_time(df: DataFrame, keys: Sequence[str], time: str, width: str, delay: str | None = None) -> DataFrame:
    """Records of each stretch of ``width`` and key: a stretch is given out once, when the watermark has passed its end.

    Without ``delay`` the watermark is the one that ``df`` has, such as that of :func:`once_within`.
    """
    span = F.window(time, width)
    timed = df.withWatermark(time, delay) if delay else df
    counted = timed.groupBy(span.alias("span"), *keys).agg(F.count(F.lit(1)).alias("records"))
    return counted.select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), *keys, "records")


def _latest_before(spark: SparkSession, path: str, batch: int) -> dt.datetime | None:
    """The latest time seen before a batch: what the newest older batch wrote down."""
    known = [int(b) for b in folders.partition_values(spark, path, "batch") if int(b) < batch]
    if not known:
        return None
    rows = spark.read.schema("latest timestamp").parquet(f"{path}/batch={max(known)}").collect()
    return rows[0].latest if rows else None


def route_late(df: DataFrame, time: str, delay: dt.timedelta, path: str, checkpoint: str, drain: bool = False) -> DataStreamWriter:
    """Records on time go to ``path``/on_time, those that come too late to ``path``/late, in a folder for each batch.

    Late is what lies more than ``delay`` behind the latest time of the batches before; a record without a time is
    late.  Each batch writes that latest time down beside its records, so a batch that runs again, after a failure or
    in another session, is parted the same way and replaces what it had written.  Read with :func:`routed`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = _latest_before(spark, f"{path}/progress", batch_id)
        on_time = F.col(time).isNotNull()
        if latest is not None:
            on_time = on_time & (F.col(time) >= F.lit(latest - delay))
        for name, rows in (("on_time", batch.where(on_time)), ("late", batch.where(~on_time))):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        seen = batch.agg(F.max(time).alias("latest"))
        known = F.lit(latest).cast("timestamp")
        seen.select(F.greatest("latest", known).alias("latest")).coalesce(1).write.mode("overwrite").parquet(f"{path}/progress/batch={batch_id}")
        # Only the newest few are asked for again.
        for old in folders.partition_values(spark, f"{path}/progress", "batch"):
            if int(old) < batch_id - KEPT_PROGRESS:
                folders.remove(spark, f"{path}/progress/batch={old}")

    return stream_defaults(df.writeStream.foreachBatch(store), checkpoint, drain)


def routed(spark: SparkSession, path: str, side: str, schema: T.StructType) -> DataFrame:
    """What :func:`route_late` stored as ``on_time`` or ``late``."""
    if not folders.exists(spark, f"{path}/{side}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{side}").select(schema.names)


def day_bucket(text: str, field: str) -> Column:
    """Folder of a record: ``yyyyMMdd`` of its own time, or the error bucket.

    Numbers below 1e10 are seconds, others milliseconds.  A record without
    the field counts as time 0, one that is not JSON or whose field is not a
    number goes to the error bucket.
    """
    raw = F.get_json_object(text, f"$.{field}")
    is_record = F.try_parse_json(F.col(text)).isNotNull() & F.col(text).rlike(r"^\s*\{")
    value = F.when(raw.isNull(), F.lit(0)).otherwise(raw.try_cast("bigint"))
    millis = F.when(value < SECONDS_LIMIT, value * 1000).otherwise(value)
    day = F.date_format(F.timestamp_millis(millis), "yyyyMMdd")
    return F.coalesce(F.when(is_record, day), F.lit(ERROR_BUCKET))


def daily_bucket_sink(
    df: DataFrame, text: str, field: str, path: str, checkpoint: str, drain: bool = False, rows_per_file: int = 0
) -> DataStreamWriter:
    """Append raw records to ``day=...`` folders, each record once.

    A trigger closes its files, so files roll with the trigger interval;
    ``rows_per_file`` bounds their size.  Rows are not shuffled: a busy day
    is written by every task that holds rows of it.
    """
    rows = df.select(F.col(text).alias("value"), day_bucket(text, field).alias("day"))
    writer = rows.writeStream.format("text").partitionBy("day").option("path", path)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer = stream_defaults(writer, checkpoint, drain)
    return writer if drain else writer.trigger(processingTime=ROLL_INTERVAL)

"""Tables with one folder per day: read, replace, publish, verify."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.functions.days import as_date
from daymill.session import file_sizes
from daymill.sources import folders

# --- fixed values: the time column that gives a source table its day ---
TIME_COLUMNS = {
    "price_power_product": "create_time",
    "product_alert": "create_time",
    "product_conversion": "etl_time",
    "product_follow": "follow_time",
    "product_info": "create_time",
    "product_sales": "payment_time",
    "product_sku": "create_time",
    "product_stock": "etl_time",
    "product_traffic": "etl_time",
    "search_keyword": "etl_time",
}


def read_partition(
    spark: SparkSession,
    path: str,
    day: str | dt.date,
    schema: T.StructType | None = None,
    live_only: bool = False,
    fmt: str = "parquet",
    day_column: str = "dt",
) -> DataFrame:
    """One day of a partitioned table; the day filter prunes folders."""
    reader = spark.read.format(fmt)
    table = (reader.schema(schema) if schema else reader).load(path)
    rows = table.where(F.col(day_column) == F.lit(as_date(day)))
    return rows.where(F.col("is_deleted") == "0") if live_only else rows


def time_column(table: str, schema: T.StructType) -> str:
    """The mapped time column of a source table, else its first date or timestamp column."""
    if table in TIME_COLUMNS:
        return TIME_COLUMNS[table]
    for field in schema.fields:
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return field.name
    raise ValueError(f"table {table} has no time column")


def partition_by_event_date(df: DataFrame, time_col: str, day_column: str = "dt") -> DataFrame:
    """Add the day of the row's own time; rows without a time are left out, see :func:`rows_without_event_date`."""
    return df.where(F.col(time_col).isNotNull()).withColumn(day_column, F.to_date(time_col))


def rows_without_event_date(df: DataFrame, time_col: str) -> DataFrame:
    """The rows that :func:`partition_by_event_date` leaves out, to be counted and stored as errors."""
    return df.where(F.col(time_col).isNull())


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_columns: Sequence[str] = ("dt",),
    fmt: str = "parquet",
) -> None:
    """Replace exactly the partitions present in ``df``, in one write.

    The rebalance hint gathers the rows of a day, merges small days into one
    task and splits a day that holds a large share of the data over several.
    """
    with file_sizes(df.sparkSession):
        (
            df.hint("rebalance", *[F.col(c) for c in partition_columns])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_columns)
            .format(fmt)
            .save(path)
        )


def conform_to_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the target table, in its order and with its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def publish_report(df: DataFrame, path: str, day: str | dt.date, day_column: str = "dt", fmt: str = "parquet") -> None:
    """Store the report of one day; publishing the day again replaces it."""
    stamped = df.withColumn(day_column, F.lit(as_date(day)))
    overwrite_partitions(stamped, path, [day_column], fmt)


def union_with_history(
    history: DataFrame, today: DataFrame, days: Sequence[str | dt.date], day_column: str = "dt"
) -> DataFrame:
    """Report history with some days replaced, as a frame; the replaced folders are not read, rows without a day stay."""
    kept = ~F.col(day_column).isin([as_date(d) for d in days])
    return history.where(kept | F.col(day_column).isNull()).unionByName(today)


def verify_load(source: DataFrame, loaded: DataFrame, day_column: str = "dt") -> DataFrame:
    """Row counts of each day, no day included, on both sides and whether they agree."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = source.select(day_column, one.alias("s"), none.alias("l")).union(loaded.select(day_column, none, one))
    counts = sides.groupBy(day_column).agg(F.sum("s").alias("source_rows"), F.sum("l").alias("loaded_rows"))
    return counts.withColumn("matches", F.col("source_rows") == F.col("loaded_rows"))


#: Buckets of a day's keys whose contents are compared at once.
BUCKETS = 256


def _filed(df: DataFrame, columns: Sequence[str], key: str, buckets: int) -> DataFrame:
    """Rows with the bucket of their key and a hash of all columns that tells nulls apart."""
    parts = [p for c in columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return df.withColumns({"__bucket": F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int"), "__hash": F.xxhash64(*parts)})


def fingerprints(df: DataFrame, key: str, day_column: str = "dt", columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(day, bucket, rows, low, high): the rows of each day and key bucket in any order, as a sum of their hashes.

    Copies count, order doesn't.  The two halves of the hashes are added up apart, so that no sum overflows.
    """
    filed = _filed(df, columns or df.columns, key, buckets)
    return filed.groupBy(F.col(f"`{day_column}`").alias("day"), F.col("__bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("__hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned("__hash", 32)).alias("high"),
    )


def differing_buckets(source: DataFrame, loaded: DataFrame, key: str, day_column: str = "dt", buckets: int = BUCKETS) -> DataFrame:
    """(day, bucket, source_rows, loaded_rows) of the buckets whose rows are not the same on both sides.

    Columns are those of ``source``, whatever their order.  Every side is read once and folded before the shuffle.
    """
    columns = source.columns
    sides = [fingerprints(df, key, day_column, columns, buckets) for df in (source, loaded)]
    minus = sides[1].select("day", "bucket", *[(-F.col(c)).alias(c) for c in ("rows", "low", "high")], F.col("rows").alias("loaded_rows"))
    both = sides[0].withColumn("loaded_rows", F.lit(0).cast("bigint")).unionByName(minus)
    summed = both.groupBy("day", "bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high", "loaded_rows")])
    apart = summed.where("rows <> 0 OR low <> 0 OR high <> 0")
    return apart.select("day", "bucket", (F.col("rows") + F.col("loaded_rows")).alias("source_rows"), "loaded_rows")


def verify_contents(source: DataFrame, loaded: DataFrame, key: str, day_column: str = "dt", buckets: int = BUCKETS) -> DataFrame:
    """Rows that only one side has, or has more often: all columns, ``side`` (source or loaded) and ``times``.

    Only the buckets that differ are compared row by row; a load without fault compares none.
    """
    columns = source.columns
    found = differing_buckets(source, loaded, key, day_column, buckets).select(F.col("day").alias("__day"), F.col("bucket").alias("__b"))

    def near(df: DataFrame, sign: int) -> DataFrame:
        filed = _filed(df.select(columns), columns, key, buckets)
        same = F.col("__bucket") == F.col("__b")
        same = same & F.col(f"`{day_column}`").eqNullSafe(F.col("__day"))
        return filed.join(found, same, "left_semi").select(*columns, F.lit(sign).cast("bigint").alias("__n"))

    left = near(source, 1).unionByName(near(loaded, -1)).groupBy(columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    return left.select(*columns, F.when(F.col("__n") > 0, "source").otherwise("loaded").alias("side"), F.abs("__n").alias("times"))


def verify_days(spark: SparkSession, path: str, source: DataFrame, day_column: str = "dt") -> DataFrame:
    """(day, in_source, in_storage) of the days that only one side has: the source's rows or the folders in storage."""
    stored = folders.partition_values(spark, path, day_column)
    listed = spark.createDataFrame([(d,) for d in stored], "day string").withColumn("stored", F.lit(True))
    none = F.lit("__HIVE_DEFAULT_PARTITION__")
    held = source.select(F.coalesce(F.col(day_column).cast("string"), none).alias("day")).distinct().withColumn("held", F.lit(True))
    both = held.join(listed, "day", "full_outer")
    apart = both.where("held IS NULL OR stored IS NULL")
    return apart.select("day", F.col("held").isNotNull().alias("in_source"), F.col("stored").isNotNull().alias("in_storage"))


def fill_numeric_nulls(df: DataFrame, value: int = 0) -> DataFrame:
    """Zero for null in every numeric column, decimals included; text stays null."""
    changed: Mapping[str, Column] = {
        f.name: F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType)
    }
    return df.withColumns(dict(changed))

"""History of dimension rows with start and end dates; current state from changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daymill.functions.days import OPEN_END, as_date, seconds_to_timestamp
from daymill.functions.values import EMAIL_PATTERN, PHONE_PATTERN, hash_if_valid
from daymill.session import scratch_table
from daymill.sources import folders
from daymill.sources.partitions import overwrite_partitions


def user_zip_init(users: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
    """First load of the user history: every row open, secrets hashed.

    Phone and e-mail are hashed only if they have the expected shape, else
    null.  Rows start on ``as_of``, or on their create time (epoch seconds)
    when no date is given.  The birthday is counted in days since 1970.
    """
    start = F.lit(as_date(as_of)) if as_of else F.to_date(seconds_to_timestamp("create_time"))
    return users.select(
        "id",
        "login_name",
        F.md5("passwd").alias("passwd"),
        F.md5("real_name").alias("real_name"),
        hash_if_valid("phone_num", PHONE_PATTERN).alias("phone_num"),
        hash_if_valid("email", EMAIL_PATTERN).alias("email"),
        "user_level",
        F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("birthday").cast("int")).alias("birthday"),
        "gender",
        start.alias("start_date"),
        F.lit(OPEN_END).alias("end_date"),
    )


def address_zip_init(addresses: DataFrame) -> DataFrame:
    """First load of the address history, phone hashed if valid, start from the create text."""
    made = F.concat(F.substring("create_time", 1, 10), F.lit(" "), F.substring("create_time", 12, 8))
    return addresses.withColumns(
        {
            "phone": hash_if_valid("phone", PHONE_PATTERN),
            "start_date": made.try_cast("timestamp").cast("date"),
            "end_date": F.lit(OPEN_END),
        }
    ).drop("create_time")


def _differs(attributes: Sequence[str], left: str, right: str) -> Column:
    same = [F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in attributes]
    out = ~same[0]
    for c in same[1:]:
        out = out | ~c
    return out


def user_zip_merge(
    history: DataFrame, changes: DataFrame, key: str, attributes: Sequence[str], as_of: str | dt.date, order: str | None = None
) -> DataFrame:
    """Close changed rows the day before ``as_of`` and open their new versions.

    Several changes of one key are first reduced to the latest by ``order``.
    Closed history passes through unjoined.  A change equal to the open row
    leaves it alone, so a second run gives the same table; a change that
    arrives again for a row opened on ``as_of`` replaces that row.  Rows of
    the history without a key or an end date pass through as they are;
    changes without a key name no row and are left out.
    """
    day = as_date(as_of)
    changes = changes.where(F.col(key).isNotNull())
    latest = changes.select(key, *attributes) if order is None else latest_per_key(changes, key, attributes, order)
    new = latest.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in attributes])
    is_open = F.col("end_date").eqNullSafe(F.lit(OPEN_END)) & F.col(key).isNotNull()
    joined = history.where(is_open).join(new, F.col(key) == F.col("__key"), "full_outer")
    known, arrived = F.col(key).isNotNull(), F.col("__key").isNotNull()
    changed = known & arrived & _differs(attributes, "", "__")
    opened_today = F.col("start_date") == F.lit(day)

    old = F.struct(
        F.col(key).alias(key),
        *[F.col(c).alias(c) for c in attributes],
        F.col("start_date").alias("start_date"),
        F.when(changed, F.lit(day - dt.timedelta(days=1))).otherwise(F.col("end_date")).alias("end_date"),
    )
    fresh = F.struct(
        F.col("__key").alias(key),
        *[F.col(f"__{c}").alias(c) for c in attributes],
        F.lit(day).alias("start_date"),
        F.lit(OPEN_END).alias("end_date"),
    )
    versions = F.when(changed & opened_today, F.array(fresh)).when(changed, F.array(old, fresh)).when(
        ~known, F.array(fresh)
    ).otherwise(F.array(old))
    columns = [key, *attributes, "start_date", "end_date"]
    return joined.select(F.inline(versions)).select(columns).unionByName(history.where(~is_open).select(columns))


def _touched(history: DataFrame, changes: DataFrame, key: str, day: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the changed keys that reach the first changed day or the day before it, and all other rows.

    The days before that are not joined; on a table with a folder for each end date they are not read for it.
    """
    first = changes.agg(F.date_sub(F.min(day), 1).alias("first")).scalar()
    may = F.coalesce((F.col("end_date") >= first) & F.col("start_date").isNotNull(), F.lit(False))
    keys = changes.select(F.col(key).alias("__key")).distinct().withColumn("__hit", F.lit(True))
    near = history.where(may).join(keys, F.col(key) == F.col("__key"), "left")
    hit = near.where("__hit").select(history.columns)
    return hit, near.where(F.col("__hit").isNull()).select(history.columns).unionByName(history.where(~may))


def _timeline(touched: DataFrame, changes: DataFrame, key: str, attributes: Sequence[str], day: str) -> DataFrame:
    """The rows of the changed keys, cut anew at the starts of their rows and at the days of their changes."""
    values = F.struct(*attributes)
    none = F.lit(None).cast("date")
    starts = touched.select(key, F.col("start_date").alias("__day"), values.alias("__v"), F.lit(0).alias("__new"), F.col("end_date").alias("__end"))
    given = changes.select(key, F.col(day).alias("__day"), values.alias("__v"), F.lit(1).alias("__new"), none.alias("__end"))
    # A change on the day a row starts takes its place and keeps its end.
    cuts = starts.unionByName(given).groupBy(key, "__day").agg(F.max_by("__v", "__new").alias("__v"), F.max("__end").alias("__end"))

    line = Window.partitionBy(key).orderBy("__day")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A day inside a row lasts to that row's end at most; after the end of the last row nothing bounds it.
    cover = F.last("__end", ignorenulls=True).over(so_far)
    bounded = cuts.withColumn("__until", F.when(cover >= F.col("__day"), cover).otherwise(F.lit(OPEN_END)))
    joins = F.lag("__until").over(line) >= F.date_sub("__day", 1)
    same = F.col("__v").eqNullSafe(F.lag("__v").over(line)) & joins & F.col("__end").isNull()
    kept = bounded.withColumn("__same", F.coalesce(same, F.lit(False))).where("NOT __same")
    following = F.date_sub(F.lead("__day").over(line), 1)
    return kept.select(
        key,
        *[F.col("__v")[c].alias(c) for c in attributes],
        F.col("__day").alias("start_date"),
        F.least(F.coalesce(following, F.lit(OPEN_END)), F.col("__until")).alias("end_date"),
    )


def _dated(changes: DataFrame, key: str, attributes: Sequence[str], day: str, order: str) -> DataFrame:
    """The last change of each key and day by ``order``: a busy key has as many as it has days."""
    last = F.max_by(F.struct(*attributes), F.col(order))
    usable = changes.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    return usable.groupBy(key, F.col(day).cast("date").alias("__at")).agg(last.alias("__last")).select(key, "__at", "__last.*")


def user_zip_chain(history: DataFrame, changes: DataFrame, key: str, attributes: Sequence[str], day: str, order: str) -> DataFrame:
    """History after changes that each count from their own ``day`` on, however many a key has and however late they come.

    The days of the changes and the starts of the rows cut a key's time line.  A change lasts until the next cut, or
    until the end of the row it falls in: later rows stand, a late change splits the closed row around its day.  After
    the last row's end it opens the key again.  Of several changes on a day the last by ``order`` counts; one that
    says what holds already leaves the rows alone, so merging a batch again gives the same table.  Changes without key
    or day are left out; rows without a key, start or end pass through.
    """
    columns = [key, *attributes, "start_date", "end_date"]
    dated = _dated(changes, key, attributes, day, order)
    touched, rest = _touched(history.select(columns), dated, key, "__at")
    return rest.unionByName(_timeline(touched, dated, key, attributes, "__at"))


def user_zip_store(
    spark: SparkSession, path: str, schema: T.StructType, changes: DataFrame, key: str, attributes: Sequence[str], day: str, order: str
) -> list[dt.date]:
    """Merges ``changes`` as :func:`user_zip_chain` does into the table at ``path``, a folder for each end date.

    Only folders with a row that goes, comes or differs are written; gives their dates.  Folders are replaced one by
    one: after a failure in between, the same call repairs the table, since rows that overlap are cut again.
    """
    columns = [key, *attributes, "start_date", "end_date"]
    history = spark.read.schema(schema).parquet(path).select(columns)
    dated = _dated(changes, key, attributes, day, order)
    touched, _ = _touched(history, dated, key, "__at")
    staged = scratch_table(spark, "history")
    sign = F.lit(1)
    old = touched.withColumn("__n", -sign)
    new = _timeline(touched, dated, key, attributes, "__at").withColumn("__n", sign)
    # Rows that are on one side only; a row on both sides cancels out.
    old.unionByName(new).groupBy(columns).agg(F.sum("__n").alias("__n")).where("__n <> 0").write.parquet(staged)
    moved = spark.read.parquet(staged)
    dates = sorted(r.end_date for r in moved.select("end_date").distinct().collect())  # days, not rows
    if not dates:
        folders.remove(spark, staged)
        return dates
    kept = history.where(F.col("end_date").isin(dates)).withColumn("__n", F.lit(1).cast("bigint"))
    left = kept.unionByName(moved).groupBy(columns).agg(F.sum("__n").alias("__n")).where("__n > 0")
    full = scratch_table(spark, "history")
    left.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(columns).write.parquet(full)
    rows = spark.read.parquet(full)
    overwrite_partitions(rows, path, ["end_date"])
    held = {r.end_date for r in rows.select("end_date").distinct().collect()}
    for date in dates:
        if date not in held:
            folders.remove(spark, f"{path}/end_date={date}")
    folders.remove(spark, staged)
    folders.remove(spark, full)
    return dates


def latest_per_key(rows: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Last row per key; folded before the shuffle, so a busy key stays cheap."""
    last = F.max_by(F.struct(*columns), F.col(order))
    return rows.groupBy(key).agg(last.alias("__last")).select(key, "__last.*")


def latest_state(changes: DataFrame, key: str, columns: Sequence[str], order: str, operation: str = "op") -> DataFrame:
    """Current rows after a change feed: the last change of a key counts, ``d`` removes it."""
    last = latest_per_key(changes, key, [*columns, operation], order)
    return last.where(F.col(operation) != "d").select(key, *columns)


def merge_state(current: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    """Apply one batch of changes to the current rows, each row carrying its position.

    A change older than the stored row is ignored, so late or repeated
    batches give the same state.  Deleted keys stay as rows with ``op = 'd'``,
    so that an older update arriving later cannot bring them back.
    """
    every = [key, *columns, "op", order]
    return latest_per_key(current.select(every).unionByName(changes.select(every)), key, [*columns, "op", order], order)

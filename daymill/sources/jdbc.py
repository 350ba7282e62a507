"""Relational sources and targets.  Connections are made by Spark's tasks only."""

from __future__ import annotations

import datetime as dt
import os
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.functions.days import as_date

FETCH_ROWS = 1_000
BATCH_ROWS = 10_000


def connection_options(url: str, driver: str, environ: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Connection options; user and password come from the environment."""
    options = {"url": url, "driver": driver}
    for option, variable in (("user", "WAREHOUSE_DB_USER"), ("password", "WAREHOUSE_DB_PASSWORD")):
        if variable in environ:
            options[option] = environ[variable]
    return options


def snapshot_options(table: str, key: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Read options for a full copy in ``partitions`` parallel key ranges.

    The bounds only place the cuts: rows outside them are still read, by the
    first and the last range.
    """
    return {
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(FETCH_ROWS),
    }


def key_ranges(key: str, lower: int, upper: int, partitions: int) -> list[str]:
    """Predicates that cut a table into disjoint ranges that cover every row.

    For ``spark.read.jdbc(predicates=...)`` when the key has to be cut at
    places of one's own choice; null keys belong to the first range.
    """
    step = max(1, (upper - lower) // partitions)
    cuts = [lower + step * i for i in range(1, partitions)]
    if not cuts:
        return ["1 = 1"]
    first = f"{key} < {cuts[0]} OR {key} IS NULL"
    middle = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [first, *middle, f"{key} >= {cuts[-1]}"]


def stamp_load_day(df: DataFrame, day: str | dt.date, day_column: str = "dt") -> DataFrame:
    """Add the load day; a source column of that name is kept as ``original_<name>``."""
    if day_column in df.columns:
        df = df.withColumnRenamed(day_column, f"original_{day_column}")
    return df.withColumn(day_column, F.lit(as_date(day)))


def jdbc_snapshot(
    spark: SparkSession, connection: Mapping[str, str], read: Mapping[str, str], day: str | dt.date
) -> DataFrame:
    """Full copy of a table, stamped with the load day."""
    return stamp_load_day(spark.read.format("jdbc").options(**connection).options(**read).load(), day)


def rows_past_watermark(
    source: DataFrame, target: DataFrame, column: str, key: Sequence[str] | None = None
) -> DataFrame:
    """Source rows later than the last value already loaded; all rows at first.

    Rows without a value, or with the last value itself, come too unless they
    are loaded: ``key`` (by default all columns that both sides have) and the
    value tell.  The watermark is a one-row subquery, so nothing is fetched by
    the driver.
    """
    mark = target.agg(F.max(column).alias("mark")).scalar()
    names = list(dict.fromkeys([*(key or [c for c in source.columns if c in target.columns]), column]))
    open_ = F.col(column).isNull() | F.coalesce(F.col(column) == mark, F.lit(False))
    loaded = target.where(open_).select([F.col(c).alias(f"__loaded_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"__loaded_{c}")) for c in names]
    return source.where(open_ | F.coalesce(F.col(column) > mark, mark.isNull())).join(loaded, same, "left_anti")


def incremental_query(table: str, column: str, mark: str | None, undecided: bool = False) -> str:
    """Source query for the rows past a watermark, to be run by the database.

    ``undecided`` adds the rows at the watermark and those without a value.
    """
    if mark is None:
        return f"SELECT * FROM {table}"
    quoted = mark.replace("'", "''")
    if undecided:
        return f"SELECT * FROM {table} WHERE {column} >= '{quoted}' OR {column} IS NULL"
    return f"SELECT * FROM {table} WHERE {column} > '{quoted}'"


def jdbc_incremental(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    column: str,
    loaded: DataFrame | None,
    day: str | dt.date,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """New rows of a table; the watermark is the largest loaded value of the same column.

    Rows at the watermark and rows without a value are read again and left out
    if loaded, see :func:`rows_past_watermark`.
    """
    mark = None
    if loaded is not None:
        mark = loaded.agg(F.max(column).cast("string")).first()[0]  # one row
    query = incremental_query(table, column, mark, undecided=True)
    new = spark.read.format("jdbc").options(**connection).option("query", query).option("fetchsize", FETCH_ROWS).load()
    if loaded is not None:
        # The source's own columns: without the load day, under their names there.
        before = loaded.drop("dt").withColumnRenamed("original_dt", "dt")
        new = rows_past_watermark(new, before, column, key)
    return stamp_load_day(new, day)


def with_retries(
    action: Callable[[], None], attempts: int = 3, wait: float = 10.0, sleep: Callable = time.sleep
) -> None:
    """Run a load, waiting longer after each failure; the last failure is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            if attempt == attempts:
                raise
            sleep(wait * attempt)
    return None


# --- fixed values: target types of exported columns ---
EXPORT_TYPES = {
    "string": "VARCHAR(512)",
    "int": "INT",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "TINYINT(1)",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "binary": "BLOB",
}


def export_type(data_type: T.DataType, long_text: bool = False) -> str:
    if long_text:
        return "LONGTEXT"
    name = data_type.simpleString()
    if name.startswith("decimal"):
        return name.upper()
    return EXPORT_TYPES.get(name, "TEXT")


def export_column_types(schema: T.StructType, long_text: tuple[str, ...] = ()) -> str:
    """Value of the ``createTableColumnTypes`` write option."""
    return ", ".join(f"{f.name} {export_type(f.dataType, f.name in long_text)}" for f in schema.fields)


def export_ddl(table: str, schema: T.StructType, long_text: tuple[str, ...] = (), key: str | None = "id") -> str:
    """Statement that rebuilds the target table; a column called ``id`` becomes its key."""
    columns = [f"{f.name} {export_type(f.dataType, f.name in long_text)}" for f in schema.fields]
    if key and key in [f.name.lower() for f in schema.fields]:
        columns.append(f"PRIMARY KEY ({key})")
    return f"CREATE TABLE {table} (\n  " + ",\n  ".join(columns) + "\n)"


def text_widths(df: DataFrame) -> DataFrame:
    """Longest value of each text column against the exported size, from the data."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df.sparkSession.createDataFrame([], "column_name string, longest int, fits boolean")
    longest = df.agg(*[F.max(F.length(c)).alias(c) for c in texts])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("longest")) for c in texts])
    return longest.select(F.inline(pairs)).withColumn("fits", F.coalesce(F.col("longest") <= 512, F.lit(True)))


def export_jdbc(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    partitions: int = 8,
    long_text: tuple[str, ...] | None = None,
    keep_table: bool = False,
) -> None:
    """Replace the rows of a relational table; each task inserts batches of 10,000.

    Text columns that hold values too long for the exported size become long
    text; they are measured first unless ``long_text`` names them.

    ``keep_table`` empties a table made by :func:`export_ddl` instead of
    creating one, so its key stays.  Rows never pass through the driver.
    """
    if long_text is None:  # one row per column
        long_text = tuple(r["column_name"] for r in text_widths(df).where(~F.col("fits")).collect())
    (
        df.write.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("batchsize", BATCH_ROWS)
        .option("numPartitions", partitions)
        .option("createTableColumnTypes", export_column_types(df.schema, long_text))
        .option("truncate", str(keep_table).lower())
        .mode("overwrite")
        .save()
    )

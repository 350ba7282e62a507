"""The list of queries and of the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.plans.ctes import with_ctes
from daymill.session import apply_runtime_options, size_for_input, stored_bytes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one folder, read on demand.

    Frames are kept, so a query that uses a table or a role several times
    opens its files and analyses it once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.frames: dict[str, DataFrame] = {}
        self.bytes_read = 0

    def __getattr__(self, name: str) -> DataFrame:
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.once(f"table {name}", lambda: self._open(name))

    def _open(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.bytes_read += stored_bytes(table)
        size_for_input(self.spark, self.bytes_read)  # writers inside a query run at once
        return table

    def once(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self.frames:
            self.frames[key] = build()
        return self.frames[key]


def shared(role: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A role frame built once per :class:`Tables` and arguments."""

    @wraps(role)
    def cached(t: Tables, *args, **kwargs) -> DataFrame:
        return t.once(f"{role.__name__}{args}{sorted(kwargs.items())}", lambda: role(t, *args, **kwargs))

    return cached


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: days and times as text, decimals as double, lists as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.when(c.isNotNull(), F.array_join(c.cast("array<string>"), ","))
        out.append(c.alias(f.name))
    return df.select(out)


def query(name: str, sql: str | None = None, ctes: str = "", days: str = "", money: str = "", times: str = ""):
    """Register a function of :class:`Tables` under ``name``, with its SQL.

    ``days``, ``times`` and ``money`` name the SQL columns to print as
    :func:`comparable` does.
    """

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_runtime_options(spark)
            tables = Tables(spark, folder)
            size_for_input(spark, 0)  # the session's own sizes; reading a table adjusts them
            return comparable(build(tables))

        QUERIES[name] = run
        if sql is not None:
            body = with_ctes(sql, ctes.split())
            swaps = [f"CAST({c} AS VARCHAR) AS {c}" for c in days.split()]
            swaps += [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
            swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times.split()]
            ORACLES[name] = f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({body})" if swaps else body
        return build

    return register

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.session import scratch_table

WORD = "[^\\x20\\x09-\\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    Cuts the lineage: what is computed from the result again and again (rounds
    of a loop, two branches of a plan) reads files that outlive executors.
    """
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def replace(df: DataFrame, new: dict[str, Column], keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the columns ``new`` added; an input column of the same name gives way."""
    names = {n.lower() for n in new}
    kept = [col(c) for c in (keep or df.columns) if c.lower() not in names]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def ranges(df: DataFrame, key: str, wanted: int) -> list[int]:
    """Ascending cuts that split the whole numbers ``key`` into about ``wanted`` equal ranges.

    One pass over the key alone.  The cuts, fewer than ``wanted``, are all the
    driver sees.
    """
    if wanted < 2:
        return []
    shares = [i / wanted for i in range(1, wanted)]
    cuts = df.agg(F.percentile_approx(col(key), F.array(*map(F.lit, shares)), F.lit(max(10_000, 10 * wanted)))).first()[0]
    return sorted({float(c): c for c in cuts or []}.values())  # apart as doubles too


def with_range(df: DataFrame, key: str, cuts: list[int], out: str) -> DataFrame:
    """``df`` with the index of the range that ``key`` falls in: the number of cuts not above it.

    A binary search in the JVM.  Null keys come first.
    """
    if not cuts:
        return df.withColumn(out, F.lit(0))
    number = fresh(df, "range_key")
    given = df.withColumn(number, F.coalesce(col(key).cast("double"), F.lit(float("-inf"))))
    search = Bucketizer(splits=[float("-inf"), *map(float, cuts), float("inf")], inputCol=number, outputCol=out)
    return search.transform(given).withColumn(out, F.col(out).cast("int")).drop(number)


def per_process(key: Any, make: Callable[[], Any]) -> Any:
    """A value made once in a Python worker and found again by its later tasks (vocabularies, compiled tables).

    A worker holds one value.  It lives on from job to job; when a task of another stage asks for another one, the old
    value goes, so a run of several stages needs the memory of the largest, not of all.
    """
    shelf = sys.modules.setdefault("daymill_worker_shelf", types.ModuleType("daymill_worker_shelf"))
    values = shelf.__dict__.setdefault("values", {})
    if key not in values:
        if values:
            values.clear()
            give_back()
        values[key] = make()
    return values[key]


def give_back() -> None:
    """Freed memory goes back to the system, not only to this worker; a C library that cannot do so keeps it."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


class Remembered(dict):
    """Values of ``make`` by argument, in two generations of up to ``most`` / 2.

    When the young one is full it becomes the old one; what is asked for again comes back from there.  Long arguments
    are not kept.
    """

    def __init__(self, make: Callable[[str], Any], most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most // 2, longest, {}

    def __missing__(self, argument: str) -> Any:
        value = self.old.get(argument)
        if value is None:
            value = self.make(argument)
        if len(argument) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[argument] = value
        return value


def packed_lists(packed: list[bytes]) -> pa.ListArray:
    """Little-endian 32-bit numbers as a list of ints for each row."""
    ends = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` by position, so that any column name will do, dots included."""
    names = [f"c{i}" for i in range(len(schema.fields))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    plain = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema.fields)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(renamed, plain).toDF(*schema.names)

"""Change feed of a database table, kept as base and delta files by hash bucket of the key.

Layout below the table's path::

    delta/version=<v>/bucket=<b>   last change of each key that version v brought
    base/version=<v>/bucket=<b>    a bucket's base and deltas folded into one
    manifest/version=<v>           what is live after v: for each bucket its base and its open deltas

A batch makes a version.  It writes the changes of the buckets it touches as deltas; a touched bucket that has
``open_deltas`` of them is folded into a new base in the same batch, so there is nothing to stop for.  Readers take the
live files of the newest manifest: as many per bucket as may be open, however many batches there were.  The manifest is
one file, written last: a batch that fails before it has changed nothing, and one that runs again writes the same version
again.  Files that no manifest kept refers to are removed a version later, so a reader that has begun can go on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from daymill.operators.history import latest_per_key
from daymill.sources import folders
from daymill.streaming.defaults import stream_defaults

#: Hash buckets of a new table, deltas of a bucket that are folded into its base, manifests kept.
BUCKETS, OPEN_DELTAS, KEPT_VERSIONS = 16, 8, 2
MANIFEST = "buckets int, writer string, batch long, bucket int, base long, deltas array<long>, version long"


def envelope_schema(row: T.StructType, position: str = "pos") -> T.StructType:
    """JSON envelope: row before and after, operation, position in the source log, time."""
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField(position, T.LongType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def read_envelopes(df: DataFrame, text: str, row: T.StructType, position: str = "pos") -> DataFrame:
    """One row per change: columns of the new row (of the old one for a delete), ``op`` and position.

    Operations: ``r`` row of the initial snapshot, ``c`` insert, ``u`` update,
    ``d`` delete.
    """
    parsed = df.select(F.from_json(text, envelope_schema(row, position)).alias("e"))
    image = F.when(F.col("e.op") == "d", F.col("e.before")).otherwise(F.col("e.after"))
    return parsed.where(image.isNotNull()).select(
        *[image[f.name].alias(f.name) for f in row.fields], F.col("e.op").alias("op"), F.col(f"e.{position}").alias(position)
    )


def broken_envelopes(df: DataFrame, text: str, row: T.StructType, key: str, position: str = "pos") -> DataFrame:
    """Texts that give no change: not JSON of the envelope, without the row image of their operation, or without a key."""
    parsed = df.withColumn("__e", F.from_json(text, envelope_schema(row, position)))
    image = F.when(F.col("__e.op") == "d", F.col("__e.before")).otherwise(F.col("__e.after"))
    return parsed.where(image.isNull() | image[key].isNull()).select(text)


def state_schema(row: T.StructType, position: str = "pos") -> T.StructType:
    return T.StructType([*row.fields, T.StructField("op", T.StringType()), T.StructField(position, T.LongType())])


@dataclass
class Manifest:
    """What is live after a version; ``live`` gives each bucket's base (or none) and open deltas."""

    version: int
    buckets: int
    writer: str | None
    batch: int | None
    live: dict[int, tuple[int | None, list[int]]]

    def files(self, path: str, only: set[int] | None = None) -> list[str]:
        """Folders of the live files, of all buckets or of some."""
        out = []
        for bucket, (base, deltas) in sorted(self.live.items()):
            if only is None or bucket in only:
                out += [f"{path}/base/version={base}/bucket={bucket}"] if base is not None else []
                out += [f"{path}/delta/version={d}/bucket={bucket}" for d in deltas]
        return out


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(v) for v in folders.partition_values(spark, f"{path}/manifest", "version"))


def read_manifest(spark: SparkSession, path: str, below: int | None = None) -> Manifest | None:
    """The newest manifest, or the newest one older than version ``below``; none of a table not yet written."""
    for version in reversed(_versions(spark, path)):
        if below is None or version < below:
            rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={version}").collect()  # a row per bucket
            if rows:  # a folder without its file is a batch that failed
                live = {r.bucket: (r.base, list(r.deltas)) for r in rows if r.bucket is not None}
                return Manifest(version, rows[0].buckets, rows[0].writer, rows[0].batch, live)
    return None


def _write_manifest(spark: SparkSession, path: str, made: Manifest) -> None:
    head = (made.buckets, made.writer, made.batch)
    rows = [(*head, None, None, [])] + [(*head, b, base, deltas) for b, (base, deltas) in sorted(made.live.items())]
    fields = MANIFEST.rsplit(",", 1)[0]
    spark.createDataFrame(rows, fields).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={made.version}")


def _read_files(spark: SparkSession, files: list[str], row: T.StructType, position: str) -> DataFrame:
    schema = state_schema(row, position)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def _write_buckets(df: DataFrame, path: str) -> None:
    df.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def merge_batch(
    changes: DataFrame, path: str, row: T.StructType, key: str, batch: int, writer: str, position: str = "pos",
    buckets: int = BUCKETS, open_deltas: int = OPEN_DELTAS, on_step: Callable[[str], None] | None = None,
) -> None:
    """Adds one batch of ``changes`` (columns of ``row``, ``op`` and ``position``) to the table.

    ``writer`` and ``batch`` name the batch: given again, it replaces the version it made.  A table keeps the number
    of buckets it was made with.  ``on_step`` is called after each step, for tests of failures.
    """
    spark = changes.sparkSession
    done = on_step or (lambda step: None)
    columns = [f.name for f in row.fields if f.name != key] + ["op", position]
    before = read_manifest(spark, path)
    if before is not None and (before.writer, before.batch) == (writer, batch):
        version = before.version
        before = read_manifest(spark, path, version)
    else:
        version = before.version + 1 if before else 0
    count = before.buckets if before else buckets
    live = dict(before.live) if before else {}

    folded = latest_per_key(changes.where(F.col(key).isNotNull()), key, columns, position)
    delta = f"{path}/delta/version={version}"
    _write_buckets(folded.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(count)).cast("int")), delta)
    done("delta")
    touched = {int(b) for b in folders.partition_values(spark, delta, "bucket")}
    for b in touched:
        base, deltas = live.get(b, (None, []))
        live[b] = (base, [*deltas, version])
    made = Manifest(version, count, writer, batch, live)
    full = {b for b in touched if len(live[b][1]) >= open_deltas}
    if full:
        rows = _read_files(spark, made.files(path, full), row, position)
        whole = latest_per_key(rows, key, columns, position)
        _write_buckets(whole.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(count)).cast("int")), f"{path}/base/version={version}")
        made.live |= {b: (version, []) for b in full}
    done("base")
    _write_manifest(spark, path, made)
    done("manifest")
    _remove_unused(spark, path)


def _remove_unused(spark: SparkSession, path: str) -> None:
    """Removes old manifests and the files that none of the kept ones names; what is left by a failure is found next time."""
    versions = _versions(spark, path)
    kept = [m for m in (read_manifest(spark, path, v + 1) for v in versions[-KEPT_VERSIONS:]) if m]
    used = {f for m in kept for f in m.files(path)}
    for kind in ("base", "delta"):
        for version in folders.partition_values(spark, f"{path}/{kind}", "version"):
            folder = f"{path}/{kind}/version={version}"
            if int(version) > versions[-1]:
                continue
            inside = [f"{folder}/{n}" for n in folders.names(spark, folder)]
            for f in inside:
                if f not in used:
                    folders.remove(spark, f)
            if not used & set(inside):
                folders.remove(spark, folder)
    for version in versions[:-KEPT_VERSIONS]:
        folders.remove(spark, f"{path}/manifest/version={version}")


def apply_changes(
    envelopes: DataFrame, text: str, row: T.StructType, key: str, path: str, checkpoint: str, drain: bool = False,
    position: str = "pos", buckets: int = BUCKETS, open_deltas: int = OPEN_DELTAS,
) -> DataStreamWriter:
    """Merge each micro-batch of a change feed into the table at ``path``, see :func:`merge_batch`.

    A change counts if its position is the highest of its key, whenever it arrives; deleted keys stay as rows with
    ``op = 'd'`` so that an older update cannot bring them back.  Envelopes that give no change are kept as text below
    ``<path>_broken``, in a folder for each batch that a repeated batch replaces.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        broken = broken_envelopes(batch, text, row, key, position).withColumn("batch", F.lit(batch_id))
        dynamic = broken.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        dynamic.partitionBy("batch").parquet(f"{path}_broken")
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        merge_batch(read_envelopes(batch, text, row, position), path, row, key, batch_id, stream, position, buckets, open_deltas)

    return stream_defaults(envelopes.writeStream.foreachBatch(store), checkpoint, drain)


def folded_state(spark: SparkSession, path: str, row: T.StructType, key: str, position: str = "pos") -> DataFrame:
    """Last change of every key in the live files, deletes included; empty if nothing was written yet."""
    columns = [f.name for f in row.fields if f.name != key]
    newest = read_manifest(spark, path)
    stored = _read_files(spark, newest.files(path) if newest else [], row, position)
    return latest_per_key(stored, key, [*columns, "op", position], position)


def current_state(spark: SparkSession, path: str, row: T.StructType, key: str, position: str = "pos") -> DataFrame:
    """Rows that exist now."""
    state = folded_state(spark, path, row, key, position)
    return state.where(F.col("op") != "d").select([f.name for f in row.fields])

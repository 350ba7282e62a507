"""Text files: tab-separated raw tables, quoted CSV exports, JSON lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
#: No character quotes a field: what would end one is written as an escape, so a row is a line and files can be split.
RAW_OPTIONS = {"sep": "\t", "nullValue": "NULL", "emptyValue": "\\e", "quote": "\0", "escape": "\0", "header": "true", "encoding": "UTF-8"}
#: Characters of a text and how they are written; the backslash comes first.
ESCAPES = [("\\", "\\\\"), ("\0", "\\0"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    # A text that reads NULL is not null; an empty one, and spaces at the ends, stay.
    front, back = (F.when(ends, "\\s").otherwise("") for ends in (text.startswith(" "), text.endswith(" ")))
    return F.when(text == "NULL", "\\NULL").when(text == "", "\\e").otherwise(F.concat(front, text, back))


def _plain(text: Column) -> Column:
    def piece(part: Column) -> Column:  # between written backslashes, so each backslash here begins an escape
        for mark in ("\\e", "\\s"):
            part = F.replace(part, F.lit(mark), F.lit(""))
        part = F.replace(part, F.lit("\\NULL"), F.lit("NULL"))
        for plain, written in ESCAPES[1:]:
            part = F.replace(part, F.lit(written), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), piece), "\\")


def read_raw_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated raw text with a header line, ``NULL`` for null and backslash escapes in texts."""
    rows = spark.read.schema(schema).options(**RAW_OPTIONS).csv(path)
    return rows.withColumns({c: _plain(F.col(f"`{c}`")) for c in _texts(rows)})


def write_raw_table(df: DataFrame, path: str) -> None:
    """Counterpart of :func:`read_raw_table`; compressed so that readers can split a file."""
    rows = df.withColumns({c: _escaped(F.col(f"`{c}`")) for c in _texts(df)})
    rows.write.mode("overwrite").options(**RAW_OPTIONS).option("compression", "bzip2").csv(path)


def export_csv(df: DataFrame, path: str, partition_filter: str | None = None) -> None:
    """Quoted UTF-8 CSV with a header, one file per task, optionally filtered."""
    rows = df.where(partition_filter) if partition_filter else df
    rows.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads what :func:`export_csv` writes, line breaks inside a quoted text included."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true").csv(path)


def export_tables(tables: Mapping[str, DataFrame], root: str, filters: Mapping[str, str] | None = None) -> dict:
    """Export several tables; the error of a failed one is returned, the rest go on."""
    failed = {}
    for name, df in tables.items():
        try:
            export_csv(df, f"{root}/{name}", (filters or {}).get(name))
        except Exception as error:  # one bad table must not stop the others
            failed[name] = str(error)
    return failed


def rows_from_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a JSON-lines file; lines that are not JSON are kept in ``_bad_line`` if the schema names it."""
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_bad_line").json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)

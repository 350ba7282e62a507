"""Target schemas from a source column catalogue, and partitioned tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.session import file_sizes
from daymill.sources.partitions import conform_to_table

# --- fixed values: source column type to warehouse type ---
SOURCE_TYPES = {
    "varchar": "string",
    "char": "string",
    "text": "string",
    "longtext": "string",
    "mediumtext": "string",
    "tinytext": "string",
    "tinyint": "tinyint",
    "smallint": "smallint",
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "tinyint(1)": "boolean",
    "date": "date",
    "datetime": "timestamp",
    "timestamp": "timestamp",
    "time": "string",
    "year": "int",
    "blob": "binary",
    "longblob": "binary",
    "mediumblob": "binary",
    "tinyblob": "binary",
    "binary": "binary",
    "varbinary": "binary",
}


def sync_schema(catalogue: DataFrame, day_column: str = "dt") -> DataFrame:
    """Warehouse type of each source column, from rows of a column catalogue.

    Input: table_name, column_name, ordinal, column_type (such as
    ``decimal(10,2)``), comment.  A source column named like the day column
    is left out because the table gets its own.
    """
    full = F.lower(F.col("column_type"))
    base = F.regexp_extract(full, "^([a-z]+)", 1)
    table = F.create_map(*[F.lit(x) for pair in SOURCE_TYPES.items() for x in pair])
    precision = F.regexp_extract(full, r"^decimal(\(\d+,\s*\d+\))", 1)
    decimal = F.when(precision != "", F.concat(F.lit("decimal"), F.regexp_replace(precision, r"\s", ""))).otherwise(
        F.lit("decimal(10,0)")
    )
    warehouse = F.when(base == "decimal", decimal).otherwise(
        F.coalesce(F.try_element_at(table, full), F.try_element_at(table, base), F.lit("string"))
    )
    return catalogue.where(F.col("column_name") != day_column).withColumn("warehouse_type", warehouse)


def target_schema(catalogue: DataFrame, table: str, day_column: str = "dt") -> T.StructType:
    """Schema of one table, with comments; reads only the catalogue rows of that table."""
    rows = sync_schema(catalogue, day_column).where(F.col("table_name") == table).orderBy("ordinal")
    schema = T.StructType()
    for row in rows.toLocalIterator():  # columns of one table, never data
        kind = T.StructType.fromDDL(f"c {row['warehouse_type']}")["c"].dataType
        schema.add(T.StructField(row["column_name"], kind, True, {"comment": row["comment"] or ""}))
    return schema


def catalogue_of(frames: Mapping[str, DataFrame]) -> list[tuple[str, str, int, str, str]]:
    """Catalogue rows of loaded frames: table, column, position, type, comment."""
    return [
        (table, field.name, position, field.dataType.simpleString(), field.metadata.get("comment", ""))
        for table, frame in frames.items()
        for position, field in enumerate(frame.schema.fields, 1)
    ]


def table_ddl(table: str, schema: T.StructType, location: str, day_column: str = "dt", fmt: str = "orc") -> str:
    """Partitioned table over an external folder, snappy-compressed, column comments kept."""
    lines = []
    for field in schema.fields:
        comment = field.metadata.get("comment", "").replace("'", "\\'")
        lines.append(f"  `{field.name}` {field.dataType.simpleString()}" + (f" COMMENT '{comment}'" if comment else ""))
    lines.append(f"  `{day_column}` date")
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n" + ",\n".join(lines) + f"\n) USING {fmt}\n"
        f"PARTITIONED BY (`{day_column}`)\nLOCATION '{location}'\nTBLPROPERTIES ('{fmt}.compress'='SNAPPY')"
    )


def create_day_table(
    spark: SparkSession, table: str, schema: T.StructType, location: str, day_column: str = "dt", fmt: str = "orc"
) -> None:
    spark.sql(table_ddl(table, schema, location, day_column, fmt))


def write_day_table(df: DataFrame, table: str) -> None:
    """Replaces in the catalogue table ``table`` the days that ``df`` holds; columns are taken by name and cast.

    New days are registered in the catalogue with the write.
    """
    spark = df.sparkSession
    target = conform_to_table(df, spark.table(table).schema)
    days = [p.name for p in spark.catalog.listColumns(table) if p.isPartition]
    with file_sizes(spark):
        target.hint("rebalance", *[F.col(d) for d in days]).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def table_days(spark: SparkSession, table: str) -> list[str]:
    """Values of the partitions that the catalogue knows of a table by day."""
    return sorted(r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())

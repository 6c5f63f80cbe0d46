"""Parquet tables under a path: create, read, append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline import schemas


def table_schema(table: str | T.StructType) -> T.StructType:
    return schemas.TABLES[table] if isinstance(table, str) else table


def ensure_table(
    spark: SparkSession, path: str, table: str | T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Creates an empty table unless there is one."""
    empty = spark.createDataFrame([], table_schema(table))
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, table: str | T.StructType) -> DataFrame:
    """The table under its declared schema; partition columns included."""
    return spark.read.schema(table_schema(table)).parquet(path)


def with_day(df: DataFrame, ts: str = "timestamp", name: str = "day") -> DataFrame:
    """The partition column of the hourly tables: the UTC day, a function of the key."""
    return df.withColumn(name, F.to_date(ts))


def append_log(
    df: DataFrame, path: str, date_of: str, partition_column: str = "date", dry_run: bool = False
) -> DataFrame:
    """Appends audit rows under a date partition taken from `date_of`; returns what was appended."""
    rows = df.withColumn(partition_column, F.to_date(date_of))
    if not dry_run:
        rows.write.mode("append").partitionBy(partition_column).parquet(path)
    return rows


def append_evolving(df: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Appends rows that may bring new columns; read them back with `read_evolving`."""
    if not dry_run:
        df.write.mode("append").parquet(path)
    return df


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Every column any append ever wrote; NULL where a row is older than the column."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def union_evolving(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def ingestion_record(
    quality: DataFrame, run_id: str, run_date: Column, files_found: int, files_missing: int,
    written_at: Column, schema_errors: Column | None = None, dry_run: bool = False,
) -> DataFrame:
    """Audit row of a load run from its one-row quality counts."""
    return quality.select(
        F.lit(run_id).alias("run_id"), run_date.alias("run_date"),
        F.lit(files_found).alias("files_found"), F.lit(files_missing).alias("files_missing"),
        F.col("rows").alias("rows_ingested"), F.col("nulls").alias("null_count"),
        (F.lit(0) if schema_errors is None else schema_errors).cast("bigint").alias("schema_errors"),
        F.lit(dry_run).alias("dry_run"), written_at.alias("written_at"),
    )

"""The landing folder: one JSON array per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.functions.scalar import as_time, file_hour

CORRUPT = "_corrupt_record"


def read_landing(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, keep_bad: bool = False
) -> DataFrame:
    """Rows of the landing files under the declared schema; no paths give an empty frame.

    Bad records come out as NULL rows; `keep_bad` adds their text as `_corrupt_record`, to be counted.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)]) if keep_bad else schema
    names = [paths] if isinstance(paths, str) else list(paths)
    if not names:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE")
    if keep_bad:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(names)


def present_files(spark: SparkSession, directory: str) -> DataFrame:
    """Names in the landing folder. Only the listing is read, never the contents."""
    try:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(directory)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "file_name string, path string")
    return listing.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")


def expected_hours(spark: SparkSession, run_date, lookback: int) -> DataFrame:
    """The last `lookback` hours up to the run's, with the name of each one's file."""
    newest = F.date_trunc("hour", as_time(run_date))
    hours = spark.range(0, lookback, 1, 1).select(
        F.timestamp_add("HOUR", -F.col("id"), newest).alias("timestamp")
    )
    return hours.withColumn("file_name", file_hour("timestamp"))


def expected_hours_of(series: DataFrame, run_date, lookback: int) -> DataFrame:
    """`expected_hours` of every row of `series`, a row per series."""
    newest = F.date_trunc("hour", as_time(run_date))
    back = F.explode(F.sequence(F.lit(0), F.lit(lookback - 1))).alias("__back")
    hours = series.select("*", back).withColumn("timestamp", F.timestamp_add("HOUR", -F.col("__back"), newest)).drop("__back")
    return hours.withColumn("file_name", file_hour("timestamp"))


def write_hourly(rows: DataFrame, directory: str) -> None:
    """One JSON file for each hour, named by the column `file_name`. Tasks write the files, one for each name; the driver only
    moves each to its name, so a call is for as many hours as a run lands."""
    spark = rows.sparkSession
    rows.withColumn("file", F.col("file_name")).repartition("file").write.mode("overwrite").partitionBy("file").json(f"{directory}/.new")
    path = spark._jvm.org.apache.hadoop.fs.Path
    place = path(f"{directory}/.new")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{directory}/.new/file=*/part-*")):
        fs.rename(status.getPath(), path(f"{directory}/{status.getPath().getParent().getName().removeprefix('file=')}"))
    fs.delete(place, True)


def read_hourly(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The rows of the named hourly files."""
    return spark.read.schema("series_id string, timestamp timestamp, value double, file_name string").json(list(paths))


def expected_files(spark: SparkSession, run_date, lookback: int, directory: str) -> DataFrame:
    """The expected hours with the path of their file, each `found` or not."""
    present = present_files(spark, directory)
    return expected_hours(spark, run_date, lookback).join(present, "file_name", "left").withColumn(
        "found", F.col("path").isNotNull()
    )


def found_paths(expected: DataFrame, done: DataFrame | None = None) -> list[str]:
    """Paths to read: found, and not in the ledger of processed files. At most the lookback many."""
    todo = expected.filter("found")
    if done is not None:
        todo = todo.join(done.select("file_name"), "file_name", "left_anti")
    return [r["path"] for r in todo.select("path").collect()]


def mark_processed(expected: DataFrame, ledger: str, processed_at) -> None:
    """Adds the found files to the ledger, so that a later batch leaves them out."""
    rows = expected.filter("found").select("file_name", as_time(processed_at).alias("processed_at"))
    rows.write.mode("append").parquet(ledger)

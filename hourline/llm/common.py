"""Ordering, ranking and scratch tables shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourline.session import scratch_path, use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """The session with times in UTC and with this package sent to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        packed = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(packed)  # the driver serves it; nobody else reads this folder
        _shipped.add(app)
    return use_utc(spark)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(ready(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame as a table in the shared folder, and where it is."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, group: list[str], order: list[Column], values: dict[str, Column], name: str) -> DataFrame:
    """Adds, for each value, `<value>__before` (its sum over the earlier rows of the group, 0 at the first)
    and `<value>__all` (its sum over the group), in any size of group.

    Rows are range-partitioned by group and order, so a hot group spreads over tasks; each part sums on
    its own, and the parts' totals, a few rows per part, shift them. `group` columns must not be NULL.
    """
    laid = (
        df.withColumns(values)
        .repartitionByRange(partitions(df.sparkSession), *[F.col(g) for g in group], *order)
        .withColumn("__part", F.spark_partition_id())
    )
    earlier = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    laid, _ = stored(
        laid.withColumns({f"{v}__in": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values}), name
    )
    parts = laid.groupBy("__part", *group).agg(*[F.sum(v).alias(f"{v}__sum") for v in values])
    by_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = by_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        "__part", *group,
        *[F.coalesce(F.sum(f"{v}__sum").over(before), F.lit(0)).alias(f"{v}__shift") for v in values],
        *[F.sum(f"{v}__sum").over(by_group).alias(f"{v}__all") for v in values],
    )
    out = laid.join(shifts, ["__part", *group])
    out = out.withColumns({f"{v}__before": F.col(f"{v}__shift") + F.col(f"{v}__in") for v in values})
    return out.drop("__part", *[f"{v}__{x}" for v in values for x in ("in", "shift")])


def as_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def once(df: DataFrame, marks: dict[str, Column], key: str) -> DataFrame:
    """`df` with `__key` and the marks, one row of each such combination. Rows that repeat are cut to one
    per task before they are shuffled."""
    same = Window.partitionBy("__key", *marks).orderBy(F.lit(0))
    marked = df.withColumns(marks | {"__key": as_text(key)})
    return marked.withColumn("__nth", F.row_number().over(same)).where("__nth = 1").drop("__nth")


def keep_rows(df: DataFrame, chosen: DataFrame, marks: dict[str, Column], key: str) -> DataFrame:
    """The rows of `df` whose key and marks are in `chosen` (key, *marks), one of each such pair."""
    wanted = chosen.select(as_text(key).alias("__key"), *marks)
    return once(df, marks, key).join(wanted, ["__key", *marks], "left_semi").select(*df.columns)

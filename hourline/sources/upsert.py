"""Upserts as DataFrame plans, and their publication into a partitioned parquet table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourline.session import scratch_path
from hourline.sources.tables import ensure_table, read_table

CHANGE = "_change"
LITERAL_PARTITIONS = 1000


def _unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fails when two source rows share a key: which of them wins would be chance."""
    # Numbering needs no memory, however often a key is repeated, and sorts as the join does anyway.
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    ok = F.when(nth == 1, True).otherwise(
        F.raise_error(F.lit("several source rows share a key; deduplicate them first")).cast("boolean")
    )
    return source.withColumn("__ok", ok).filter("__ok").drop("__ok")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: str | Sequence[str] | None = "all",
    when: Column | str | None = None,
    unique: bool = True,
) -> DataFrame:
    """The target after the source is merged in, with `_change` (`insert`, `update` or `keep`) per row.

    update  "all", a list of columns, or None for insert-only
    when    condition on the source row; a matched row changes only where it holds

    One full outer join on the key; insert-only needs just an anti join.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    if unique:
        source = _unique(source, keys)
    if update is None:
        fresh = source.select(*target.columns).join(target.select(*keys), keys, "left_anti")
        return target.withColumn(CHANGE, F.lit("keep")).unionByName(fresh.withColumn(CHANGE, F.lit("insert")))
    changed = set(rest if update == "all" else update)
    holds = F.lit(True) if when is None else F.coalesce(F.expr(when) if isinstance(when, str) else when, F.lit(False))
    new = source.select(*keys, F.struct(*rest).alias("__s"), holds.alias("__when"))
    old = target.select(*keys, F.struct(*rest).alias("__t"))
    joined = old.join(new, keys, "full_outer")
    inserted = F.col("__t").isNull()
    updated = F.col("__s").isNotNull() & F.col("__when")

    def merged(c: str) -> Column:
        take = inserted | updated if c in changed else inserted
        return F.when(take, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c)

    change = F.when(inserted, "insert").when(updated, "update").otherwise("keep").alias(CHANGE)
    columns = [F.col(c) if c in keys else merged(c) for c in target.columns]
    return joined.select(*columns, change)


def fill_from(
    target: DataFrame, source: DataFrame, on: Sequence[str], column: str, from_column: str, flag: str | None = None
) -> DataFrame:
    """Fills the NULLs of a target column from the matching source rows that have a value."""
    side = source.filter(F.col(from_column).isNotNull()).select(*on, F.col(from_column).alias("__fill"))
    joined = target.join(side, list(on), "left")
    filled = F.col(column).isNull() & F.col("__fill").isNotNull()
    sets = {column: F.coalesce(F.col(column), F.col("__fill"))}
    if flag:
        sets[flag] = F.col(flag) | filled
    change = F.when(filled, "update").otherwise("keep")
    return joined.withColumns({CHANGE: change} | sets).select(*target.columns, CHANGE)


def update_where(
    df: DataFrame, decisions: DataFrame, on: Mapping[str, str] | Sequence[str], sets: Mapping[str, Column]
) -> DataFrame:
    """Sets columns of the rows that some decision names: one join, however many decisions.

    `on` maps columns of `df` to columns of `decisions`; `sets` are expressions over `df`.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    named = decisions.select(*[F.col(d).alias(c) for c, d in pairs.items()]).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(named, list(pairs), "left")
    hit = F.col("__hit").isNotNull()
    changed = {c: F.when(hit, value).otherwise(F.col(c)) for c, value in sets.items()}
    return joined.withColumns(changed).select(*df.columns)


def change_counts(merged: DataFrame) -> DataFrame:
    """Rows inserted, updated and kept, counted in one partial aggregation."""
    change = F.col(CHANGE)
    return merged.agg(
        F.count_if(change == "insert").alias("rows_inserted"),
        F.count_if(change == "update").alias("rows_updated"),
        F.count_if(change == "keep").alias("rows_kept"),
    )


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level difference of two versions: `insert`, `delete`, `update_pre` and `update_post` rows."""
    keys = list(keys)
    rest = [c for c in old.columns if c not in keys]
    before = old.select(*keys, F.struct(*rest).alias("__o"))
    after = new.select(*keys, F.struct(*rest).alias("__n"))
    o, n = F.col("__o"), F.col("__n")

    def row(kind: str, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("change"), side.alias("row"))

    images = (
        F.when(o.isNull(), F.array(row("insert", n)))
        .when(n.isNull(), F.array(row("delete", o)))
        .otherwise(F.array(row("update_pre", o), row("update_post", n)))
    )
    return (
        before.join(after, keys, "full_outer")
        .filter(~o.eqNullSafe(n))
        .select(*keys, F.explode(images).alias("__e"))
        .select(*keys, *[F.col(f"__e.row.{c}").alias(c) for c in rest], F.col("__e.change").alias("change"))
    )


def touched(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the target partitions that the source writes to.

    A few partition values become literals, which prune directories; more of them become a semi join.
    """
    parts = source.select(*partition_by).distinct()
    values = parts.limit(LITERAL_PARTITIONS + 1).collect()
    if len(values) > LITERAL_PARTITIONS:
        return target.join(parts, list(partition_by), "left_semi")
    if not values:
        return target.filter(F.lit(False))
    each = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v[c])) for c in partition_by]) for v in values]
    if len(partition_by) == 1 and all(v[0] is not None for v in values):
        return target.filter(F.col(partition_by[0]).isin([v[0] for v in values]))
    return target.filter(reduce(or_, each))


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to the path was committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def publish(spark: SparkSession, staged: str, path: str, partition_by: Sequence[str], sort_by: Sequence[str]) -> None:
    """Replaces the partitions present in the staged data. Running it again gives the same table."""
    rows = spark.read.parquet(staged).drop(CHANGE)
    # Rebalancing splits a large partition over several files and packs small ones together.
    shaped = rows.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
    (
        shaped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def merge_into(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    update: str | Sequence[str] | None = "all",
    when: Column | str | None = None,
    dry_run: bool = False,
    staged: str | None = None,
) -> DataFrame:
    """Merges the source into the table at `path` and returns the counters.

    The partition columns must be functions of the key, so a row never moves between partitions. Only
    touched partitions are rewritten. The merged rows are staged first, so what is published, and
    counted, is a finished copy. Publishing replaces partitions one by one; a crash in the middle
    leaves the table half replaced. Name `staged` per batch, and the rerun of that batch publishes the
    finished copy again instead of merging into such a table.
    """
    spark = source.sparkSession
    if dry_run or staged is None or not is_finished(spark, staged):
        ensure_table(spark, path, source.schema, partition_by)
        target = read_table(spark, path, source.schema)
        merged = upsert(touched(target, source, partition_by), source, [*partition_by, *keys], update, when)
        if dry_run:
            return change_counts(merged)
        staged = staged or scratch_path(spark, "staged")
        merged.write.mode("overwrite").parquet(staged)
    publish(spark, staged, path, partition_by, keys)
    return change_counts(spark.read.parquet(staged))

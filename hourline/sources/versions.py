"""Versioned tables: every write is a new version that appears at once, and readers keep the one they opened.

    <path>/data/<partition>/batch=<id>/     rows of one write in one partition, never changed
    <path>/versions/<number>.json           which batch holds each partition in that version, and what the write changed

A write puts its rows under a new batch name, where nobody looks, and then renames one finished manifest to the next
number. The rename is the commit: before it readers see the old version, after it the new one, never a mixture. A
name that is taken means that somebody else has committed meanwhile; a write whose partitions nobody
touched goes on top of it, any other is worked out again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.session import written
from hourline.sources.tables import table_schema
from hourline.sources.upsert import CHANGE, change_counts, changes, touched, upsert

ATTEMPTS = 10


class Conflict(RuntimeError):
    """Another write changed the same partitions, again and again."""


@dataclass(frozen=True)
class Version:
    """`parts` names the batch of each partition folder; `changed` are the folders this version wrote; `batches`
    the newest batch number of each writer that numbers its batches."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    changed: tuple[str, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _manifest(path: str, number: int) -> str:
    return f"{path}/versions/{number:019d}.json"


def current(spark: SparkSession, path: str) -> int:
    """The number of the newest version; 0 for a table that nothing was written to."""
    fs, place = _fs(spark, f"{path}/versions")
    if not fs.exists(place):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return max((int(n[:19]) for n in names if len(n) == 24 and n.endswith(".json") and n[:19].isdigit()), default=0)


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    number = current(spark, path) if number is None else number
    if number == 0:
        return Version()
    fs, place = _fs(spark, _manifest(path, number))
    stream = fs.open(place)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    found = json.loads(text)
    return Version(number, found["parts"], tuple(found["changed"]), found["batches"])


def _commit(spark: SparkSession, path: str, new: Version) -> bool:
    """Renames the finished manifest to its number; False if that number is taken."""
    fs, final = _fs(spark, _manifest(path, new.number))
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions/.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(json.dumps({"parts": new.parts, "changed": new.changed, "batches": new.batches}).encode())
    stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
    except Exception as e:  # noqa: BLE001  a taken name is the one failure that is no failure
        if "FileAlreadyExists" not in str(e):
            raise
        fs.delete(draft, False)
        return False
    return True


def _stored_schema(table: str | T.StructType, partition_by: Sequence[str]) -> T.StructType:
    own = table_schema(table)
    kept = [f for f in own.fields if f.name not in partition_by]
    keys = [own[c] for c in partition_by]
    return T.StructType([*kept, T.StructField(CHANGE, T.StringType()), *keys, T.StructField("batch", T.StringType())])


def _rows(spark: SparkSession, path: str, table: str | T.StructType, partition_by: Sequence[str], folders: Sequence[str]) -> DataFrame:
    schema = _stored_schema(table, partition_by)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in folders])


def read_version(
    spark: SparkSession, path: str, table: str | T.StructType, partition_by: Sequence[str], number: int | None = None
) -> DataFrame:
    """The rows of a version, by default the newest now. Later writes do not show in it, however late it is run."""
    at = version(spark, path, number)
    rows = _rows(spark, path, table, partition_by, [f"{p}/batch={b}" for p, b in sorted(at.parts.items())])
    return rows.select(table_schema(table).fieldNames())


def _written_parts(spark: SparkSession, path: str, batch: str, depth: int) -> list[str]:
    """The partition folders that hold a batch. Their number is that of the partitions the write touched."""
    fs, pattern = _fs(spark, f"{path}/data/" + "*/" * depth + f"batch={batch}")
    found = fs.globStatus(pattern) or []
    return ["/".join(str(s.getPath()).split("/")[-1 - depth : -1]) for s in found]


def replace_parts(
    spark: SparkSession,
    path: str,
    build: Callable[[int], DataFrame | None],
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    writer: tuple[str, int] | None = None,
) -> Version:
    """Commits the rows that `build` makes of the version it is given as the new contents of their partitions.

    Rows carry `_change`. With `writer` (name, batch number) a batch that is committed already is not written again.
    """
    rebuilt = None
    for _ in range(ATTEMPTS):
        base = version(spark, path)
        if writer and base.batches.get(writer[0], -1) >= writer[1]:
            return base
        if rebuilt is None:
            seen, batch = base.number, uuid.uuid4().hex
            rows = build(seen)
            shaped = rows.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
            shaped.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy(*partition_by, "batch").parquet(f"{path}/data")
            rebuilt = _written_parts(spark, path, batch, len(partition_by))
            base = version(spark, path)
        if base.number > seen:
            between = {c for n in range(seen + 1, base.number + 1) for c in version(spark, path, n).changed}
            if between & set(rebuilt):
                rebuilt = None
                continue
            seen = base.number
        new = Version(
            base.number + 1, base.parts | dict.fromkeys(rebuilt, batch), tuple(sorted(rebuilt)),
            base.batches | ({writer[0]: writer[1]} if writer else {}),
        )
        if _commit(spark, path, new):
            return new
    raise Conflict(f"{path}: {ATTEMPTS} attempts met other writes to the same partitions")


def merge_version(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    update: str | Sequence[str] | None = "all",
    when: Column | str | None = None,
    dry_run: bool = False,
    writer: tuple[str, int] | None = None,
) -> DataFrame:
    """Merges the source into the versioned table at `path` and returns the counters of what was committed.

    The source is written once to the shared folder and read from there, also when the merge is worked out again. Only
    touched partitions are read and rewritten; partition columns must be functions of the key. A crash at any
    point leaves the newest version whole; what it left behind is removed by `expire`.
    """
    spark = source.sparkSession
    schema = source.schema
    staged = source if dry_run else written(source, "source")

    def build(number: int) -> DataFrame:
        target = read_version(spark, path, schema, partition_by, number)
        return upsert(touched(target, staged, partition_by), staged, [*partition_by, *keys], update, when)

    if dry_run:
        return change_counts(build(current(spark, path)))
    done = replace_parts(spark, path, build, partition_by, keys, writer)
    return change_counts(_rows(spark, path, schema, partition_by, [f"{p}/batch={done.parts[p]}" for p in done.changed]))


def refresh_version(
    path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str], settled: str, dry_run: bool = False,
) -> DataFrame:
    """Merges newer rows over those that are still open: rows whose `settled` column has a value stay as they are."""
    spark = source.sparkSession
    names = [c for c in source.columns if c not in (*keys, *partition_by)]
    on = [*partition_by, *keys]

    def build(number: int) -> DataFrame:
        target = touched(read_version(spark, path, source.schema, partition_by, number), staged, partition_by)
        closed = target.filter(F.col(settled).isNotNull()).select(*on, F.lit(True).alias("__closed"))
        marked = staged.join(closed, on, "left")
        return upsert(target, marked, on, names, F.col("__closed").isNull())

    staged = source if dry_run else written(source, "source")
    if dry_run:
        return change_counts(build(current(spark, path)))
    done = replace_parts(spark, path, build, partition_by, keys)
    return change_counts(_rows(spark, path, source.schema, partition_by, [f"{p}/batch={done.parts[p]}" for p in done.changed]))


def version_changes(
    spark: SparkSession, path: str, table: str | T.StructType, keys: Sequence[str], partition_by: Sequence[str], since: int, until: int | None = None
) -> DataFrame:
    """The change feed between two versions. Only partitions that some write in between changed are read."""
    until = current(spark, path) if until is None else until
    old, new = version(spark, path, since), version(spark, path, until)
    moved = sorted(p for p in old.parts.keys() | new.parts.keys() if old.parts.get(p) != new.parts.get(p))
    names = table_schema(table).fieldNames()
    side = lambda v: _rows(spark, path, table, partition_by, [f"{p}/batch={v.parts[p]}" for p in moved if p in v.parts]).select(names)
    return changes(side(old), side(new), [*partition_by, *keys])


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes manifests older than the newest `keep` versions and the batches that none of these uses, those of writes that
    failed too; returns how many batches went. Call it when no write is under way and no reader needs an older version."""
    newest = current(spark, path)
    if not newest:
        return 0
    kept = [version(spark, path, n) for n in range(max(1, newest - keep + 1), newest + 1)]
    used = {f"{p}/batch={b}" for v in kept for p, b in v.parts.items()}
    depth = next(iter(used)).count("/") if used else 1
    fs, pattern = _fs(spark, f"{path}/data/" + "*/" * depth + "batch=*")
    gone = 0
    for status in fs.globStatus(pattern) or []:
        if "/".join(str(status.getPath()).split("/")[-1 - depth :]) not in used:
            gone += bool(fs.delete(status.getPath(), True))
    for n in range(1, kept[0].number):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(_manifest(path, n)), False)
    return gone

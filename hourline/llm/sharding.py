"""Shards that each match the mixture of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import query, running, table

SEED = "shards"


def interleave(
    df: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: str = SEED,
) -> DataFrame:
    """Proportional stratified interleaving: `df` with `shard` (0 to shards - 1) and `slot` (0, 1, ... in it).

    Rows of a source are shuffled by a seeded digest of `key` and get the fraction (rank - 1/2) / rows;
    all rows sorted by that fraction are cut into shards whose counts differ by one at most, so each shard
    holds every source in its share, to within a row. A NULL source is a source of its own, a NULL key sorts
    as the text 'null'; rows with equal keys are ordered by `text_crc32` where there is one, else freely.
    An empty table gives no rows. All columns of `df` are kept, except that `shard` and `slot` are replaced.
    """
    tie = [F.col("text_crc32")] if "text_crc32" in df.columns else []
    named = df.drop("shard", "slot").withColumns({
        "__source": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")),
        "__draw": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))),
    })
    order = [F.col("__draw"), F.col(key), *tie]
    one = F.lit(1).cast("bigint")
    ranked = running(named, ["__source"], order, {"__n": one}, "shard-rank")
    ranked = ranked.withColumn("__fraction", (F.col("__n__before") + 0.5) / F.col("__n__all"))
    ranked = ranked.drop("__n", "__n__before", "__n__all")
    placed = running(ranked, [], [F.col("__fraction"), F.col("__source"), *order], {"__n": one}, "shard-place")
    shard = F.expr(f"(__n__before * {shards}L) div __n__all")
    first = F.expr(f"(((__n__before * {shards}L) div __n__all) * __n__all + {shards - 1}L) div {shards}L")
    return placed.withColumns({"shard": shard.cast("int"), "slot": F.col("__n__before") - first}).drop(
        "__source", "__draw", "__fraction", "__n", "__n__before", "__n__all"
    )


def write_shards(df: DataFrame, path: str, shards: int, rows_per_file: int = 1_000_000, **options: str) -> None:
    """The interleaved rows as one folder per shard; each file holds about `rows_per_file` consecutive slots, sorted,
    so that no task writes a whole shard. An empty table gives an empty folder."""
    slots = F.expr(f"slot div {rows_per_file}")
    interleave(df, shards, **options).repartition("shard", slots).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


@query("op9_sharding")
def op9(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return interleave(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )

"""Exact deduplication against a persistent index of digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline.llm.common import discard, keep_rows, partitions, query, stored, table

LEAST_BUCKETS = 64
DIGESTS_PER_BUCKET = 2_000_000  # about 150 MB, sorted by one task
HOT_SHARE = 1000


def text_digest(text: str = "text"):
    """SHA-256 of the UTF-8 text in lower-case hex; NULL counts as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


class DigestIndex:
    """A catalog table (digest, keep_id), bucketed and sorted by digest, that outlives the session.

    `absorb` takes new rows (id, digest): it aggregates them per digest, drops the digests already known
    by a sort-merge anti-join on the bucketing, and appends the rest. A digest keeps the id it came with:
    the largest of its first batch. NULL ids stay only where a digest has no other id. The first batch decides the number of
    buckets; `compact` merges the files of many appends and sizes the buckets anew.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None) -> None:
        self.spark, self.name, self.buckets = spark, name, buckets

    def exists(self) -> bool:
        catalog, following = self.spark.catalog, f"{self.name}__next"
        if not catalog.tableExists(self.name) and catalog.tableExists(following):  # a compaction ended before the rename
            self.spark.sql(f"ALTER TABLE {following} RENAME TO {self.name}")
        return catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def bucket_count(self) -> int | None:
        """The buckets of the table as it is, None where there is none."""
        if not self.exists():
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Num Buckets'").collect()
        return int(rows[0]["data_type"])

    def _sized(self, digests: int) -> int:
        return self.buckets or max(LEAST_BUCKETS, -(-digests // DIGESTS_PER_BUCKET))

    def _write(self, rows: DataFrame, buckets: int, name: str) -> None:
        (
            rows.repartition(buckets, "digest").write.mode("append").format("parquet")
            .bucketBy(buckets, "digest").sortBy("digest").saveAsTable(name)
        )

    def absorb(self, rows: DataFrame, key: str = "doc_id", digest: str = "digest") -> None:
        new = rows.groupBy(F.col(digest).alias("digest")).agg(F.max(key).alias("keep_id"))
        buckets = self.bucket_count()
        if buckets is None:
            buckets = self._sized(rows.count())
        else:
            new = new.join(self.read().hint("merge"), "digest", "left_anti")
        self._write(new, buckets, self.name)

    def compact(self) -> None:
        """One sorted file per bucket, and as many buckets as the index needs by now. A crash leaves either the old
        table or the finished new one, which `exists` puts in its place."""
        if not self.exists():
            return
        following = f"{self.name}__next"
        self.spark.sql(f"DROP TABLE IF EXISTS {following}")
        rows = self.read()
        self._write(rows, self._sized(rows.count()), following)
        self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(f"ALTER TABLE {following} RENAME TO {self.name}")

    def drop(self) -> None:
        for name in (self.name, f"{self.name}__next"):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if "." not in name:  # what a session that died with its catalog left of a table of this name
                discard(self.spark, f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{name}")


def admit(df: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` whose text the index did not know, one per text, the one with the largest key; the index knows them after.

    Which rows those are is read from the index itself, so a batch that is admitted again after a crash gives the same rows.
    Keys must not come again with other batches. NULL text counts as empty, a NULL key is smaller than any other; an empty table gives no rows.
    """
    rows, _ = stored(df.select(F.col(key).alias("doc_id"), text_digest(text).alias("digest")), "digests")
    index.absorb(rows)
    best = rows.groupBy("digest").agg(F.max("doc_id").alias("doc_id"))
    own = best.join(index.read(), "digest").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return keep_rows(df, own.select(F.col("doc_id").alias(key), F.col("digest").alias("__digest")), {"__digest": text_digest(text)}, key)


def _cuts(rows: DataFrame, batches: int) -> list:
    """Keys that divide the rows into about `batches` equal ranges, descending; the driver gets a row per shuffle partition."""
    laid = rows.select("doc_id").repartitionByRange(partitions(rows.sparkSession), "doc_id").withColumn("part", F.spark_partition_id())
    parts = laid.groupBy("part").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    total, done, cuts = sum(p["n"] for p in parts), 0, set()
    for part in parts:
        if done * batches // max(total, 1) != (done + part["n"]) * batches // max(total, 1) and done and part["first"] is not None:
            cuts.add(part["first"])
        done += part["n"]
    return sorted(cuts, reverse=True)[-(batches - 1):] if batches > 1 else []


def grouped(rows: DataFrame, index: DataFrame) -> DataFrame:
    """`rows` (stored; with `digest`) plus `keep_id` of the index and `group_size`, the rows of the digest.

    Digests with over 1/1000 of all rows, hence fewer than 1000, are joined by broadcast; the others are
    each small against a task. So no task gets a hot digest, and every row is kept.
    """
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups, _ = stored(sizes.join(index, "digest"), "digest-groups")
    least = rows.count() // HOT_SHARE
    hot = F.broadcast(groups.where(F.col("group_size") > least))
    spread = rows.join(hot, "digest", "left")
    known = spread.where(F.col("group_size").isNotNull())
    rest = spread.where(F.col("group_size").isNull()).drop("keep_id", "group_size")
    return known.unionByName(rest.join(groups, "digest"))


def exact_groups(df: DataFrame, index_name: str, batches: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: key, keep_id, group_size, kept, text_sha256.

    The rows go into a fresh index in batches of descending key ranges, so that the largest key of equal
    texts is met first and stays. NULL text counts as empty, a NULL key is smaller than any other; of rows that
    repeat key and text all count as kept (`deduplicate` leaves one). An empty table gives no rows.
    """
    spark = df.sparkSession
    rows, _ = stored(df.select(F.col(key).alias("doc_id"), text_digest(text).alias("digest")), "digests")
    index = DigestIndex(spark, index_name)
    index.drop()
    upper = None
    for cut in [*_cuts(rows, batches), None]:
        batch = rows
        if cut is not None:
            batch = batch.where(F.col("doc_id") >= cut)
        if upper is not None:
            batch = batch.where(F.col("doc_id").isNull() | (F.col("doc_id") < upper)) if cut is None else batch.where(
                F.col("doc_id") < upper)
        index.absorb(batch)
        upper = cut
    out = grouped(rows, index.read())
    return out.select(
        F.col("doc_id").alias(key), "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def deduplicate(df: DataFrame, index_name: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` with one row per text, the one with the largest key; other columns as they are."""
    chosen = exact_groups(df, index_name, key=key, text=text).where("kept")
    return keep_rows(df, chosen.select(key, F.col("text_sha256").alias("__digest")), {"__digest": text_digest(text)}, key)


@query("op3_exact_dedup", """
  SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
         doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
  FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op3(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"), "op3_digest_index")

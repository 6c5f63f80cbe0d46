"""Ranked lexical search: bundles of items pass the owners of the terms one after the other and gather scores."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hourline.llm.common import discard, query, stored, table
from hourline.session import scratch_path

OWNERS = 4  # stages that a bundle passes, rare terms first
ITEMS = 128  # items of a bundle, on average
BLOCK_DOCS, BLOCK_WORDS = 4096, 1 << 21  # documents of a block: up to either
FILTER_BITS = 22  # the terms asked for are known to the scan as marks in a table of this fixed size
WORDS_KEPT = 1 << 20
MOST = 1_000_000  # a term's contribution is less than its weight times this
K_LEAST, K_LENGTH = 10, 90  # percent of the length norm that is fixed, and that follows the length
# Letters lower-cased, and every byte that no term holds turned into a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


def _slot(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - FILTER_BITS)


def _item_terms(batches):
    for batch in batches:
        found = [list(dict.fromkeys(terms_of(text.as_py()))) for text in batch.column(1)]
        rows = np.repeat(np.arange(len(found)), [len(t) for t in found])
        flat = [t for ts in found for t in ts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)), pa.array(flat, pa.binary()).cast(pa.string()), pa.array(map(_slot, flat), pa.int32())],
            names=["item", "term", "slot"],
        )


class _Wanted(dict):
    """Whether a word may be a term that an item holds: its number, or -1."""

    def __init__(self, marks: bytes):
        super().__init__()
        self.marks, self.words = marks, []

    def __missing__(self, word: bytes) -> int:
        value = -1
        if self.marks[_slot(word)]:
            value = len(self.words)
            self.words.append(word)
        self[word] = value
        return value

    def tidy(self) -> None:
        if len(self) > WORDS_KEPT:
            self.clear()
            self.words = []


def _postings(marks: bytes, kind: pa.DataType):
    """Of every block of documents one row with their keys and lengths, and one for each term it holds, with places and counts."""
    def run(batches):
        wanted, block = _Wanted(marks), TaskContext.get().partitionId() << 33
        keys, lengths, numbers, words = [], [], [], 0

        def flush():
            nonlocal block, keys, lengths, numbers, words
            sizes = [len(x) for x in numbers]
            flat = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
            places = np.repeat(np.arange(len(keys)), sizes)
            known = flat >= 0
            found, counts = np.unique(flat[known] * len(keys) + places[known], return_counts=True)
            term, place = np.divmod(found, max(len(keys), 1))
            cuts = np.flatnonzero(np.diff(term)) + 1
            begins, ends = np.append(0, cuts)[: len(term)], np.append(cuts, len(term))[: len(cuts) + 1]
            begins, ends = (begins, ends) if len(term) else (begins[:0], ends[:0])
            place, counts = place.astype("<i4"), counts.astype("<i4")
            n = len(begins) + 1
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * n, pa.int64()),
                    pa.array([None, *(wanted.words[t].decode() for t in term[begins].tolist())], pa.string()),
                    pa.array([sum(x > 0 for x in lengths), *(ends - begins).tolist()], pa.int64()),
                    pa.array([sum(lengths), *[None] * len(begins)], pa.int64()),
                    pa.array([None, *(place[b:e].tobytes() for b, e in zip(begins.tolist(), ends.tolist(), strict=True))], pa.binary()),
                    pa.array([np.array(lengths, "<i8").tobytes(), *(counts[b:e].tobytes() for b, e in zip(begins.tolist(), ends.tolist(), strict=True))], pa.binary()),
                    pa.array([keys, *[None] * len(begins)], pa.list_(kind)),
                ],
                names=["block", "term", "n", "total", "places", "counts", "keys"],
            )
            block, keys, lengths, numbers, words = block + 1, [], [], [], 0
            wanted.tidy()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms_of(text.as_py())
                keys.append(key)
                lengths.append(len(found))
                numbers.append(np.fromiter(map(wanted.__getitem__, found), np.int64, len(found)))
                words += len(found)
                if len(keys) == BLOCK_DOCS or words >= BLOCK_WORDS:
                    yield flush()
        if keys:
            yield flush()

    return run


class _Scores:
    """What a bundle carries for one block: for each of its items places of documents and their sums so far."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.row = row
        self.items, self.docs = len(row["items"]), len(row["keys"])
        self.norms = K_LEAST + (K_LENGTH * np.frombuffer(row["lengths"], "<i8") * n_docs) // n_terms
        self.sums = np.zeros((self.items, self.docs), np.int64)
        if row["sizes"] is not None:
            sizes = np.frombuffer(row["sizes"], "<i4")
            self.sums[np.repeat(np.arange(self.items), sizes), np.frombuffer(row["at"], "<i4")] = np.frombuffer(row["sums"], "<i8")

    def take(self, postings: pa.Table) -> None:
        for weight, items, places, counts in zip(*(postings.column(c).to_pylist() for c in ("weight", "members", "places", "counts")), strict=True):
            places, counts = np.frombuffer(places, "<i4"), np.frombuffer(counts, "<i4").astype(np.int64)
            part = weight * ((1_000_000_000 * counts) // (1000 * counts + 8 * self.norms[places]))
            for item in items:
                self.sums[item, places] += part

    def hopeful(self, bounds: list[int], best: int) -> np.ndarray:
        """Sums above 0 that may still be among the item's best: the rest of its terms adds less than its bound."""
        keep = self.sums > 0
        if self.docs > best:
            floor = np.partition(self.sums, self.docs - best, axis=1)[:, self.docs - best]
            keep &= self.sums + np.array(bounds, np.int64)[:, None] >= floor[:, None]
        return keep


def _passed(owner: int, best: int, n_docs: int, n_terms: int):
    """One owner's stage: the bundles of a block take the owner's contributions and go on."""
    def run(_key, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundles.num_rows:
            return bundles
        scores = _Scores(bundles.to_pylist()[0], n_docs, n_terms)
        scores.take(postings)
        # A document without any sum yet stays possible: owners to come may give it one, so nothing is kept for it.
        item, place = np.nonzero(scores.hopeful([b[owner + 1] for b in scores.row["bounds"]], best))
        out = scores.row | {
            "sizes": np.bincount(item, minlength=scores.items).astype("<i4").tobytes(),
            "at": place.astype("<i4").tobytes(), "sums": scores.sums[item, place].astype("<i8").tobytes(),
        }
        return pa.Table.from_pylist([out], schema=bundles.schema)

    return run


def _chosen(best: int, n_docs: int, n_terms: int, schema: pa.Schema):
    """The last owner's stage: the best documents of the block for each item."""
    def run(_key, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        rows = []
        if bundles.num_rows:
            scores = _Scores(bundles.to_pylist()[0], n_docs, n_terms)
            scores.take(postings)
            keys, items = scores.row["keys"], scores.row["items"]
            keep = scores.hopeful([0] * scores.items, best)
            for item in range(scores.items):
                places = np.flatnonzero(keep[item])
                order = sorted(places.tolist(), key=lambda p, of=scores.sums[item]: (-of[p], keys[p] is None, keys[p] or 0))
                rows += [{"item": items[item], "doc": keys[p], "score": int(scores.sums[item, p])} for p in order[:best]]
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _arrow_kind(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


def ranked_search(
    docs: DataFrame, items: DataFrame, best: int = 10, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", owners: int = OWNERS,
) -> DataFrame:
    """For each item its `best` documents: item_key, rank, key, score (above 0; the highest first, ties by key).

    score: the sum over the item's distinct terms of w * ((10^9 tf) div (1000 tf + 8 m)), where w is
    floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L, all over all documents.

    One scan turns blocks of documents into postings of the terms that items hold. Terms belong to owners by their
    frequency, rare ones first. Items travel in bundles: for each block a bundle carries the sums gathered so far and
    meets the next owner's postings in a cogroup. What can no longer reach the block's `best` is not carried on: a
    bound of what the owners to come can add is known. The last owner's stage gives each block's best, of which the
    item's best are chosen.

    NULL and term-less texts count for nothing, in N neither. A NULL key ranks after the others. Documents that
    repeat are each ranked; items that repeat an id are one item with the terms of all its texts; items with a
    NULL id are one item too. Without items or documents there are no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    kind, item_kind = dict(docs.dtypes)[key], dict(items.dtypes)[item_key]
    asked, asked_at = stored(
        items.select(F.col(item_key).alias("item"), F.col(item_text).cast("string").alias("text"))
        .mapInArrow(_item_terms, f"item {item_kind}, term string, slot int").distinct(), "item-terms",
    )
    marks = bytearray(1 << FILTER_BITS)
    for row in asked.select("slot").distinct().toLocalIterator():
        marks[row["slot"]] = 1

    plain = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    postings, postings_at = stored(
        plain.mapInArrow(
            _postings(bytes(marks), _arrow_kind(docs, key)),
            f"block long, term string, n long, total long, places binary, counts binary, keys array<{kind}>",
        ), "postings",
    )

    blocks = postings.where("term IS NULL")
    totals = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = int(totals["n"]), int(totals["l"])

    df_of = postings.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
    known, known_at = stored(
        asked.select("term").distinct().join(df_of, "term").withColumns({
            "weight": F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long"),
            "class": F.floor(F.log2(F.col("df").cast("double"))).cast("int"),
        }), "terms",
    )
    # Owners get about equal shares of the postings; classes of frequency are at most 63.
    volume = sorted((r["class"], r["v"]) for r in known.groupBy("class").agg(F.sum("df").alias("v")).collect())
    total, seen, owner_of = sum(v for _, v in volume), 0, {}
    for c, v in volume:
        owner_of[c] = min(owners - 1, owners * seen // max(total, 1))
        seen += v
    owner = reduce(lambda rest, c: F.when(F.col("class") == c, owner_of[c]).otherwise(rest), owner_of, F.lit(0))

    n_bundles = -(-max(asked.select("item").distinct().count(), 1) // ITEMS)
    terms, terms_at = stored(
        asked.drop("slot").join(known, "term").select(
            "item", "term", "weight", owner.cast("int").alias("owner"), F.pmod(F.xxhash64("item"), F.lit(n_bundles)).cast("int").alias("bundle"),
        ), "asked",
    )
    ahead = [F.coalesce(F.sum(F.when(F.col("owner") >= o, F.col("weight") * MOST)), F.lit(0)) for o in range(owners + 1)]
    per_item = terms.groupBy("bundle", "item").agg(F.array(*ahead).alias("bounds"))
    bundles = per_item.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("item", "bounds"))).alias("all"))
    bundles, bundles_at = stored(
        bundles.select("bundle", F.col("all.item").alias("items"), F.col("all.bounds").alias("bounds")), "bundles"
    )
    member = F.expr("array_position(transform(items, x -> x <=> item), true) - 1").cast("int")
    wanted, wanted_at = stored(
        terms.join(bundles, "bundle").withColumn("member", member)
        .groupBy("term", "bundle", "owner", "weight").agg(F.collect_list("member").alias("members")), "wanted",
    )

    met_at = scratch_path(spark, "met")
    known_by = postings.where("term IS NOT NULL").select("block", "term", "places", "counts").join(wanted, "term")
    known_by.drop("term").write.partitionBy("owner").parquet(met_at)
    met = lambda: spark.read.schema(
        "bundle int, block long, weight long, members array<int>, places binary, counts binary, owner int").parquet(met_at)
    carried = (
        met().select("bundle", "block").distinct().join(bundles, "bundle")
        .join(blocks.select("block", "keys", F.col("counts").alias("lengths")), "block")
        .withColumns({c: F.lit(None).cast("binary") for c in ("sizes", "at", "sums")})
    )
    answer = pa.schema([("item", _arrow_kind(items, item_key)), ("doc", _arrow_kind(docs, key)), ("score", pa.int64())])
    for o in range(owners):
        pair = carried.groupBy("bundle", "block").cogroup(met().where(F.col("owner") == o).drop("owner").groupBy("bundle", "block"))
        if o < owners - 1:
            carried = pair.applyInArrow(_passed(o, best, n_docs, n_terms), carried.schema)
    found = pair.applyInArrow(_chosen(best, n_docs, n_terms, answer), f"item {item_kind}, doc {kind}, score long")
    found, _ = stored(found, "found")
    discard(spark, asked_at, postings_at, known_at, terms_at, bundles_at, wanted_at, met_at)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return found.withColumn("rank", rank).where(F.col("rank") <= best).select(
        F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(key), "score"
    )


# Every document against every term of every item.
SQL = """
  WITH tokens AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents),
  counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
  lens AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY ALL),
  whole AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM lens),
  weights AS (SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, whole GROUP BY term),
  asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark),
  scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
    FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lens USING (doc_id), whole GROUP BY ALL),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
  SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query("op11_search", SQL)
def op11(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

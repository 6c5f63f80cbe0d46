"""Near-duplicate documents: MinHash bands, verified links, connected components."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import as_text, discard, keep_rows, once, query, stored, table

BANDS, ROWS = 40, 5  # at a similarity of 0.8 all 40 bands miss once in 8 million pairs
HASHES = BANDS * ROWS
SEED = 20240131
# Signature estimates this far under the threshold rule a pair out: over five standard deviations of 200 minima.
SLACK = 0.16
WORDS_KEPT = 1 << 20
PER_TASK_MEMBERS, PIVOT_BLOCK, MEMBER_SLICE = 256, 128, 512
_draw = np.random.Generator(np.random.PCG64(SEED))
_A = _draw.integers(1, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _draw.integers(0, 2**64, HASHES, dtype=np.uint64)
_M = _draw.integers(1, 2**64, ROWS + 1, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    """Hashes of the words met by this worker, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `words` words: words are runs without ASCII white
    space, A-Z lower-cased. A text of fewer words is one shingle; without words the set is empty."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(_words.__getitem__, found)), np.uint64)
    size = min(words, len(found))
    total = np.full(len(found) - size + 1, size, np.uint64)
    for i in range(size):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(found) - size + 1 + i])
    return np.unique(total)


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    if 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
        return False
    joint = len(one) + len(other) - len(np.unique(np.concatenate([one, other])))
    return 100 * joint >= percent * (len(one) + len(other) - joint)


def minima(shingles: np.ndarray) -> np.ndarray:
    """For each of the universal hashes (a x + b mod 2^64, upper half, x of 32 bits), its least value."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    keys = shingles >> np.uint64(32)
    for i in range(0, len(keys), 1024):
        np.minimum(least, (np.multiply.outer(_A, keys[i : i + 1024]) + _B[:, None]).min(axis=1), out=least)
    return least >> np.uint64(32)


def _sketches(words: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            digests, counts, signatures = np.empty((len(texts), 2), np.int64), [], np.empty((len(texts), HASHES), np.uint64)
            for i, text in enumerate(texts):
                shingles = shingle_set(text.as_py(), words)
                counts.append(len(shingles))
                digests[i] = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)
                signatures[i] = minima(shingles)
            bands = np.zeros((len(texts), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64) * _M[ROWS]
            for j in range(ROWS):
                bands = _mixed(bands * _M[j] + signatures[:, j::ROWS])
            flat = pa.array(bands.view(np.int64).ravel())
            short = (signatures & np.uint64(0xFFFF)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1], pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), flat),
                    pa.array([row.tobytes() for row in short], pa.binary()),
                ],
                ["doc", "stamp", "high", "low", "n", "bands", "signature"],
            )

    return run


def _alike(threshold: float):
    """Keeps the pairs (a, b) whose signatures agree often enough."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, HASHES) for c in (2, 3)
            )
            near = pa.array((left == right).mean(axis=1) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    return run


def _linked(words: int, percent: int):
    """Rows (a, part, b, text) sorted by a, part and with the text of `a` itself first: the links by full sets."""
    def run(batches):
        pivot, pivot_set = None, None
        for batch in batches:
            a_out, b_out = [], []
            for a, part, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shingles = shingle_set(text, words)
                if a == b:
                    pivot, pivot_set = (a, part), shingles
                elif (a, part) == pivot and similar(pivot_set, shingles, percent):
                    a_out.append(a)
                    b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    return run


def _crossed(words: int, percent: int, threshold: float):
    """Rows (key, block, slice, first, node, root, signature, text), the block's pivots first: links between
    different components, by signature and then by full sets. Every member streams past the pivots held in
    memory. Components that a link has joined count as one from then on, so there are fewer links than components."""
    def run(batches):
        at, nodes, roots, texts, signatures, matrix, sets, joined = None, [], [], [], [], None, {}, {}

        def find(root):
            while joined.get(root, root) != root:
                root = joined[root]
            return root

        for batch in batches:
            a_out, b_out = [], []
            for key, block, part, first, node, root, signature, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, block, part) != at:
                    at, nodes, roots, texts, signatures, matrix, sets, joined = (key, block, part), [], [], [], [], None, {}, {}
                if first == 0:
                    nodes.append(node), roots.append(root), texts.append(text), signatures.append(signature)
                    continue
                if not nodes:
                    continue
                if matrix is None:
                    matrix = np.frombuffer(b"".join(signatures), "<u2").reshape(-1, HASHES)
                own = None
                for i in np.flatnonzero((matrix == np.frombuffer(signature, "<u2")).mean(axis=1) >= threshold).tolist():
                    if find(roots[i]) == find(root):
                        continue
                    own = shingle_set(text, words) if own is None else own
                    if i not in sets:
                        sets[i] = shingle_set(texts[i], words)
                    if similar(sets[i], own, percent):
                        joined[find(roots[i])] = find(root)
                        a_out.append(nodes[i])
                        b_out.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the least node that it is connected with.

    Large-star and small-star steps take turns until they change nothing. Edges are stored between
    the steps; a hot node's edges are split by adaptive execution, since its least neighbour is joined to them.
    """
    spark = edges.sparkSession
    down, at = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(down)
    while True:
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large, large_at = stored(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges"
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        past = at
        down, at = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(spark, past, large_at)
        after = mark(down)
        if after == before:
            break
        before = after
    return down.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        down.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links by their full sets. Pairs of one `a` are dealt over tasks of a few
    hundred; each streams past the set of `a`."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_TASK_MEMBERS).alias("__parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("__parts")).cast("int")).drop("__parts")
    heads = dealt.select("a", "part").distinct().withColumn("b", F.col("a"))
    rows = dealt.unionByName(heads).join(texts.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "text")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("a") != F.col("b"))
    return rows.mapInArrow(_linked(words, percent), "a long, b long")


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per row of `df`: key, n_shingles, component_id, kept, and `stamp`, a hash of the text.

    Rows with equal shingle sets are one node. Nodes that share a band meet in its bucket. First every
    member is compared with the bucket's pivot, chosen alike in all buckets: estimates from signatures, then full sets.
    Components of these links leave few buckets with more than one component; there all members
    outside the largest are compared, in blocks held in memory, with all members of other components, and only links come out. So a large group is never
    paired off, and no link between different components goes unseen.

    NULL and wordless texts have n_shingles 0 and are linked with nothing; a NULL key is never a component_id
    unless no other key is there; rows that repeat a key with different texts are separate nodes. An empty table gives no rows.
    """
    spark = df.sparkSession
    threshold = percent / 100 - SLACK
    docs = df.select(F.col(key).alias("doc"), F.xxhash64(text).alias("stamp"), F.col(text).alias("text"))
    kind = dict(docs.dtypes)["doc"]
    rows, rows_at = stored(
        docs.mapInArrow(_sketches(words), f"doc {kind}, stamp long, high long, low long, n long, bands array<long>, signature binary"),
        "sketches",
    )
    nodes, nodes_at = stored(
        rows.where("n > 0").groupBy("high", "low").agg(
            F.min(F.struct("doc", "stamp")).alias("doc"), F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ).select("high", "low", "doc.*", "bands", "signature").withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    met = nodes.select("node", F.explode("bands").alias("key"))
    chosen = met.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("node").alias("h"), "node"))["node"].alias("pivot")
    ).where("size > 1")
    buckets, buckets_at = stored(met.join(chosen, "key").drop("size"), "buckets")

    signatures = nodes.select("node", "signature")
    pairs = buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs, pairs_at = stored(pairs, "pairs")

    def estimated(pairs: DataFrame) -> DataFrame:
        a, b = (signatures.select(F.col("node").alias(c), F.col("signature").alias(f"of_{c}")) for c in "ab")
        return pairs.join(b, "b").join(a, "a").select("a", "b", "of_a", "of_b").mapInArrow(_alike(threshold), "a long, b long")

    near, near_at = stored(estimated(pairs), "near-pairs")
    wanted = buckets.select("node").distinct().join(nodes, "node").select("node", as_text("doc").alias("__key"), "stamp")
    texts = once(docs.drop("stamp"), {"stamp": F.xxhash64("text")}, "doc").join(wanted, ["__key", "stamp"])
    texts, texts_at = stored(texts.select("node", "text"), "texts")
    links, links_at = stored(_verified(near, texts, words, percent), "links")
    roots = components(links)

    # Buckets with more than one component: everything outside the largest against everything else.
    placed, placed_at = stored(
        buckets.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed"
    )
    per_root = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    mixed = per_root.groupBy("key").agg(
        F.max(F.struct("size", "root")).alias("top"), F.sum("size").alias("members"), F.count(F.lit(1)).alias("roots"),
    ).where("roots > 1").select(
        "key", F.col("top.root").alias("main"),
        F.ceil((F.col("members") - F.col("top.size")) / PIVOT_BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("members") / MEMBER_SLICE).cast("int").alias("slices"),
    )
    mixed, mixed_at = stored(placed.join(mixed, "key").join(signatures, "node"), "mixed")
    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "block", "slice", "first", "node", "root", "signature"]
    heads = mixed.where("root <> main").withColumns({"block": of("blocks"), "first": F.lit(0)}).withColumn("slice", every("slices"))
    members = mixed.withColumns({"slice": of("slices"), "first": F.lit(1)}).withColumn("block", every("blocks"))
    rest = (
        heads.select(columns).unionByName(members.select(columns)).join(texts, "node").select(*columns, "text")
        .repartition("key", "block", "slice").sortWithinPartitions("key", "block", "slice", "first")
        .mapInArrow(_crossed(words, percent, threshold), "a long, b long")
    )
    more, more_at = stored(rest, "links")
    roots = components(links.unionByName(more))

    labelled = nodes.select("high", "low", "node", "doc").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("doc").alias("component_id"))
    final, _ = stored(labelled.join(least, "root").select("high", "low", "component_id"), "classes")
    thin, _ = stored(rows.select("doc", "stamp", "high", "low", "n"), "members")
    discard(spark, rows_at, nodes_at, buckets_at, pairs_at, near_at, texts_at, placed_at, mixed_at, links_at, more_at)
    out = thin.join(final, ["high", "low"], "left").withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")))
    return out.select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"), "stamp",
    )


def drop_near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` with one row per group of near-duplicates, that with the least key. Texts without words stay;
    of rows that repeat key and text one stays."""
    marks = near_duplicates(df, words, percent, key, text).where("kept")
    alone = marks.where("n_shingles = 0").select(key, "stamp")
    grouped = marks.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(F.col(key), "stamp")).alias("__one"))
    chosen = alone.unionByName(grouped.select(F.col("__one")[key].alias(key), F.col("__one.stamp").alias("stamp")))
    return keep_rows(df, chosen.select(key, F.col("stamp").alias("__stamp")), {"__stamp": F.xxhash64(text)}, key)


# Every document against every other on sets of whole shingles, then reachability.
SQL = """
  WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
      lambda x: x <> '') AS w FROM documents),
  sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
      ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM words),
  flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
  same AS (SELECT list_sort(s) AS k, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
  reps AS (SELECT f.* FROM flat f SEMI JOIN same ON f.doc_id = same.rep),
  pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM reps a JOIN reps b ON a.g = b.g AND a.doc_id < b.doc_id
    WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
    UNION SELECT s.doc_id, same.rep FROM sets s JOIN same ON list_sort(s.s) = same.k
    UNION SELECT same.rep, s.doc_id FROM sets s JOIN same ON list_sort(s.s) = same.k),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
  least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
  SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
  FROM sets s JOIN least_of ON s.doc_id = least_of.a"""


@query("op4_minhash", SQL)
def op4(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=2).drop("stamp")

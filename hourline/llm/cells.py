"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them, connected components."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import discard, query, stored, table
from hourline.llm.minhash import components

CELL = 2048  # vectors at home in a cell that is not divided any more
PER_CENTRE, MOST_CENTRES = 512, 256  # a division has a centre for so many vectors, and at most so many
SAMPLE = 16_384  # vectors of a group that its centres are fitted on, on average
ROUNDS = 8
PER_TASK = 8192  # vectors assigned by a task
BLOCK, SLICE = 1024, 16_384  # heads held in memory, members that stream past them
USELESS = 0.6  # a division is given up where a vector would visit this share of the cells
CELL_KEY = ["label", "dim", "path"]


def _units(batches):
    """Rows (doc, label, vector) -> (doc, label, dim, digest, unit); the last three NULL where nothing can be linked."""
    for batch in batches:
        dims, digests, units = [], [], []
        for label, vector in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            unit = None
            if label.is_valid and vector and None not in vector:
                values = np.array(vector, np.float64)
                top = np.abs(values).max()
                if np.isfinite(top) and top > 0:
                    values /= top
                    unit = (values / np.sqrt(values @ values)).astype("<f8").tobytes()
            dims.append(unit and len(unit) // 8)
            digests.append(unit and hashlib.blake2b(unit, digest_size=16).digest())
            units.append(unit)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
            names=["doc", "label", "dim", "digest", "unit"],
        )


def _matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("unit").to_pylist()), "<f8").reshape(table.num_rows, -1)


def _visits(likeness: np.ndarray, centres: np.ndarray, reach: float) -> np.ndarray:
    """Which cells (columns) a vector (row) has to visit: all in which a vector within the angle may be at home.

    One at home in cell a is at least as near to centre a as to centre b. A vector nearer to b is at an angle of
    arcsin((y b - y a) / |b - a|) from the plane between them, and so from everything on its other side.
    """
    nearest = likeness.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))[nearest]
    return likeness.max(axis=1)[:, None] - likeness <= reach * apart + 1e-9


def _fit(reach: float):
    """Spherical k-means on the sample of one group: its centres, or none where cells would not keep vectors apart."""
    def run(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by("node")
        vectors = _matrix(sample)
        k = min(MOST_CENTRES, -(-sample.column("homes")[0].as_py() // PER_CENTRE), len(vectors))
        centres = vectors[np.random.Generator(np.random.PCG64(k)).permutation(len(vectors))[:k]].copy()
        for _ in range(ROUNDS):
            likeness = vectors @ centres.T
            nearest = likeness.argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, vectors)
            norms = np.linalg.norm(sums, axis=1)
            lost = np.flatnonzero(norms < 1e-9)
            sums[lost] = vectors[np.argsort(likeness.max(axis=1), kind="stable")[: len(lost)]]
            norms[lost] = 1
            centres = sums / norms[:, None]
        useful = k > 1 and _visits(vectors @ centres.T, centres, reach).mean() <= USELESS
        return pa.table({
            **{c: sample.column(c)[:1] for c in CELL_KEY},
            "centres": pa.array([centres.astype("<f8").tobytes() if useful else None], pa.binary()),
        })

    return run


def _assign(reach: float):
    """Members of a group and its centres -> members of its cells, one row for each cell they are at home in or visit."""
    def run(_key, members: pa.Table, centres: pa.Table) -> pa.Table:
        members = members.drop_columns(["salt"])
        packed = centres.column("centres")[0].as_py() if centres.num_rows else None
        if packed is None or not members.num_rows:
            return members.set_column(members.schema.get_field_index("final"), "final", pa.array([True] * members.num_rows))
        vectors = _matrix(members)
        middle = np.frombuffer(packed, "<f8").reshape(-1, vectors.shape[1])
        likeness = vectors @ middle.T
        row, cell = np.nonzero(_visits(likeness, middle, reach))
        out = members.take(pa.array(row))
        home = np.asarray(out.column("home")) & (likeness.argmax(axis=1)[row] == cell)
        paths = pa.array([f"{p}.{c}" for p, c in zip(out.column("path").to_pylist(), cell.tolist(), strict=True)], pa.string())
        return out.set_column(out.schema.get_field_index("path"), "path", paths).set_column(
            out.schema.get_field_index("home"), "home", pa.array(home))

    return run


def _compare(threshold: float):
    """Heads (first = 0) against the members of their cell: how many vectors each head links with, and enough links to
    connect what is linked: one for each member and one for each time that a member joins heads not joined before."""
    def run(rows: pa.Table) -> pa.Table:
        first = np.asarray(rows.column("first"))
        order = np.lexsort((np.asarray(rows.column("node")), first))
        nodes, owns, weights = (np.asarray(rows.column(c))[order] for c in ("node", "own", "weight"))
        vectors, n = _matrix(rows)[order], int((first == 0).sum())
        block = rows.column("block")[0].as_py()
        heads, counts, joined = nodes[:n], np.zeros(n, np.int64), np.arange(n)
        a_out, b_out = [], []
        for at in range(n, len(nodes) if n else 0, BLOCK):
            other = nodes[at : at + BLOCK]
            linked = vectors[:n] @ vectors[at : at + BLOCK].T >= threshold
            linked &= heads[:, None] != other
            counts += linked @ weights[at : at + BLOCK]
            own = owns[at : at + BLOCK]
            linked &= (own < 0) | (own >= block)  # the block of the others' own heads has these links
            some = np.flatnonzero(linked.any(axis=0))
            a_out.append(heads[linked[:, some].argmax(axis=0)])
            b_out.append(other[some])
            high = np.where(linked[:, some], joined[:, None], -1).max(axis=0)
            low = np.where(linked[:, some], joined[:, None], n).min(axis=0)
            for j in some[low != high].tolist():
                found = np.flatnonzero(linked[:, j])
                groups, which = np.unique(joined[found], return_index=True)
                if len(groups) > 1:
                    joined[np.isin(joined, groups)] = groups[0]
                    a_out.append(heads[found[which]])
                    b_out.append(np.full(len(groups), other[j]))
        some = np.flatnonzero(counts)
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a_out, b_out))
        return pa.table({
            "a": pa.array(np.concatenate([heads[some], a]), pa.int64()),
            "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b, pa.int64())]),
            "n": pa.array(np.concatenate([counts[some], np.zeros(len(a), np.int64)]), pa.int64()),
        })

    return run


def _divided(members: DataFrame, reach: float) -> tuple[DataFrame, str]:
    """Members of cells, divided until a cell is small or cannot be divided to any use."""
    spark = members.sparkSession
    members, at = stored(members, "cells")
    while True:
        homes = members.where("home AND NOT final").groupBy(CELL_KEY).agg(F.count(F.lit(1)).alias("homes"))
        large, large_at = stored(homes.where(F.col("homes") > CELL), "large-cells")
        if large.isEmpty():
            discard(spark, large_at)
            return members, at
        drawn = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < F.lit(SAMPLE << 20) / F.col("homes")
        sample = members.where("home").join(large, CELL_KEY).where(drawn).select(*CELL_KEY, "node", "unit", "homes")
        kinds = dict(members.dtypes)
        centres, centres_at = stored(
            sample.groupBy(CELL_KEY).applyInArrow(_fit(reach), f"label {kinds['label']}, dim int, path string, centres binary"), "centres"
        )
        total = members.join(large.select(CELL_KEY), CELL_KEY).groupBy(CELL_KEY).agg(F.ceil(F.count(F.lit(1)) / PER_TASK).cast("int").alias("salts"))
        total, total_at = stored(total, "salts")
        salted = members.join(total, CELL_KEY).withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), F.col("salts")).cast("int")).drop("salts")
        spread = centres.join(total, CELL_KEY).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        key = [*CELL_KEY, "salt"]
        anew = salted.select(*members.columns, "salt").groupBy(key).cogroup(spread.groupBy(key)).applyInArrow(_assign(reach), members.schema)
        rest = members.join(large.select(CELL_KEY), CELL_KEY, "left_anti").select(members.columns)
        past = at
        members, at = stored(rest.unionByName(anew), "cells")
        discard(spark, past, large_at, centres_at, total_at)


def near_vectors(
    df: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per row of `df`: key, n_links (other vectors linked directly), component_id (the smallest key reachable by
    links, itself included), kept (key = component_id: one row of each group).

    Vectors of one label and one length are linked where their cosine, in doubles, is at least `threshold` (above 0).
    Equal directions are one node with a weight. Spherical k-means divides a label's nodes, fitted on about
    SAMPLE of them for each division, all of them assigned; large cells are divided again. A node is at home in the
    cell of the nearest centre and visits every cell in which a partner could be at home, so no link is lost at
    borders. Inside a cell blocks of at most about BLOCK heads meet all members, in slices; only counts and a
    spanning set of links leave a task. n_links counts pairs, so a group that is wholly linked costs
    time with the square of its size, in blocks spread over all tasks.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, and those without a label, have n_links 0
    and are their own component. A NULL key is never a component_id unless there is no other. Rows that repeat count as
    other vectors. An empty table gives no rows; other columns are not looked at.
    """
    spark = df.sparkSession
    reach = float(np.sqrt(1 - threshold**2))
    plain = df.select(F.col(key).alias("doc"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kinds = dict(plain.dtypes)
    rows, rows_at = stored(
        plain.mapInArrow(_units, f"doc {kinds['doc']}, label {kinds['label']}, dim int, digest binary, unit binary"), "units"
    )
    nodes, nodes_at = stored(
        rows.where("unit IS NOT NULL").groupBy("label", "dim", "digest").agg(
            F.count(F.lit(1)).alias("weight"), F.min("doc").alias("doc"), F.first("unit").alias("unit"),
        ).withColumn("node", F.monotonically_increasing_id()), "nodes",
    )
    start = nodes.select(
        "label", "dim", F.lit("").alias("path"), "node", F.lit(True).alias("home"), F.lit(False).alias("final"), "weight", "unit"
    )
    members, members_at = _divided(start, reach)

    cells = members.groupBy(CELL_KEY).agg(
        F.ceil(F.count_if("home") / BLOCK).cast("int").alias("blocks"), F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"),
    ).where("blocks > 0")
    dealt = members.join(cells, CELL_KEY).withColumn(
        "own", F.when(F.col("home"), F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(-1).cast("int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [*CELL_KEY, "block", "slice", "first", "own", "node", "weight", "unit"]
    heads = dealt.where("home").withColumns({"block": F.col("own"), "first": F.lit(0)}).withColumn("slice", every("slices"))
    met = dealt.withColumns({"slice": F.pmod(F.xxhash64("node", F.lit(2)), F.col("slices")).cast("int"), "first": F.lit(1)}).withColumn("block", every("blocks"))
    found, found_at = stored(
        heads.select(columns).unionByName(met.select(columns)).groupBy(*CELL_KEY, "block", "slice")
        .applyInArrow(_compare(threshold), "a long, b long, n long"), "found",
    )
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    placed, placed_at = stored(
        nodes.select("label", "dim", "digest", "node", "doc", "weight").join(roots, "node", "left").join(counts, "node", "left")
        .withColumns({"root": F.coalesce("root", "node"), "n_links": F.coalesce("others", F.lit(0)) + F.col("weight") - 1}), "placed",
    )
    least = placed.groupBy("root").agg(F.min("doc").alias("component_id"))
    final, _ = stored(placed.join(least, "root").select("label", "dim", "digest", "n_links", "component_id"), "classes")
    thin, _ = stored(rows.select("doc", "label", "dim", "digest"), "members")
    discard(spark, rows_at, nodes_at, members_at, found_at, placed_at)
    out = thin.join(final, ["label", "dim", "digest"], "left").withColumn(
        "component_id", F.when(F.col("digest").isNull(), F.col("doc")).otherwise(F.col("component_id")))
    return out.select(
        F.col("doc").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("doc").eqNullSafe(F.col("component_id")).alias("kept"),
    )


# Every pair of a label, then reachability.
SQL = """
  WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
  sound AS (SELECT * FROM vectors WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
  reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
  degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
  SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
  FROM embeddings JOIN least_of ON vec_id = least_of.a LEFT JOIN degree ON vec_id = degree.a"""


@query("op13_cells", SQL)
def op13(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))

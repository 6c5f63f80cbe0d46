"""Fingerprints of documents as invertible Bloom lookup tables of their paragraphs."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import partitions, query, stored, table

CELLS = 24  # of the fingerprint that is returned; comparisons start with these and double them when peeling stops
CHOICES = 3
TEXTS_AT_ONCE = 256
# A paragraph ends at a line break; a long one is cut behind sentences, and behind words where it has none.
SENTENCE = re.compile(r"[^\n]{1,160}?(?:[.!?。]+(?=[ \n]|$)|\n|$)|[^\n]{1,160}(?: |(?=\n)|$)|[^\n]{1,160}")


def paragraphs(text: str | None) -> list[str]:
    return [p for part in SENTENCE.findall(text or "") if (p := part.strip())]


def keys_of(text: str | None) -> np.ndarray:
    """A 64-bit key per paragraph; the n-th occurrence of a paragraph has a key of its own, so that
    documents are multisets of paragraphs."""
    seen: dict[str, int] = {}
    keys = []
    for p in paragraphs(text):
        n = seen[p] = seen.get(p, 0) + 1
        keys.append(xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), n))
    return np.array(keys, np.uint64)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cells_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """The key's cells, one in each third of the table."""
    third = np.uint64(cells // CHOICES)
    return np.stack([(_mix(keys, cells + j) % third + np.uint64(j) * third).astype(np.int64) for j in range(CHOICES)])


@dataclass
class Sketches:
    """Tables of many documents side by side: per cell the number of keys, their XOR and their checks' XOR."""

    count: np.ndarray
    key: np.ndarray
    check: np.ndarray
    cells: int

    @classmethod
    def build(cls, keys: np.ndarray, owner: np.ndarray, documents: int, cells: int) -> Sketches:
        out = cls(np.zeros(documents * cells, np.int32), np.zeros(documents * cells, np.uint64), np.zeros(documents * cells, np.uint64), cells)
        out.add(keys, owner, 1)
        return out

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: int | np.ndarray) -> None:
        checks = _mix(keys, 7)
        for at in cells_of(keys, self.cells):
            at = at + owner * self.cells
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.count - other.count, self.key ^ other.key, self.check ^ other.check, self.cells)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, owners, signs, done): what only the first document has (sign 1) or only the second (-1), and
        for which documents the whole difference came out. Uses the tables up."""
        documents = len(self.count) // self.cells
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (_mix(self.key, 7) == self.check))
            if not len(pure):
                break
            owner, key, sign = pure // self.cells, self.key[pure], self.count[pure]
            # A key alone in several of its cells is taken once.
            _, first = np.unique(np.stack([owner.astype(np.uint64), key]), axis=1, return_index=True)
            owner, key, sign = owner[first], key[first], sign[first]
            found.append((key, owner, sign))
            self.add(key, owner, -sign)
        rest = (self.count != 0) | (self.key != 0) | (self.check != 0)
        done = ~rest.reshape(documents, self.cells).any(axis=1)
        keys, owners, signs = (np.concatenate(x) if found else np.empty(0, t) for x, t in zip(zip(*found, strict=True) if found else ((),) * 3, (np.uint64, np.int64, np.int32), strict=True))
        return keys, owners, signs, done

    def text(self, document: int) -> str:
        part = slice(document * self.cells, (document + 1) * self.cells)
        raw = self.count[part].astype("<i4").tobytes() + self.key[part].astype("<u8").tobytes() + self.check[part].astype("<u4").tobytes()
        return base64.b64encode(raw).decode()


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(k) for k in lists]
    return (np.concatenate(lists) if lists else np.empty(0, np.uint64)), np.repeat(np.arange(len(lists)), sizes)


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair the keys only in the left and only in the right, read from the difference of their sketches.
    Pairs whose difference does not peel are tried again with twice the cells."""
    out: list = [None] * len(left)
    todo = list(range(len(left)))
    while todo:
        sketches = [Sketches.build(*_flat([side[i] for i in todo]), len(todo), cells) for side in (left, right)]
        keys, owners, signs, done = sketches[0].minus(sketches[1]).peel()
        order = np.argsort(owners, kind="stable")
        keys, owners, signs = keys[order], owners[order], signs[order]
        ends = np.searchsorted(owners, np.arange(len(todo) + 1))
        again = []
        for n, i in enumerate(todo):
            if done[n]:
                own, sign = keys[ends[n] : ends[n + 1]], signs[ends[n] : ends[n + 1]]
                out[i] = (own[sign > 0], own[sign < 0])
            else:
                again.append(i)
        todo, cells = again, cells * 2
    return out


def likeness(size: int, other: int, gone: int) -> float:
    """Shared paragraphs over all paragraphs of two versions; 1 for two without any."""
    shared = size - gone
    return shared / (size + other - shared) if size + other - shared else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many from the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(batches):
    """Rows (part, first, doc, text) sorted by part and document, each part with the row that follows it (first false)."""
    held = None  # the row whose following one is not known yet
    names = ["doc", "n_chars", "text_sha256", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "paragraphs", "changed"]

    def finish(rows):
        texts = [r[0][1] for r in rows]
        news = [edited(r[0][1], r[1]) for r in rows]
        own, changed, after = ([keys_of(t) for t in x] for x in (texts, news, [r[1] for r in rows]))
        prints = [Sketches.build(*_flat(x), len(rows), CELLS) for x in (own, changed)]
        edits, nexts = differences(own, changed), differences(own, after)
        near = [
            [likeness(len(a), len(b), len(d[0])) for a, b, d in zip(own, x, y, strict=True)]
            for x, y in ((changed, edits), (after, nexts))
        ]
        sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
        columns = [
            [r[0][0] for r in rows], [len(t) for t in texts], [sha(t) for t in texts], [sha(t) for t in news],
            [prints[0].text(i) for i in range(len(rows))], [prints[1].text(i) for i in range(len(rows))], *near,
            [len(k) for k in own], [len(d[0]) + len(d[1]) for d in edits],
        ]
        return columns

    for batch in batches:
        for at in range(0, len(batch), TEXTS_AT_ONCE):
            ready = []
            for part, doc, text, guard in zip(*(c.to_pylist() for c in batch.slice(at, TEXTS_AT_ONCE).columns), strict=True):
                if held is not None and held[0] == part:
                    ready.append((held[1:], text))
                held = None if guard else (part, doc, text)
            columns = finish(ready)
            kinds = [batch.schema.field(1).type, pa.int64(), *[pa.string()] * 4, *[pa.float64()] * 2, *[pa.int64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: key, n_chars, the digests and sketches of its text and of its text edited with the next
    row's, how alike the sketches are, and how many paragraphs differ.

    The next row is the next by key (NULL last, then by a hash of the text); the last row's next is the first. Rows are dealt to
    parts by ranges of the key, each row by a search among the parts' first rows (as many as shuffle partitions), and each part
    gets the first row of the following one too, so every text moves once or twice. NULL text counts as
    empty; two texts without paragraphs are alike (1). Equal texts have equal fingerprints. An empty table gives no rows.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(
        {"none": F.col("doc").isNull(), "stamp": F.xxhash64("text")})
    n = partitions(spark)
    order = ["none", "doc", "stamp"]
    # Parts and their first rows: narrow passes; the driver gets one row per part.
    laid, _ = stored(docs.select(*order).repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    firsts = [r["first"] for r in laid.groupBy("part").agg(F.min(F.struct(*order)).alias("first")).orderBy("part").collect()]
    kind = dict(docs.dtypes)["doc"]
    out = f"doc {kind}, n_chars long, text_sha256 string, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, paragraphs long, changed long"
    if not firsts:
        return docs.select("doc").mapInArrow(lambda b: iter(()), out).withColumnRenamed("doc", key)
    firsts = [tuple(f) for f in firsts]

    def deal(batches):
        for batch in batches:
            keys = [*zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            part = [max(0, bisect_right(firsts, k) - 1) for k in keys]
            starts = [k == firsts[p] for k, p in zip(keys, part, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part, pa.int32()), pa.array(starts, pa.bool_())], [*order, "text", "part", "starts"])

    dealt = docs.select(*order, "text").mapInArrow(deal, f"none boolean, doc {kind}, stamp long, text string, part int, starts boolean")
    before = F.when(F.col("part") == 0, len(firsts) - 1).otherwise(F.col("part") - 1)
    copies = F.when(F.col("starts"), F.array(F.struct("part", F.lit(False).alias("guard")), F.struct(before.alias("part"), F.lit(True).alias("guard")))).otherwise(
        F.array(F.struct("part", F.lit(False).alias("guard"))))
    dealt = dealt.withColumn("__copy", F.explode(copies)).select(
        "__copy.part", "__copy.guard", *order, "text")
    return (
        dealt.repartitionById(n, F.col("part")).sortWithinPartitions("part", "guard", *order)
        .select("part", "doc", "text", "guard").mapInArrow(_compared, out).withColumnRenamed("doc", key)
    )


@query("op5_fingerprints")
def op5(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))

"""Packing tokenized documents into sequences of a fixed length."""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourline.llm.common import discard, partitions, query, stored, table

LENGTH, END = 4096, 1
TEXTS_AT_ONCE, RUNS_KEPT = 512, 1_700_000
# Texts with the vocabulary's own markers, or with separators that only Python takes for white space.
WHOLE = ("<|startoftext|>", "<|endoftext|>", "\x1c", "\x1d", "\x1e", "\x1f")
# Runs whose letters are those of ASCII and Latin-1, in small or capitals: composed already, and each lower-cased to one of them.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
# Fixed: how the vocabulary divides such runs in lower case.
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
# Fixed: the characters that stand for the bytes of those letters in the vocabulary, printable ones for themselves.
BYTES = {n: "".join(chr(0x143 if b == 0xad else b if b > 0xa0 else b + 0xa2) for b in chr(n).encode()) for n in range(0xdf, 0x100)}


class WordTokenizer(dict):
    """The ids of a word vocabulary, by run without white space: each distinct run is encoded once per worker.

    The vocabulary drops white space before it looks for words, so no token crosses it and a text's ids are those of its runs in
    turn. A run of printable ASCII and letters of Latin-1 is put together from its words, digits and signs, which the model itself
    encodes once each; other runs go through the whole vocabulary, as do the few texts where runs may not stand for themselves.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words: dict[str, bytes] = {}

    def __missing__(self, run: str) -> bytes:
        if run.isalpha() and (run.isascii() or PLAIN(run)):
            found = self._word(run.lower())
        elif (run.isascii() and run.isprintable()) or PLAIN(run):
            get, parts = self.words.get, []
            for word in WORD.findall(run.lower()):
                parts.append(get(word) or self._word(word))
            found = b"".join(parts)
        else:
            found = self._all(run)
        self[run] = found
        return found

    def _word(self, word: str) -> bytes:
        if (found := self.words.get(word)) is None:
            self.words[word] = found = _packed([token.id for token in self.model.tokenize(word if word.isascii() else word.translate(BYTES))])
        return found

    def _all(self, text: str) -> bytes:
        return _packed(self.whole.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if any(mark in text for mark in WHOLE):
            return self._all(text)
        if len(self) + len(self.words) > RUNS_KEPT:
            self.clear(), self.words.clear()
        return b"".join(map(self.__getitem__, (text.lower() if text.isascii() else text).split()))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


_tokenizers: dict[str, WordTokenizer] = {}


def pieces(df: DataFrame, path: str, length: int = LENGTH, end: int = END, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of `df`: key, piece, start, length, ids_crc32 and, if asked, ids.

    A row's ids are those of its whole text and the end id (NULL text: the end id alone); longer ones are cut
    every `length` ids.
    """
    def run(batches):
        if path not in _tokenizers:
            _tokenizers[path] = WordTokenizer(path)
        encode, ending = _tokenizers[path].encode, end.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                row, piece, size, crc, ids = [], [], [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    found = encode(t or "") + ending
                    for n, start in enumerate(range(0, len(found), 4 * length)):
                        own = found[start : start + 4 * length]
                        row.append(i), piece.append(n), size.append(len(own) // 4), crc.append(zlib.crc32(own))
                        ids.append(own if with_ids else None)
                piece = pa.array(piece, pa.int32())
                out = [
                    part.column(0).take(pa.array(row, pa.int64())), piece, pa.array([p * length for p in piece.to_pylist()], pa.int64()),
                    pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(out, ["key", "piece", "start", "length", "ids_crc32", "ids"])

    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["key"]
    return source.mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def _sweep(batches):
    """Rows (size, kind, id, room) of one range in ascending order, items before gaps of their size: every gap
    takes the largest item not taken yet. Gaps and items left over get their place, for the ranges' own sweep."""
    part = TaskContext.get().partitionId()
    waiting, closers = [], 0
    names = ["item", "size", "gap", "room", "part", "place"]
    kinds = [pa.int64()] * 6

    def packed(rows):
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for size, kind, key, room in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 0:
                waiting.append((key, size))
            elif waiting:
                item, length = waiting.pop()
                rows.append((item, length, key, room, None, None))
            else:
                rows.append((None, None, key, room, part, closers))
                closers += 1
        yield packed(rows)
    for i in range(0, len(waiting), 10_000):
        yield packed([(item, size, None, None, part, i + n) for n, (item, size) in enumerate(waiting[i : i + 10_000])])


def _across(spark: SparkSession, left: DataFrame) -> DataFrame:
    """What the ranges left over, matched in range order: (q, low, high, p, top) says that places low to high - 1
    of items in range q go to gaps of range p, whose place is top - the item's place. At most two rows per range."""
    counts = left.groupBy("part").agg(F.count("gap").alias("gaps"), F.count("item").alias("items")).orderBy("part").collect()
    stack, out = [], []
    for part, gaps, items in counts:
        done = 0
        while done < gaps and stack:
            q, low, high = stack.pop()
            n = min(high - low, gaps - done)
            out.append((q, high - n, high, part, done + high - 1))
            if high - n > low:
                stack.append((q, low, high - n))
            done += n
        if items:
            stack.append((part, 0, items))
    return spark.createDataFrame(out, "q long, low long, high long, p long, top long")


def best_fit(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """(item, length) to (item, sequence_id, round): bulk-synchronous best fit.

    Total length / `length` sequences are opened. Each round sorts items and gaps by size over all tasks;
    a sweep gives every gap the largest item that fits it and no other gap has taken, first in each range, then
    across ranges by the rank of what they leave. Gaps shrink, and a gap with room for several of the largest item left is
    offered in parts. When nothing fits any more, sequences for the rest are opened. Lengths are 1 to `length`.
    """
    spark = items.sparkSession
    waiting = items.select("item", F.col("length").alias("size"))
    gaps, kept, opened, placed, past = None, None, 0, [], []
    number = 0
    while True:
        total, largest, smallest = waiting.agg(F.sum("size"), F.max("size"), F.min("size")).first()
        if not total:
            break
        if gaps is None:
            more = -(-total // length)
            new = spark.range(opened, opened + more).select(F.col("id").alias("gap"), F.lit(length).cast("bigint").alias("room"))
            gaps = new if not opened else kept.unionByName(new)
            opened += more
        parts = F.greatest(F.lit(1).cast("bigint"), F.expr(f"room div {2 * largest}L"))
        offers = gaps.where(F.col("room") >= smallest).withColumn("__parts", parts).withColumn(
            "__part", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__parts"))))
        rows = waiting.select("size", F.lit(0).alias("kind"), F.col("item").alias("id"), F.lit(None).cast("bigint").alias("room")).unionByName(
            offers.select(F.expr("room div __parts").alias("size"), F.lit(1).alias("kind"), F.col("gap").alias("id"), "room"))
        swept, at = stored(
            rows.repartitionByRange(partitions(spark), "size", "kind", "id").sortWithinPartitions("size", "kind", "id")
            .mapInArrow(_sweep, "item long, size long, gap long, room long, part long, place long"), "sweep")
        left = swept.where("part is not null")
        spans = F.broadcast(_across(spark, left))  # two rows per range at most
        item_left = left.where("item is not null").select("item", "size", F.col("part").alias("q"), "place")
        gap_left = left.where("gap is not null").select("gap", "room", F.col("part").alias("p"), F.col("place").alias("at"))
        inside = (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high"))
        given = item_left.join(spans, "q").where(inside).select("item", "size", "p", (F.col("top") - F.col("place")).alias("at"))
        given = given.join(gap_left, ["p", "at"])
        matched, _ = stored(
            swept.where("part is null").select("item", "size", "gap", "room").unionByName(given.select("item", "size", "gap", "room")), "placed")
        placed.append(matched.select("item", F.col("gap").alias("sequence_id"), F.col("size").alias("length"), F.lit(number).alias("round")))
        number += 1
        # Items below every matched span of their range stay: spans are taken from the top.
        floor = spans.groupBy("q").agg(F.min("low").alias("floor"))
        rest = item_left.join(F.broadcast(floor), "q", "left").where("floor is null or place < floor")
        rest, rest_at = stored(rest.select("item", "size"), "waiting")
        used = matched.groupBy("gap").agg(F.sum("size").alias("used"))
        shrunk, gaps_at = stored(
            gaps.join(used, "gap", "left").select("gap", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")).where("room > 0"), "gaps")
        discard(spark, at, *past)
        past = [rest_at, gaps_at]
        kept, waiting = shrunk, rest
        gaps = shrunk if not matched.isEmpty() else None
    if not placed:
        return items.select("item", F.lit(0).cast("bigint").alias("sequence_id"), "length", F.lit(0).alias("round"))
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def pack(df: DataFrame, path: str, length: int = LENGTH, end: int = END, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset, and `ids` (little-endian 32-bit) if asked.

    Rows that repeat, also with the same key, are packed each on its own; NULL and empty texts are one end id;
    a NULL key is kept as it is. An empty table gives no rows.
    """
    cut, _ = stored(pieces(df, path, length, end, key, text, with_ids).withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = best_fit(cut.select("item", "length"), length)
    inside = Window.partitionBy("sequence_id").orderBy("round", "item").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    out = cut.join(placed.select("item", "sequence_id", "offset"), "item")
    return out.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of rows packed with ids. A sequence is bounded by its length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.unhex(F.concat_ws("", F.transform(parts, lambda p: p["ids"]))).alias("ids"))


@query("op6_packing")
def op6(spark, sf_dir):
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))

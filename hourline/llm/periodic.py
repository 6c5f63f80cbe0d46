"""Periodic runs of words: stretches that repeat themselves, found by minimizers of every scale."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import query, table

SHORTEST = 12  # words of a run, at least; and twice its period
DIRECT = 32  # periods under it are found by comparing the words at each lag
CHUNK_WORDS = 1 << 17  # texts are worked on together up to so many words; a longer text on its own
IDS_KEPT = 1 << 20
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9))


class _Numbers(dict):
    """A number for each distinct word met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


def _sliding(pick, values: np.ndarray, width: int) -> np.ndarray:
    """pick (minimum or maximum) over every window of `width` values, by doubling."""
    done, out = 1, values
    while 2 * done <= width:
        out = pick(out[: len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of True that have at least `least` of them."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], (ends - starts)[long]


class _Ladder:
    """Hashes of all word n-grams whose length is a power of two, and the common extensions they give."""

    def __init__(self, ids: np.ndarray, longest: int):
        self.rungs = [_mixed(ids.astype(np.uint64) * _MIX[0] + _MIX[1])]
        while 2 << (len(self.rungs) - 1) <= longest:
            low, size = self.rungs[-1], 1 << (len(self.rungs) - 1)
            self.rungs.append(_mixed(low[:-size] * _MIX[0] + _mixed(low[size:] * _MIX[1])))

    def after(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words from `one` on equal those from `other` (> one) on."""
        total = np.zeros(len(one), np.int64)
        for level in range(len(self.rungs) - 1, -1, -1):
            rung = self.rungs[level]
            at = other + total
            inside = np.flatnonzero(at < len(rung))
            same = inside[rung[one[inside] + total[inside]] == rung[at[inside]]]
            total[same] += 1 << level
        return total

    def before(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words before `one` equal those before `other` (> one)."""
        total = np.zeros(len(one), np.int64)
        for level in range(len(self.rungs) - 1, -1, -1):
            rung, size = self.rungs[level], 1 << level
            inside = np.flatnonzero((one - total >= size) & (other - total - size < len(rung)))
            at = total[inside] + size
            same = inside[rung[one[inside] - at] == rung[other[inside] - at]]
            total[same] += size
        return total


def _seeds(grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and lags at which a run of a period from 4 to 8 times `size` must show.

    Windows of 2 x size words have their least n-gram of `size` words marked. In a run of such a period q
    the windows of the first q words come again q words later, and so do their marks. Marks of one n-gram
    that overlap by half or more lie in one stretch of a shorter period: they form a cluster, no pair
    inside it can be a run of period q, and between two clusters each lag needs one seed only.
    """
    low, high = 4 * size, 8 * size
    window = size + 1
    if len(grams) < 2 * window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = _sliding(np.minimum, grams, window)
    pad = np.zeros(window - 1, np.uint64)
    marks = np.flatnonzero(_sliding(np.maximum, np.concatenate([pad, least, pad]), window) == grams)
    marks = marks[np.argsort(grams[marks], kind="stable")]
    kind, gap = grams[marks], np.diff(marks)
    fresh = np.concatenate([[True], (kind[1:] != kind[:-1]) | (gap > size // 2)])
    heads = np.flatnonzero(fresh)
    first, last, kind = marks[heads], marks[np.append(heads[1:], len(marks)) - 1], kind[heads]
    step = np.gcd.reduceat(np.where(fresh, 0, np.concatenate([[0], gap])), heads)
    positions, lags = [], []
    ahead = 1
    left = np.arange(len(heads))
    while True:
        left = left[left + ahead < len(heads)]
        right = left + ahead
        near = (kind[left] == kind[right]) & (first[right] - last[left] < high)
        left, right = left[near], right[near]
        if not len(left):
            break
        by = np.gcd(step[left], step[right])
        by[by == 0] = 1
        base = first[right] - last[left]
        top = np.minimum(last[right] - first[left], high - 1)
        skipped = np.maximum(0, -(-(low - base) // by))
        many = np.maximum(0, (top - base) // by - skipped + 1)
        which = np.repeat(np.arange(len(left)), many)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        lag = base[which] + by[which] * (skipped[which] + nth)
        positions.append(np.maximum(first[left][which], first[right][which] - lag))
        lags.append(lag)
        ahead += 1
    if not lags:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(positions), np.concatenate(lags)


def _prime_factors(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return found + [q] * (q > 1)


def _runs(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run in texts laid one after the other, longest text first; the word after
    each text is like no other. `lengths` are the texts' words."""
    none = np.empty(0, np.int64)
    found = [(none, none, none)]
    longest = int(lengths[0]) if len(lengths) else 0
    for q in range(1, min(DIRECT, longest // 2 + 1)):
        starts, equal = _stretches(ids[:-q] == ids[q:], max(q, SHORTEST - q))
        found.append((starts, equal + q, np.full(len(starts), q, np.int64)))
    if longest >= 2 * DIRECT:
        ladder = _Ladder(ids, longest)
        ends = np.cumsum(lengths + 1)
        size, level = DIRECT // 4, (DIRECT // 4).bit_length() - 1
        while 8 * size <= longest:
            covered = int(ends[np.searchsorted(-lengths, -8 * size, "right") - 1])  # texts that can hold such a run
            at, lag = _seeds(ladder.rungs[level][: covered - size + 1], size)
            back, ahead = ladder.before(at, at + lag), ladder.after(at, at + lag)
            good = back + ahead >= lag
            found.append(((at - back)[good], (back + ahead + lag)[good], lag[good]))
            size, level = 2 * size, level + 1
    runs = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)], axis=1), axis=0)
    # A stretch of at least two periods has a shorter one only if a divisor of the period is one.
    keep = [
        all(not np.array_equal(ids[s : s + n - q // p], ids[s + q // p : s + n]) for p in _prime_factors(q))
        for s, n, q in runs.tolist()
    ]
    runs = runs[np.array(keep, bool)]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def _described(batch: pa.RecordBatch, texts: list[list[bytes]], numbers: _Numbers) -> pa.RecordBatch:
    """Rows (others..., n_words, runs, collapsed) of the rows of `batch`, whose words are given."""
    if len(numbers) > IDS_KEPT:
        numbers.clear()
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    ids = np.empty(int(lengths.sum()) + len(texts), np.int64)
    begins = np.zeros(len(texts), np.int64)
    at = 0
    for nth, row in enumerate(order.tolist()):
        n = len(texts[row])
        ids[at : at + n] = np.fromiter(map(numbers.__getitem__, texts[row]), np.int64, n)
        ids[at + n] = -1 - nth
        begins[nth] = at
        at += n + 1
    starts, sizes, periods = _runs(ids, lengths[order])
    owner = np.searchsorted(begins, starts, "right") - 1
    dropped = np.zeros(len(ids) + 1, np.int64)
    np.add.at(dropped, starts + periods, 1)
    np.add.at(dropped, starts + sizes, -1)
    dropped = np.cumsum(dropped) > 0
    runs: list[list[dict]] = [[] for _ in texts]
    collapsed = [b" ".join(t) for t in texts]
    for nth, s, n, q in zip(owner.tolist(), starts.tolist(), sizes.tolist(), periods.tolist(), strict=True):
        runs[order[nth]].append({"start": s - int(begins[nth]), "length": n, "period": q})
    for nth in np.unique(owner).tolist():
        row = int(order[nth])
        gone = dropped[begins[nth] : begins[nth] + lengths[row]].tolist()
        collapsed[row] = b" ".join(w for w, g in zip(texts[row], gone, strict=True) if not g)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:-1], pa.array(lengths), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=[*batch.schema.names[:-1], "n_words", "runs", "collapsed"],
    )


def _find(batches):
    numbers = _Numbers()
    for batch in batches:
        texts, begin, words = [], 0, 0
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            found = (text.as_py() or "").encode("utf-8").split()
            if texts and words + len(found) > CHUNK_WORDS:
                yield _described(batch.slice(begin, i - begin), texts, numbers)
                texts, begin, words = [], i, 0
            texts.append(found)
            words += len(found)
        if texts:
            yield _described(batch.slice(begin), texts, numbers)


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: key, n_words, runs (start, length and period, by start, then period), and collapsed, the
    words without the repetitions (what a run holds after its first period), one space between them.

    Words are runs without ASCII white space, numbered from 0. A run is a stretch of consecutive words with
    least period q and at least max(12, 2 q) words which no neighbouring word extends. Periods under 32 are found by comparing
    all words at each lag; longer ones by seeds of one scale for each doubling of the period, extended both ways
    by hashed n-grams. No period and no number of runs is left out; the work is n log n.

    Rows stay in their tasks: there is no shuffle. NULL, empty and white texts have no words, no runs and an empty
    `collapsed`; rows that repeat, or repeat a key, are each their own text; a NULL key stays NULL; other
    columns are not looked at. An empty table gives no rows.
    """
    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        _find, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    ).withColumnRenamed("key", key)


def _planted(key: Column, text: Column) -> Column:
    """The text with a periodic tail where the hash of the key asks for one, else as it is."""
    crc = F.crc32(key.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(crc / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        # The words after the first a + p come from that many distinct places; element numbers start at 1.
        place = lambda i: (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at(w, place(i))), " ")

    filled = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]  # splits the text once
    return F.when((crc % 10 == 0) & text.isNotNull(), filled).otherwise(text)


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.l") / (-F.col("best.p"))).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

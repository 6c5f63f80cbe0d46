"""Toxicity of texts by their nearest labelled examples."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import query, stored, table

WORD = re.compile(r"[^\W_]+")
# Scripts written without spaces between words: Thai to Burmese, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
LONG_RUN = 24  # letters above which a run is also read by its beginnings anywhere in it, of RUN_PIECE letters
RUN_PIECE = 5
HEAD, TAIL = 4, 9  # lengths of the word beginnings that are terms besides whole words
MAX_LABELLED = 40_000  # labelled rows the classifier is fitted on, about; drawn by a hash of their id
DIMENSIONS = 1 << 19  # all words are hashed to these; telling terms have dimensions of their own after them
MIN_G2, MIN_ODDS = 25.0, 1.5  # evidence and log odds for toxic above which a term weighs more
TELLING = 8.0  # weight of a telling term per unit of log odds, where a word weighs its inverse document frequency
NEIGHBOURS, PRIOR_WEIGHT = 16, 0.5
# Dimensions that more than a fiftieth of a cell's examples have are held as its matrix, at most so many.
DENSE, DENSE_SHARE = 192, 50
CELLS, CELL_ROUNDS = 8, 5  # cells of similar examples, and rounds of k-means that find them
BLOCK = 64  # examples whose largest weights bound them
UNPACKED = 512  # examples whose weights are worked out at a time
SLAB = 1 << 18  # postings put in order at a time
STRIDE = 8  # examples whose best stands for them while a bar for the k-th best is sought
SINGLE = 1e-5  # error of sums in single precision, at most
TOGETHER = 64  # texts compared with all examples at a time
ROWS_AT_ONCE = 2048  # rows of a batch whose vectors are in memory at a time
COUNTED = 256  # texts whose terms are counted at a time
LEVELS = 1 + np.log(np.maximum(np.arange(1 << 12), 1))  # of counts
WORDS_KEPT = 300_000  # words whose dimensions a worker remembers


def pieces(word: str) -> list[str]:
    """A word, or what stands for words in a run without spaces: pairs of characters, or parts of a long run and the run."""
    if len(word) <= LONG_RUN and word.isascii():
        return [word]
    if UNSPACED.search(word):
        return [word[i : i + 2] for i in range(max(1, len(word) - 1))]
    if len(word) > LONG_RUN:
        return [word, *[word[i : i + RUN_PIECE] for i in range(len(word) - RUN_PIECE + 1)]]
    return [word]


def word_terms(word: str) -> list[str]:
    """A word's terms: itself, marked as whole, and its beginnings."""
    return [f"{word}$", *[word[:n] for n in range(HEAD, min(len(word), TAIL + 1))]]


# ASCII characters that no word holds become spaces.
GAPS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def chunks(text: str | None) -> list[bytes]:
    """The lower-cased text, cut at ASCII characters outside words; `words_of` finds the words of a chunk."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(GAPS).split()


def words_of(chunk: bytes) -> list[str]:
    word = chunk.decode("utf-8", "surrogatepass")
    return [word] if word.isalnum() else WORD.findall(word)


@dataclass
class Cell:
    """Places `low` to `high` - 1 of the index, whole blocks, and a matrix of the dimensions that most examples there have."""

    low: int
    high: int
    column: np.ndarray  # place of a dimension in the matrix, or -1
    matrix: np.ndarray  # (place, example)
    peaks: np.ndarray  # (place, block): the largest weight of a dimension in BLOCK examples


@dataclass
class BlockMaxIndex:
    """Unit vectors of the examples, all of them, in cells of similar ones.

    The dimensions that most examples of a cell have are held as a matrix with its block maxima, all others as postings. Postings
    are summed for every example; the best of that sum plus what a block's maxima allow says which blocks can hold one of the nearest,
    and only their columns of the matrix are multiplied. No example that could be among the nearest is left out.
    """

    size: int  # places
    order: np.ndarray  # the example at each place of the index; places that only fill a block have none (-1) and no weights
    scale: np.ndarray  # what the weights of the example at each place are multiplied by
    runs: np.ndarray  # first run of a dimension: its postings of equal weight are a run, and have that weight once
    start: np.ndarray  # first posting of a run
    weight: np.ndarray  # weight of a run
    postings: np.ndarray  # places
    cells: list[Cell]
    centres: np.ndarray  # (dimension of the sketch, cell)
    sketch: np.ndarray  # place of a dimension in the sketch, or -1
    blocks: int = 0  # blocks of the texts asked for, and those opened
    opened: int = 0

    @classmethod
    def build(cls, rows: list[dict[int, float]], dimensions: int) -> BlockMaxIndex:
        return cls.of(
            np.array([i for i, r in enumerate(rows) for _ in r], _places(len(rows))), np.array([t for r in rows for t in r], np.int32),
            np.array([w for r in rows for w in r.values()], np.float32), len(rows), dimensions)

    @classmethod
    def of(cls, example: np.ndarray, dimension: np.ndarray, weight: np.ndarray, size: int, dimensions: int) -> BlockMaxIndex:
        spans = [slice(low, low + SLAB) for low in range(0, len(dimension), SLAB)]
        held = sum((np.bincount(dimension[s], minlength=dimensions) for s in spans), np.zeros(dimensions, np.int64))
        return cls.made(lambda: ((example[s], dimension[s], weight[s]) for s in spans), np.ones(size), held)

    @classmethod
    def made(cls, parts: Callable[[], Iterator[tuple]], scale: np.ndarray, held: np.ndarray) -> BlockMaxIndex:
        """Of the (examples, dimensions, weights over 0) that `parts` gives, in the same order each time it is asked: it is asked again
        for each pass, so that they are never in memory at once. An example's weights are multiplied by its `scale`; `held` says
        how many examples have a dimension."""
        size, dimensions = len(scale), len(held)
        sketch = _frequent(held, size)
        dense = np.zeros((sketch.max(initial=-1) + 1, size), np.float32)
        for example, dimension, weight in parts():
            row = sketch[dimension]
            there = np.flatnonzero(row >= 0)
            dense[row[there], example[there]] = weight[there] * scale[example[there]]
        centres, own = _cells(dense)
        del dense
        filled = np.bincount(own, minlength=centres.shape[1])
        bounds = np.concatenate([[0], np.cumsum(-(-filled // BLOCK) * BLOCK)])
        by_cell = np.argsort(own, kind="stable")
        at = np.empty(size, _places(size))
        at[by_cell] = np.arange(size) + np.repeat(bounds[:-1] - np.cumsum(filled) + filled, filled)
        order = np.full(bounds[-1], -1, np.int32)
        order[at] = np.arange(size, dtype=np.int32)
        # In how many examples of a cell a dimension is says which ones its matrix holds.
        held = np.zeros((len(filled), dimensions), np.int32)
        for example, dimension, _ in parts():
            np.add.at(held.reshape(-1), own[example] * dimensions + dimension, np.int32(1))
        columns = np.stack([_frequent(h, n) for h, n in zip(held, filled.tolist(), strict=True)])
        matrices = [np.zeros((c.max(initial=-1) + 1, high - low), np.float32) for c, low, high in zip(columns, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        held[columns >= 0] = 0
        ends = np.concatenate([[0], np.cumsum(held.sum(axis=0))])
        del held
        postings, weights, free = np.empty(ends[-1], at.dtype), np.empty(ends[-1], np.float32), ends[:-1].copy()
        for example, dimension, weight in parts():
            cell = own[example]
            column = columns.reshape(-1)[cell * dimensions + dimension]
            for c, matrix in enumerate(matrices):
                few = np.flatnonzero((column >= 0) & (cell == c))
                matrix[column[few], at[example[few]] - bounds[c]] = weight[few] * scale[example[few]]
            rest = np.flatnonzero(column < 0)
            # In the order of dimensions: sorted as numbers with their own place in the lower bits.
            by = np.sort(dimension[rest].astype(np.int64) << 32 | rest)
            rest, one = by & 0xFFFFFFFF, by >> 32
            first = np.flatnonzero(np.diff(one, prepend=-1))
            lengths = np.diff(first, append=len(one))
            to = np.arange(len(one)) + np.repeat(free[one[first]] - first, lengths)
            postings[to], weights[to] = at[example[rest]], weight[rest]
            free[one[first]] += lengths
        runs, start, kept = _runs(ends, postings, weights)
        scales = np.zeros(len(order))
        scales[at] = scale
        cells = [Cell(low, high, c, m, _peaks(m, BLOCK)) for low, high, c, m in zip(bounds[:-1].tolist(), bounds[1:].tolist(), columns, matrices, strict=True)]
        return cls(len(order), order, scales, runs, start, kept, postings, cells, centres, sketch)

    def nearest(self, vector: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine over 0, best first, ties by example."""
        ids, values = np.array(list(vector), np.int64), np.array(list(vector.values()), np.float64)
        return self.nearest_all(np.array([0, len(ids)]), ids, values, k)[0]

    def nearest_all(self, at: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """`nearest` of each vector; vector i has the dimensions ids[at[i]:at[i + 1]]. Texts of the same home cell go together. Sums
        are in single precision, and what comes within their error of the k-th best is added up again in double."""
        n = len(at) - 1
        row = np.repeat(np.arange(n), np.diff(at))
        home = np.zeros(n, np.int64)
        for low in range(0, n, 1024):
            span = slice(at[low], at[min(low + 1024, n)])
            home[low : low + 1024] = np.argmax(_matrix(row[span] - low, self.sketch[ids[span]], values[span], min(1024, n - low), len(self.centres)) @ self.centres, axis=1)
        out: list = [None] * n
        for cell in range(len(self.cells)):
            same = np.flatnonzero(home == cell)
            for first in range(0, len(same), TOGETHER):
                group = same[first : first + TOGETHER]
                for i, found in zip(group.tolist(), self._group(group, cell, at, ids, values, k), strict=True):
                    out[i] = found
        return out

    def _sums(self, first: np.ndarray, count: np.ndarray, values: np.ndarray, lists: list[np.ndarray], out: np.ndarray) -> None:
        """The postings' sums for every place: of dimensions with `count` runs from `first` on, whose postings are `lists`."""
        own = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)  # the runs of all dimensions
        each = np.repeat(np.repeat(values, count) * self.weight[own], self.start[own + 1] - self.start[own])
        places = np.concatenate([self.postings[:0], *lists]).astype(np.intp)  # copied whole, not gathered
        np.multiply(np.bincount(places, each, self.size), self.scale, out=out, casting="same_kind")

    def _group(self, group: np.ndarray, home: int, at: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int):
        own = np.concatenate([np.arange(at[i], at[i + 1]) for i in group])
        lengths = np.diff(at)[group]
        row, ids, values = np.repeat(np.arange(len(group)), lengths), ids[own], values[own]
        # Each dimension's postings are looked up once for all these texts; those without any are left out.
        asked, which = np.unique(ids, return_inverse=True)
        first, end = self.runs[asked], self.runs[asked + 1]
        lists = [self.postings[b:e] for b, e in zip(self.start[first].tolist(), self.start[end].tolist(), strict=True)]
        some = np.flatnonzero((end > first)[which])
        which, bounds = which[some], np.searchsorted(some, np.concatenate([[0], np.cumsum(lengths)]))
        sums = np.empty((len(group), self.size), np.float32)
        for j, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            mine = which[low:high]
            self._sums(first[mine], (end - first)[mine], values[some[low:high]], [lists[i] for i in mine.tolist()], sums[j])
        least = np.full(len(group), SINGLE)
        best: list[list] = [[] for _ in group]
        for c in [home, *[c for c in range(len(self.cells)) if c != home]]:
            cell = self.cells[c]
            if cell.high == cell.low:
                continue
            asked = _matrix(row, cell.column[ids], values, len(group), len(cell.matrix))
            part = sums[:, cell.low : cell.high]
            open_ = (_peaks(part, BLOCK) + asked @ cell.peaks >= least[:, None] - SINGLE).any(axis=0)
            self.blocks += len(open_)
            self.opened += int(open_.sum())
            if not open_.any():
                continue
            # Rows of the dimensions asked for, and columns of the opened blocks; the matrix as it lies where they are most of it.
            used = np.flatnonzero(asked.any(axis=0))
            few = 4 * len(used) < 3 * len(cell.matrix)
            own, rows = (asked[:, used], cell.matrix[used]) if few else (asked, cell.matrix)
            if open_.mean() > 0.5:
                columns, total = np.arange(cell.high - cell.low), own @ rows
                total += part
            else:
                columns = np.flatnonzero(np.repeat(open_, BLOCK))
                total = part[:, columns] + own @ rows[:, columns]
            tops = _strided(total)
            if tops.shape[1] > k:  # k of these are k examples
                least = np.maximum(least, np.partition(tops, tops.shape[1] - k, axis=1)[:, -k])
            for j, (bar, peak) in enumerate(zip((least - SINGLE).tolist(), tops.max(axis=1).tolist(), strict=True)):
                if peak >= bar:
                    near = np.flatnonzero(total[j] >= bar)
                    cosines = part[j, columns[near]] + asked[j].astype(np.float64) @ cell.matrix[:, columns[near]].astype(np.float64)
                    best[j].append((self.order[cell.low + columns[near]], cosines))
        for parts in best:
            examples = np.concatenate([p[0] for p in parts] or [self.order[:0]])
            cosines = np.concatenate([p[1] for p in parts] or [np.zeros(0)])
            first = np.lexsort((examples, -np.round(cosines, 7)))[:k]
            first = first[cosines[first] > SINGLE]
            yield examples[first], cosines[first]


def _places(examples: int) -> type:
    """The shortest whole numbers for the places of so many examples in cells of whole blocks."""
    return np.uint16 if examples + CELLS * BLOCK < 1 << 16 else np.int32


def _frequent(held: np.ndarray, size: int) -> np.ndarray:
    """Places of the dimensions that more than a `DENSE_SHARE`-th of the examples have, most frequent first, `DENSE` at most; -1 for others."""
    common = np.flatnonzero(held * DENSE_SHARE > size)
    common = common[np.argsort(-held[common], kind="stable")][:DENSE]
    column = np.full(len(held), -1, np.int16)
    column[common] = np.arange(len(common))
    return column


def _runs(ends: np.ndarray, postings: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first run of a dimension, first posting of a run, its weight); the postings, which begin at `ends`, are put in the order
    of their runs a slab at a time."""
    runs, lengths, kept = np.zeros(len(ends), np.int32), [], []
    low = 0
    while low < len(ends) - 1:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + SLAB, side="right")) - 1)
        span = slice(ends[low], ends[high])
        # Weights are over 0: in the order of their bits.
        order = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1])) << 32 | weights[span].view(np.int32)
        by = np.argsort(order, kind="stable")
        order, postings[span] = order[by], postings[span][by]
        first = np.flatnonzero(np.diff(order, prepend=-1))
        lengths.append(np.diff(first, append=len(order)).astype(np.int32))
        kept.append(weights[span][by[first]])
        runs[low + 1 : high + 1] = np.bincount(order[first] >> 32, minlength=high - low)
        low = high
    start = np.zeros(sum(map(len, lengths)) + 1, np.int64 if len(postings) >> 31 else np.int32)
    np.cumsum(np.concatenate([start[:0], *lengths]), out=start[1:])
    return np.cumsum(runs, dtype=np.int32), start, np.concatenate([weights[:0], *kept])


def _peaks(rows: np.ndarray, length: int) -> np.ndarray:
    """The largest of each `length` columns in turn."""
    return rows.reshape(len(rows), rows.shape[1] // length, length).max(axis=2)


def _strided(rows: np.ndarray) -> np.ndarray:
    """The largest of STRIDE columns each, far apart, so that whole stretches are compared at once."""
    return rows.reshape(len(rows), STRIDE, rows.shape[1] // STRIDE).max(axis=1)


def _matrix(row: np.ndarray, place: np.ndarray, values: np.ndarray, rows: int, places: int) -> np.ndarray:
    """(row, place) of the values that have a place."""
    there = place >= 0
    out = np.zeros((rows, places), np.float32)
    out[row[there], place[there]] = values[there]
    return out


def _cells(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres as columns, and each example's cell: spherical k-means from seeded draws among the longest vectors."""
    size = dense.shape[1]
    if not size or not len(dense):
        return np.zeros((len(dense), 1), np.float32), np.zeros(size, np.int64)
    longest = np.argsort(-np.einsum("ij,ij->j", dense, dense), kind="stable")[: max(1, size // 2)]
    centres = dense[:, np.random.default_rng(CELLS).choice(longest, min(CELLS, len(longest)), replace=False)]
    for _ in range(CELL_ROUNDS):
        own = np.argmax(centres.T @ dense, axis=0)
        sums = np.stack([dense[:, own == c].sum(axis=1) for c in range(centres.shape[1])], axis=1)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=0), 1e-9)
    return centres.astype(np.float32), np.argmax(centres.T @ dense, axis=0)


def _packed(batches):
    """Rows (order, size, payload): each batch of examples, its sorted dimensions, `size` in all, as steps, compressed."""
    for batch in batches:
        if not batch.num_rows:
            continue
        terms = batch.column(3)
        steps = np.diff(terms.flatten().to_numpy(), prepend=np.int32(0)).astype(np.int32)
        own = pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.ListArray.from_arrays(pa.array(terms.offsets.to_numpy() - terms.offsets[0].as_py()), pa.array(steps)), batch.column(4)],
            ["id", "toxic", "steps", "counts"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)[:1], pa.array([len(steps)], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["order", "size", "payload"])


def _unpacked(payloads: list[tuple[int, bytes]]):
    """The batches that `_packed` made, one at a time."""
    for _, payload in payloads:
        yield from pa.ipc.open_stream(payload)


def _few(batch):
    """(numbers of dimensions, dimensions, counts) of UNPACKED examples of the batch at a time."""
    last = np.int32(0)
    for low in range(0, batch.num_rows, UNPACKED):
        few = batch.slice(low, UNPACKED)
        dimension = np.cumsum(few.column(2).flatten().to_numpy(), dtype=np.int32) + last  # steps go on through the whole batch
        last = dimension[-1] if len(dimension) else last
        yield np.diff(few.column(2).offsets.to_numpy()), dimension, few.column(3).flatten().to_numpy()


class Learned:
    """The labelled examples as workers need them: `index`, `weights` of the dimensions, `toxic` (1 or 0) and `ids`. It is
    shipped as the packed batches that tasks made, a few bytes a word, and unpacked once per worker: the driver hands
    them on and never unpacks one."""

    def __init__(self, batches: list[tuple[int, bytes]], held: np.ndarray, total: int, telling: list[float]):
        self.packed = batches, (held.dtype.str, zlib.compress(np.ascontiguousarray(held), 1)), total, telling

    def __getstate__(self):
        return self.packed

    def __setstate__(self, packed):
        payloads, (kind, held), total, telling = packed
        held = np.frombuffer(zlib.decompress(held), kind)
        self.weights = np.log((1 + total) / (1 + held)) + 1
        self.weights[DIMENSIONS:] = TELLING * np.array(telling)
        toxic, ids, scale, own = [], [], [], np.zeros(len(held), np.int64)
        for batch in _unpacked(payloads):
            toxic.append(np.array(batch.column(1).to_numpy(), np.float64))
            ids += batch.column(0).to_pylist()
            for lengths, dimension, counts in _few(batch):
                own += np.bincount(dimension, minlength=len(own))
                row = np.repeat(np.arange(len(lengths)), lengths)
                squares = np.bincount(row, _weights(dimension, counts, self.weights) ** 2, len(lengths))
                scale.append(1 / np.sqrt(np.where(squares > 0, squares, 1)))  # an example without words has no weights

        def parts():
            at = 0
            for batch in _unpacked(payloads):
                for lengths, dimension, counts in _few(batch):
                    yield np.repeat(np.arange(at, at + len(lengths)), lengths), dimension, _weights(dimension, counts, self.weights)
                    at += len(lengths)

        self.toxic, self.ids = np.concatenate(toxic), np.array(ids)
        self.index = BlockMaxIndex.made(parts, np.concatenate(scale), own)

    def nearest(self, batch, k: int):
        """The k nearest examples of each row of a tally."""
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield from self.index.nearest_all(*_vectors(batch.slice(at, ROWS_AT_ONCE), self.weights), k)


@dataclass
class Model:
    """What scores texts. The index and the weights of the dimensions are large: workers read them from `held`."""

    terms: dict[str, int]  # telling terms and their dimensions
    heads: set[str] = field(default_factory=set)
    held: Broadcast | None = None  # of Learned
    text_ids: bool = False
    prior: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    _words: dict = field(default_factory=dict, repr=False)
    _single: set[bytes] = field(default_factory=set, repr=False)  # chunks that need a closer look and are one word all the same
    _heads: set[bytes] | None = field(default=None, repr=False)

    def places(self, chunk: bytes) -> tuple[int, ...]:
        """Numbers of the chunk's words and telling terms: a word's hash over all dimensions, and -1 less the dimension of a telling term."""
        if (known := self._words.get(chunk)) is None:
            parts = [p for w in words_of(chunk) for p in pieces(w)]
            known = (*[zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in parts],
                     *[-1 - self.terms[t] for p in parts if p[:HEAD] in self.heads for t in word_terms(p) if t in self.terms])
            if len(self._words) + len(self._single) > WORDS_KEPT:
                self._words.clear()
                self._single.clear()
            if known == (zlib.crc32(chunk),):
                self._single.add(chunk)
            else:
                self._words[chunk] = known
        return known

    def hashed(self, text: str | None, numbers: array, counts: array) -> None:
        """Adds the numbers of all words of the text, each with its count; a number can come more than once."""
        found = Counter(chunks(text))
        if self._heads is None:
            self._heads = {h.encode("utf-8", "surrogatepass") for h in self.heads}
        heads, single = self._heads, self._single
        for chunk in [c for c in found if (not c.isascii() or len(c) > LONG_RUN or c[:HEAD] in heads) and c not in single]:
            known, n = self.places(chunk), found.pop(chunk)
            numbers.extend(known)
            counts.extend([n] * len(known))
        numbers.extend(map(zlib.crc32, found))  # single words, as most are
        counts.extend(found.values())

    def counts(self, text: str | None) -> dict[int, int]:
        """Counts of the dimensions of all words of the text."""
        numbers, counts = array("q"), array("q")
        self.hashed(text, numbers, counts)
        _, dimensions, summed = _tallied([0, len(numbers)], numbers, counts)
        return dict(zip(dimensions.tolist(), summed.tolist(), strict=True))

    def telling(self, chunk: bytes) -> set[str]:
        """The telling terms of a chunk."""
        return {t for w in words_of(chunk) for p in pieces(w) if p[:HEAD] in self.heads for t in word_terms(p) if t in self.terms}

    def vote(self, toxic: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic among the neighbours, weighted by cosine, with the prior as one weak neighbour."""
        return (float(cosines @ toxic) + PRIOR_WEIGHT * self.prior) / (float(cosines.sum()) + PRIOR_WEIGHT)

    def calibrated(self, vote: float) -> float:
        return 1 / (1 + math.exp(-(self.slope * _logit(vote) + self.shift)))

    def scores(self, batch) -> list[tuple[float, list, list[float]]]:
        """(score, ids of the examples it rests on, their cosines) of each row of a tally."""
        if self.held is None:
            return [(self.prior, [], [])] * batch.num_rows
        own = self.held.value
        return [(self.calibrated(self.vote(own.toxic[near], cosines)), own.ids[near].tolist(), cosines.tolist())
                for near, cosines in own.nearest(batch, NEIGHBOURS)]


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _tallied(at: list[int], numbers: array, counts: array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, dimensions in ascending order, counts) of texts whose numbers are at[i] to at[i + 1] - 1."""
    hashed = np.array(numbers, np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = row << 32 | np.where(hashed < 0, -1 - hashed, hashed % DIMENSIONS)
    by = np.argsort(order)
    order = order[by]
    first = np.flatnonzero(np.diff(order, prepend=-1))
    summed = np.add.reduceat(np.array(counts, np.int64)[by], first) if len(first) else first
    order = order[first]
    return np.searchsorted(order, np.arange(len(at)) << 32).astype(np.int32), (order & 0xFFFFFFFF).astype(np.int32), summed.astype(np.int32)


def _counted(batches, terms_of):
    """(term, toxic, n) of whole batches: in how many texts of either label a term is. `terms_of` gives those of a chunk; a text's are
    put together from its chunks' as numbers."""
    for batch in batches:
        toxic, known, at, found = batch.column(1).to_numpy(), {}, [0], array("i")
        for text in batch.column(0):
            found.extend([known.setdefault(c, len(known)) for c in set(chunks(text.as_py()))])
            at.append(len(found))
        numbers, ends, terms = {}, array("q", [0]), array("i")
        for chunk in known:
            terms.extend([numbers.setdefault(t, len(numbers)) for t in terms_of(chunk)])
            ends.append(len(terms))
        found, ends, terms = np.array(found, np.int64), np.array(ends), np.array(terms, np.int64)
        counts = np.zeros((2, len(numbers)), np.int64)
        for low in range(0, len(toxic), COUNTED):
            at_once = at[low : low + COUNTED + 1]
            own = found[at_once[0] : at_once[-1]]
            lengths = ends[own + 1] - ends[own]
            row = np.repeat(np.repeat(np.arange(len(at_once) - 1), np.diff(at_once)), lengths)
            place = np.arange(len(row)) + np.repeat(ends[own] - np.cumsum(lengths) + lengths, lengths)
            pairs = np.sort(row << 32 | terms[place])
            pairs = pairs[np.diff(pairs, prepend=-1) != 0]
            for y in (0, 1):
                counts[y] += np.bincount((pairs & 0xFFFFFFFF)[toxic[low + (pairs >> 32)] == y], minlength=len(numbers))
        label, term = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(numbers), pa.string()).take(pa.array(term)), pa.array(label, pa.int32()), pa.array(counts[label, term])], ["term", "toxic", "n"])


def _all_terms(chunk: bytes) -> set[str]:
    return {t for w in words_of(chunk) for p in pieces(w) for t in word_terms(p)}


def _sums(texts: DataFrame, terms_of) -> DataFrame:
    return texts.mapInArrow(lambda b: _counted(b, terms_of), "term string, toxic int, n long").groupBy("term", "toxic").agg(F.sum("n").alias("n"))


def _g2(a: float, b: float, toxic: float, clean: float) -> float:
    total, hits = toxic + clean, a + b
    cells = ((a, toxic * hits / total), (b, clean * hits / total), (toxic - a, toxic * (total - hits) / total), (clean - b, clean * (total - hits) / total))
    return 2 * sum(x * math.log(x / e) for x, e in cells if x > 0 and e > 0)


def _telling_terms(counts: dict[str, list[int]], toxic: int, clean: int) -> dict[str, float]:
    """The terms that speak for toxic clearly, with their log odds; of beginnings and words met in the same texts the longest."""
    good = []
    for term, (b, a) in counts.items():
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if odds > MIN_ODDS and _g2(a, b, toxic, clean) >= MIN_G2:
            good.append((len(term), term, (a, b, term[:HEAD]), odds))
    longest: dict[tuple, tuple] = {}
    for row in sorted(good):
        longest[row[2]] = row
    return {row[1]: row[3] for row in sorted(longest.values())}


def held_out(key: str = "doc_id"):
    """Rows no label is learned from: the CRC-32 of the id as text is a multiple of five."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


TALLY = [T.StructField("__terms", T.ArrayType(T.IntegerType())), T.StructField("__counts", T.ArrayType(T.IntegerType()))]


def tally(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` of `df` with `__terms` and `__counts`: the dimensions of all words of the whole text, each with its count."""
    own = replace(model, held=None)
    source = df.select(F.col(text).alias("__tallied"), *keep)

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(low, ROWS_AT_ONCE)
                at, numbers, counts = [0], array("q"), array("q")
                for t in batch.column(0):
                    own.hashed(t.as_py(), numbers, counts)
                    at.append(len(numbers))
                offsets, *both = _tallied(at, numbers, counts)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in both]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *lists], [*keep, "__terms", "__counts"])

    return source.mapInArrow(run, T.StructType([*source.schema.fields[1:], *TALLY]))


def _vectors(batch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, dimensions, weights) of the unit vectors of a tally, its last two columns; empty without words."""
    terms, counts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    at = terms.offsets.to_numpy().astype(np.int64)
    ids = terms.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), np.diff(at))
    return at - at[0], ids, _unit(row, ids, counts.flatten().to_numpy(), weights, batch.num_rows)


def _weights(ids: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(1 + log count) times the dimension's; most counts are small, so their logarithms are looked up."""
    if counts.max(initial=1) < len(LEVELS):
        return LEVELS[counts] * weights[ids]
    return (1 + np.log(counts)) * weights[ids]


def _unit(row: np.ndarray, ids: np.ndarray, counts: np.ndarray, weights: np.ndarray, rows: int) -> np.ndarray:
    """Weights of the counts, each row scaled to a length of 1."""
    values = _weights(ids, counts, weights)
    return values / np.sqrt(np.bincount(row, values * values, rows))[row]


def _frequencies(tallied: DataFrame, dimensions: int) -> np.ndarray:
    """In how many texts each dimension is."""

    def run(batches):
        held = np.zeros(dimensions, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=dimensions)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["term", "n"])

    sums = tallied.select("__terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(dimensions, np.int64)
    held[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return held


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    """The model of `fit_and_tally` alone, for scoring other rows."""
    return fit_and_tally(docs, labels, [], key, text, max_labelled)[0]


def fit_and_tally(
    docs: DataFrame, labels: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED
) -> tuple[Model, DataFrame]:
    """A model from the labelled rows that are not held out, at most about `max_labelled` of them, and the tally of
    all rows of `docs` that its inverse document frequencies were counted on, with the columns `keep`.

    Votes are calibrated by a logistic curve fitted on the examples, each voted on by its neighbours other than
    itself. Without labels every score is 0; with one label only it is that label's
    share. Labels without an id or a value are not used; repeated labels of an id count once, toxic if any says so.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & ~held_out(key)).groupBy(key).agg(
        F.max("toxic").cast("int").alias("__toxic"))
    n = known.count()
    share = F.pmod(F.xxhash64(F.lit("labels"), F.col(key)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_labelled / max(n, 1)))
    # The sample is bounded by `max_labelled`, a few hundred kilobytes.
    sample = F.broadcast(known.where(share))
    rows, _ = stored(docs.select(key, F.col(text).alias("__text")).join(sample, key).select("__text", "__toxic", F.col(key).alias("__id")), "labelled")
    totals = {r[0]: r[1] for r in rows.groupBy("__toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    prior = toxic / max(1, toxic + clean)
    model = Model({}, prior=prior)
    if not toxic or not clean:
        return model, tally(docs, model, keep, text)
    # Only terms met in a few toxic texts can be telling; the others are never counted among the clean ones.
    least = max(3, math.ceil(MIN_G2 / (2 * math.log((toxic + clean) / toxic)) * 0.5))
    first = {r["term"]: r["n"] for r in _sums(rows.where("__toxic = 1"), _all_terms).where(F.col("n") >= least).collect()}
    trial = Model(dict.fromkeys(first, 0), {t.rstrip("$")[:HEAD] for t in first})
    counts = {t: [0, n] for t, n in first.items()}
    for r in _sums(rows.where("__toxic = 0"), trial.telling).collect() if first else ():
        counts[r["term"]][0] = r["n"]
    odds = _telling_terms(counts, toxic, clean)
    model.terms = {t: DIMENSIONS + i for i, t in enumerate(odds)}
    model.heads = {t.rstrip("$")[:HEAD] for t in odds}
    # The texts are read once: frequencies are counted on the tally, and scores are worked out from it.
    tallied, _ = stored(tally(docs, model, keep, text), "tally")
    held, total = _frequencies(tallied, DIMENSIONS + len(odds)), tallied.count()
    examples, _ = stored(tally(rows, model, ["__id", "__toxic"], "__text"), "examples")
    # All examples, in an order that does not know the label.
    ordered = examples.select(F.xxhash64(F.lit("order"), "__id").alias("__order"), "*").orderBy("__order", "__id")
    model.text_ids = not isinstance(examples.schema["__id"].dataType, T.IntegralType)
    payloads = [(r["size"], bytes(r["payload"])) for r in ordered.mapInArrow(_packed, "order long, size long, payload binary").orderBy("order").toLocalIterator()]
    model.held = spark.sparkContext.broadcast(Learned(payloads, held, total, list(odds.values())))

    def votes(batches):
        own = model.held.value
        for batch in batches:
            out = []
            for key, (near, cosines) in zip(batch.column(0).to_pylist(), own.nearest(batch, NEIGHBOURS + 1), strict=True):
                others = own.ids[near] != key
                out.append(model.vote(own.toxic[near[others]][:NEIGHBOURS], cosines[others][:NEIGHBOURS]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), batch.column(1)], ["vote", "toxic"])

    pairs = examples.mapInArrow(votes, "vote double, toxic int").groupBy(F.round("vote", 4).alias("vote"), "toxic").count().orderBy("vote", "toxic").collect()
    model.slope, model.shift = _logistic(
        np.array([_logit(r["vote"]) for r in pairs]), np.array([float(r["toxic"]) for r in pairs]), np.array([float(r["count"]) for r in pairs]))
    return model, tallied


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps on the counts, slightly held to (1, 0)."""
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(beta[0] * x + beta[1])))
        grad = np.array([(n * (p - y) * x).sum(), (n * (p - y)).sum()]) + (beta - [1, 0])
        s = n * p * (1 - p)
        step = np.linalg.solve(np.array([[(s * x * x).sum() + 1, (s * x).sum()], [(s * x).sum(), s.sum() + 1]]), grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-10:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with `score`, `neighbours` (ids of the examples behind it) and `cosines`. Columns of these names are
    replaced; NULL and empty texts get the score of a text without words."""
    base = df.drop("score", "neighbours", "cosines")
    return score_tally(tally(base, model, base.columns, text), model)


def score_tally(tallied: DataFrame, model: Model) -> DataFrame:
    """As `score`, of rows that are tallied already; the tally is dropped."""
    names = tallied.columns[:-2]

    def run(batches):
        for batch in batches:
            out = model.scores(batch)
            ids = [[str(i) for i in r[1]] if model.text_ids else r[1] for r in out]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array([r[0] for r in out], pa.float64()),
                 pa.array(ids, pa.list_(pa.string() if model.text_ids else pa.int64())), pa.array([r[2] for r in out], pa.list_(pa.float64()))],
                [*names, "score", "neighbours", "cosines"],
            )

    schema = T.StructType([*tallied.schema.fields[:-2], T.StructField("score", T.DoubleType()),
                           T.StructField("neighbours", T.ArrayType(T.StringType() if model.text_ids else T.LongType())),
                           T.StructField("cosines", T.ArrayType(T.DoubleType()))])
    return tallied.mapInArrow(run, schema)


def drop_toxic(
    df: DataFrame, labels: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """The rows of `df` whose score is below the threshold, with the columns of `df`."""
    marked = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.struct(*df.columns).alias("__row"))
    model, tallied = fit_and_tally(marked, labels.withColumnRenamed(key, "__key"), ["__row"], "__key", "__text", max_labelled)
    return score_tally(tallied, model).where(F.col("score") < threshold).select("__row.*")


@query("op7_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_tally(*reversed(fit_and_tally(docs, table(spark, sf_dir, "labels"), ["doc_id"])))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "cosines",
    )

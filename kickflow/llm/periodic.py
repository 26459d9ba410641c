"""Periodic runs of words, found by block convolution.

At the scale of L words (8, 16, 32, ...) a text is cut into blocks of L words. A run of period q,
L <= q < 2 L (1 <= q < 16 at the first scale), that is long enough to count has a whole block
that occurs again q words later. The sum of squared differences between a block and every place
of the window after it is one convolution, done exactly in integers by number-theoretic
transforms; a sum of zero is an occurrence, and its distance the seed of a run, which is then
extended word by word to both sides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count, islice, pairwise
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import bounded_batches, slices

LEAST_WORDS, LEAST_PERIODS = 24, 3
FIRST_SCALE = 8
# Longest part of a block that is convolved at once. The first words of a longer block stand for it.
LONGEST = 1 << 16
# Cells of the matrices of a pass.
CELLS = 1 << 18
# A transform of up to so many points is one product of matrices; larger ones are split.
POINTS = 64
# Below 2^24, sums of POINTS products of residues (2^23 at most) are exact in a double.
PRIME_BITS = 24


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


@cache
def primes(points: int) -> list[int]:
    """Primes that have roots of unity of this order, the largest first."""
    candidates = (c * points + 1 for c in range((1 << PRIME_BITS) // points, 0, -1))
    return list(islice(filter(is_prime, candidates), 4))


@cache
def root(points: int, p: int) -> int:
    """A root of unity of exactly this order (a power of two)."""
    return next(w for g in range(2, p) if pow(w := pow(g, (p - 1) // points, p), points // 2, p) == p - 1)


def reduced(x: np.ndarray, p: int) -> np.ndarray:
    """The residue of least size, exact for integers below 2^53."""
    x -= np.rint(x * (1 / p)) * p
    return x


@cache
def powers(rows: int, columns: int, w: int, p: int) -> np.ndarray:
    """``w ** (row * column)``."""
    out = np.ones((rows, columns))
    line = np.ones(columns, np.int64)
    step = np.array([pow(w, k, p) for k in range(columns)], np.int64)
    for row in range(1, rows):
        line = line * step % p
        out[row] = line
    return reduced(out, p)


def transform(x: np.ndarray, w: int, p: int) -> np.ndarray:
    """Number-theoretic transform of each row, in an order of its own; ``back`` undoes it."""
    rows, n = x.shape
    if n <= POINTS:
        return reduced(x @ powers(n, n, w, p), p)
    inner = n // POINTS
    parts = x.reshape(rows, POINTS, inner).transpose(0, 2, 1) @ powers(POINTS, POINTS, pow(w, inner, p), p)
    parts = reduced(reduced(parts, p).transpose(0, 2, 1) * powers(POINTS, inner, w, p), p)
    return transform(parts.reshape(-1, inner), pow(w, POINTS, p), p).reshape(rows, n)


def back(x: np.ndarray, w: int, p: int) -> np.ndarray:
    """The inverse of ``transform`` but for the factor n; takes the inverse root."""
    rows, n = x.shape
    if n <= POINTS:
        return reduced(x @ powers(n, n, w, p), p)
    inner = n // POINTS
    parts = back(x.reshape(-1, inner), pow(w, POINTS, p), p).reshape(rows, POINTS, inner)
    parts = reduced(parts * powers(POINTS, inner, w, p), p).transpose(0, 2, 1)
    return reduced(parts @ powers(POINTS, POINTS, pow(w, inner, p), p), p).transpose(0, 2, 1).reshape(rows, n)


def occurrences(blocks: np.ndarray, windows: np.ndarray, top: int) -> np.ndarray:
    """Where each row's block occurs in its window: true at a place of no difference at all.

    Values are integers from 0 to ``top``, windows as wide as a power of two. A sum of squared differences is zero if it is so by
    as many primes as it takes for their product to exceed the largest such sum.
    """
    rows, size = blocks.shape
    points = windows.shape[1]
    places = points - size + 1
    squares = np.cumsum(np.pad(windows.astype(np.int64) ** 2, ((0, 0), (1, 0))), axis=1)
    squares = squares[:, size : size + places] - squares[:, :places]
    squares += (blocks.astype(np.int64) ** 2).sum(1)[:, None]
    bits = log2(size * top * top + 1)
    found = np.ones((rows, places), bool)
    for p in primes(points):
        w = root(points, p)
        a = reduced(np.pad(blocks.astype(np.float64), ((0, 0), (0, points - size))), p)
        b = reduced(windows.astype(np.float64), p)
        # The block's transform by the inverse root turns the convolution into a correlation.
        product = reduced(transform(b, w, p) * transform(a, pow(w, -1, p), p), p)
        sums = back(product, pow(w, -1, p), p)[:, :places]
        sums = reduced(sums * float(pow(points, -1, p)), p)
        found &= (squares - 2 * sums.astype(np.int64)) % p == 0
        bits -= log2(p)
        if bits < 0:
            break
    return found


class Text:
    """One text's words as numbers, and the runs found in it so far."""

    def __init__(self, words: list[bytes]):
        self.words = words
        number: dict[bytes, int] = defaultdict(count(1).__next__)
        self.ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.top = len(number)
        # The period of each run, by its start and end.
        self.runs: dict[tuple[int, int], int] = {}

    def extend(self, starts: np.ndarray, distance: int) -> None:
        """Grow the seeds of one distance to runs; the smallest period of a stretch is kept."""
        x, q, end = self.ids, distance, -1
        for start in starts.tolist():
            if start < end:
                continue
            # Words q apart agree from start to end, which is then moved on to the last such word.
            end = start + _agree(x[start + q :], x[start:])
            first = start - _agree(x[: start + q][::-1], x[:start][::-1])
            if end + q - first >= max(LEAST_WORDS, LEAST_PERIODS * q):
                key = (first, end + q)
                self.runs[key] = min(q, self.runs.get(key, q))

    def reach(self, most: int) -> np.ndarray:
        """For each place, the furthest end of a run from there or before of period ``most`` at most.

        Seeds that lie in such a run as a whole only give that run again: a stretch as long as
        the sum of two of its periods has their greatest common divisor as a period.
        """
        out = np.zeros(len(self.ids) + 1, np.int64)
        for (start, end), q in self.runs.items():
            if q <= most:
                out[start] = max(out[start], end)
        return np.maximum.accumulate(out)

    def found(self) -> list[tuple[int, int, int]]:
        """All runs: start, length, period."""
        return sorted((start, end - start, q) for (start, end), q in self.runs.items())

    def kept(self) -> list[bytes]:
        """The words that no run holds after its first period."""
        change = np.zeros(len(self.ids) + 1, np.int64)
        for (start, end), q in self.runs.items():
            change[start + q] += 1
            change[end] -= 1
        gone = np.cumsum(change)[:-1] > 0
        return [word for word, drop in zip(self.words, gone.tolist(), strict=True) if not drop]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common beginning."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        part = min(step, n - at)
        differ = a[at : at + part] != b[at : at + part]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + part, step * 2
    return n


def seeds(texts: list[Text], scale: int) -> Iterator[tuple[Text, np.ndarray, np.ndarray]]:
    """Per text, starts of blocks and the distances at which they occur again, at one scale."""
    least, most = (1 if scale == FIRST_SCALE else scale), 2 * scale - 1
    size = min(scale, LONGEST)
    wide = 2 * size
    limit = max(1, CELLS // wide)
    blocks = []
    for text in texts:
        n = len(text.ids)
        starts = np.arange(0, n - size - least + 1, scale)
        if text.runs:
            last = np.minimum(starts + most + size, n)
            starts = starts[text.reach(size)[starts] < last]
        blocks.append((text, starts))
    for offset in range(least, most + 1, wide - size + 1):
        part: list[tuple[Text, np.ndarray]] = []
        rows = 0
        for text, starts in blocks:
            starts = starts[: np.searchsorted(starts, len(text.ids) - offset - size, "right")]
            at = 0
            while at < len(starts):
                some = starts[at : at + limit - rows]
                part.append((text, some))
                at += len(some)
                rows += len(some)
                if rows == limit:
                    yield from _located(part, size, offset, most)
                    part, rows = [], 0
        if part:
            yield from _located(part, size, offset, most)


def _located(
    part: list[tuple[Text, np.ndarray]], size: int, offset: int, most: int
) -> Iterator[tuple[Text, np.ndarray, np.ndarray]]:
    blocks = np.concatenate([_words(text.ids, starts, size) for text, starts in part])
    windows = np.concatenate([_words(text.ids, starts + offset, 2 * size) for text, starts in part])
    row, place = np.nonzero(occurrences(blocks, windows, max(text.top for text, _ in part)))
    distance = place + offset
    row, distance = row[distance <= most], distance[distance <= most]
    ends = np.cumsum([len(starts) for _, starts in part])
    start, first = 0, 0
    for (text, starts), end, stop in zip(part, ends, np.searchsorted(row, ends), strict=True):
        if start < stop:
            yield text, starts[row[start:stop] - first], distance[start:stop]
        start, first = stop, end


def _words(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """``size`` words from each start; 0, which is no word, after the text's end."""
    at = starts[:, None] + np.arange(size)
    return np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], 0)


def find_runs(texts: list[Text]) -> None:
    """All runs of each text, those of small periods first."""
    scale = FIRST_SCALE
    # Texts of like length together, as the largest decides how many primes it takes.
    texts = sorted(texts, key=lambda t: len(t.ids))
    while texts := [t for t in texts if len(t.ids) >= max(LEAST_WORDS, LEAST_PERIODS * (scale if scale > FIRST_SCALE else 1))]:
        size = min(scale, LONGEST)
        gathered: dict[int, tuple[Text, list, list]] = {}
        for text, starts, distances in seeds(texts, scale):
            _, s, d = gathered.setdefault(id(text), (text, [], []))
            s.append(starts)
            d.append(distances)
        for text, s, d in gathered.values():
            starts, distances = np.concatenate(s), np.concatenate(d)
            new = text.reach(size)[starts] < starts + distances + size
            starts, distances = starts[new], distances[new]
            order = np.lexsort((starts, distances))
            starts, distances = starts[order], distances[order]
            cuts = [0, *(np.flatnonzero(np.diff(distances)) + 1).tolist(), len(starts)]
            for a, b in pairwise(cuts):
                if a < b:
                    text.extend(starts[a:b], int(distances[a]))
        scale *= 2


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    A text's words are its longest stretches without ASCII white space, numbered from 0. A run is
    a stretch of at least 24 words and three periods, of smallest period ``period``, that no word
    beside it continues. ``collapsed`` has the words, joined by single spaces, that no run holds
    after its first period. A null or empty text has no runs and collapses to an empty one.
    Repeated rows stay repeated, no rows give none. A column already named so is replaced; all
    others stay as they are.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop("runs", "collapsed")
    none = F.lit(None).cast("array<struct<start:long,length:long,period:long>>")
    schema = docs.select("*", none.alias("runs"), F.lit("").alias("collapsed")).schema
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            given = batch.column(text).to_pylist()
            texts = [Text((x or "").encode("utf-8").split()) for x in given]
            find_runs(texts)
            names = ("start", "length", "period")
            runs = [[dict(zip(names, r, strict=True)) for r in t.found()] for t in texts]
            kept = [b" ".join(t.kept() if t.runs else t.words).decode("utf-8") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(runs, run_type), pa.array(kept, pa.string())],
                [*batch.schema.names, "runs", "collapsed"],
            )

    return docs.mapInArrow(run, schema)

"""What several corpus operators share: stored steps, batches of rows, words and shingles."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickflow.session import shared_folder

WORDS = 5
SIMILARITY = 0.8
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20

_U = np.uint64


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: lineage ends, a lost executor loses nothing."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Let the driver give back what plans, generated classes and broadcasts of done steps took.

    A driver makes little garbage, so it would keep them until its heap is full.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()


_resident: dict = {}


def resident(key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for the next tasks of this worker; what was kept before goes.

    A worker serves one operator after the other, and should hold the tables of one only.
    """
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches a task holds, in rows and bytes; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(
    batches: Iterator[pa.RecordBatch], text: str, most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one have at most ``most`` bytes (or are a single text)."""
    for batch in batches:
        sizes = np.diff(_offsets(batch.column(text)))
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def _offsets(column: pa.Array) -> np.ndarray:
    lengths = pa.compute.binary_length(column).fill_null(0)
    return np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))])


def words_of(text: F.Column) -> F.Column:
    """The text in lower case with single spaces between words; null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def shingles(texts: list[str], k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's runs of ``k`` words, and the number of runs per text.

    A text of fewer words has one run, all its words; a text without words has none.
    """
    split = [text.split() for text in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    if not n.sum():
        return np.zeros(0, _U), np.zeros(len(n), np.int64)
    flat = np.array([word for words in split for word in words], dtype=object)
    padded = np.concatenate([pd.util.hash_array(flat), np.zeros(k, _U)])
    ends = np.cumsum(n)
    left = np.repeat(ends, n) - np.arange(ends[-1])  # words from here to the end of the text
    first = left == np.repeat(n, n)
    at = np.flatnonzero((left >= k) | first)
    out = np.zeros(len(at), _U)
    for j in range(k):
        word = np.where(j < left[at], padded[at + j], _U(0))
        out = mix(out * _U(0x9E3779B97F4A7C15) + word + _U(j + 1))
    return out, np.where(n >= k, n - k + 1, np.minimum(n, 1))

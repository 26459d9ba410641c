"""Benchmark items inside documents: MinHash containment search by size, then an exact check."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from kickflow.llm.common import SIMILARITY, WORDS, bounded_batches, mix, shingles, slices, words_of

# An item has more than half the shingles of its size class's bound, or just one where the bound
# is one. So its minimum under a hash is that of its block with probability a third at least,
# and with 48 hashes a pair of containment 0.8 is missed with probability below 1e-6.
HASHES = 48
ITEMS_AT_ONCE = 20_000
WORDS_AT_ONCE = 2_000_000


def size_class(n: np.ndarray) -> np.ndarray:
    """The least power of two that is at least ``n``: the upper bound of a class.

    Blocks of one shingle compare every shingle of a text, so items of one are always found.
    """
    return 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


class Items:
    """A block of items: per size class and hash function the minima, sorted for look-up."""

    def __init__(self, ids: list, texts: list[str], words: int, hashes: int):
        self.seeds = mix(np.arange(1, hashes + 1, dtype=np.uint64))
        all_, n = shingles(texts, words)
        parts = np.split(all_, np.cumsum(n)[:-1])
        self.ids = [i for i, part in zip(ids, parts, strict=True) if len(part)]
        self.sets = [np.unique(part) for part in parts if len(part)]
        self.words = words
        bounds = size_class(np.array([len(x) for x in self.sets], np.int64))
        self.classes = []
        for bound in np.unique(bounds).tolist():
            members = np.flatnonzero(bounds == bound)
            tables = []
            for seed in self.seeds:
                least = np.array([mix(self.sets[i] ^ seed).min() for i in members], np.uint64)
                order = np.argsort(least, kind="stable")
                tables.append((least[order], members[order]))
            self.classes.append((bound, tables))

    def search(self, texts: list[str], least: float) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of every pair whose containment is at least ``least``.

        A text is cut into blocks of a class's upper bound, so that an item of this class can
        meet a block minimum however long the text is: if ``e`` is the item's minimum under a
        hash, and in the block, it is the block's with probability about |item| / (|item| +
        |block| - |both|), a third at least. Each equal minimum makes a candidate.
        """
        all_, n = shingles(texts, self.words)
        if not len(all_) or not self.sets:
            return []
        ends = np.cumsum(n)
        starts = ends - n
        text_of = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(all_)) - np.repeat(starts, n)
        cuts = [(np.flatnonzero(place % bound == 0), tables) for bound, tables in self.classes]
        found = set()
        for j, seed in enumerate(self.seeds):
            values = mix(all_ ^ seed)
            for at, tables in cuts:
                keys, members = tables[j]
                minima = np.minimum.reduceat(values, at)
                low = np.searchsorted(keys, minima, "left")
                near = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == minima)
                for block in near.tolist():
                    high = np.searchsorted(keys, minima[block], "right")
                    text = int(text_of[at[block]])
                    found.update((text, m) for m in members[low[block] : high].tolist())
        out = []
        sets: dict[int, np.ndarray] = {}
        for text, item in sorted(found):
            if text not in sets:
                sets = {text: np.unique(all_[starts[text] : ends[text]])}
            shared = len(np.intersect1d(self.sets[item], sets[text], assume_unique=True))
            if shared >= least * len(self.sets[item]) - 1e-9:
                out.append((text, item, shared))
        return out


def _item_blocks(
    items: DataFrame, id: str, text: str, words: int, hashes: int
) -> Iterator[Broadcast]:
    """The items in broadcast blocks of a bounded number and size; each is a pass over the texts."""
    rows = items.select(F.col(id).alias("id"), words_of(F.col(text)).alias("words"))
    ids, texts, held = [], [], 0
    for row in rows.where("words <> ''").distinct().orderBy("id", "words").toLocalIterator():
        size = row.words.count(" ") + 1
        if ids and (len(ids) >= ITEMS_AT_ONCE or held + size > WORDS_AT_ONCE):
            yield items.sparkSession.sparkContext.broadcast(Items(ids, texts, words, hashes))
            ids, texts, held = [], [], 0
        ids.append(row.id)
        texts.append(row.words)
        held += size
    if ids:
        yield items.sparkSession.sparkContext.broadcast(Items(ids, texts, words, hashes))


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    containment: float = SIMILARITY,
    hashes: int = HASHES,
) -> DataFrame:
    """Pairs of a document and an item of which it has at least ``containment``.

    Columns: ``doc_id``, ``item_id``, ``n_shared``, ``n_item`` (distinct runs of ``words``
    words), ``containment``. A text of fewer words is one run. Texts without words, and null
    texts, are in no pair. A null id stays null; rows that repeat a document repeat its pairs,
    repeated items count once. Other columns are not read. Documents are never shuffled.
    """
    bounded_batches(docs.sparkSession)
    schema = StructType(
        [
            StructField("doc_id", docs.schema[doc_id].dataType),
            StructField("item_id", items.schema[item_id].dataType),
            StructField("n_shared", LongType()),
            StructField("n_item", LongType()),
            StructField("containment", DoubleType()),
        ]
    )
    kind = to_arrow_type(schema["item_id"].dataType)
    rows = docs.select(F.col(doc_id).alias("id"), words_of(F.col(doc_text)).alias("words"))

    def search(block: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = block.value
            for batch in slices(batches, "words"):
                found = held.search(batch.column("words").to_pylist(), containment)
                shared = [s for _, _, s in found]
                sizes = [len(held.sets[m]) for _, m, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array([t for t, _, _ in found], pa.int64())),
                        pa.array([held.ids[m] for _, m, _ in found], kind),
                        pa.array(shared, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([s / n for s, n in zip(shared, sizes, strict=True)], pa.float64()),
                    ],
                    schema.names,
                )

        return rows.mapInArrow(run, schema)

    found = [search(x) for x in _item_blocks(items, item_id, item_text, words, hashes)]
    return reduce(DataFrame.unionAll, found, docs.sparkSession.createDataFrame([], schema))


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    containment: float = SIMILARITY,
    hashes: int = HASHES,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns, decided row by row."""
    bounded_batches(docs.sparkSession)
    whole = F.struct(*[docs[name] for name in docs.columns])
    rows = docs.select(whole.alias("whole"), words_of(docs[doc_text]).alias("words"))

    def clean(rows: DataFrame, block: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "words"):
                found = block.value.search(batch.column("words").to_pylist(), containment)
                bad = {text for text, _, _ in found}
                yield batch.filter(pa.array([i not in bad for i in range(len(batch))], pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    return reduce(
        clean, _item_blocks(items, item_id, item_text, words, hashes), rows
    ).select("whole.*")

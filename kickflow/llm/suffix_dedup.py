"""Repeated byte strings: anchored runs find suspects, external induced sorting decides them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import bounded_batches, mix, slices, stored
from kickflow.llm.induced import repeated

LENGTH = 400
# A window's anchor is the least of its hashed strings of this many bytes. Longer anchors meet
# by chance more rarely, shorter ones make fewer runs.
ANCHOR = 160
SHARD_BYTES = 8 << 20
# What is hashed at once; a longer text is hashed in pieces that overlap by a window.
PIECE = 2 << 20
ROWS_OUT = 4096

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1


class Rolling:
    """Hashes of any substring of some bytes, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        inverse = pow(BASE, -1, 1 << 64)
        table = mix(np.arange(256, dtype=_U) + _U(0x1234567))
        n = len(data)
        powers = np.full(n + 1, BASE, _U)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(table[data] * powers[:n], out=self.sums[1:])
        back = powers
        back[:] = inverse
        back[0] = 1
        self.back = np.multiply.accumulate(back, out=back)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def runs_of(data: np.ndarray, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of ``length`` bytes that have one anchor, over texts that end at ``ends``.

    Returns text number, first and last window of each run, the anchor's hash, and the hash of
    all bytes of the run's windows. Which string is a window's anchor depends on the window's
    bytes alone, so equal windows have equal anchors at equal distances.
    """
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    wide = length - anchor + 1
    starts = np.append(0, ends[:-1])
    n = np.maximum(ends - starts - length + 1, 0)
    if not n.sum():
        return empty
    rolling = Rolling(data)
    at = np.arange(len(data) - anchor + 1)
    # 32 bits of the hash, then the place: among equals the first string is the anchor.
    value = rolling(at, at + anchor) & _U(0xFFFFFFFF00000000) | at.astype(_U)
    blocks = -(-len(value) // wide) + 1
    value = np.append(value, np.full(blocks * wide - len(value), _U(2**64 - 1))).reshape(blocks, wide)
    ahead = np.minimum.accumulate(value[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(value, axis=1).ravel()
    text = np.repeat(np.arange(len(n)), n)
    window = np.arange(n.sum()) + np.repeat(starts - np.append(0, np.cumsum(n)[:-1]), n)
    place = (np.minimum(ahead[window], behind[window + wide - 1]) & _U(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    text, place, first, last = text[first], place[first], window[first], window[last]
    whole = rolling(first, last + length) ^ mix((place - first).astype(_U))
    offset = starts[text]
    return (
        text,
        first - offset,
        last - offset,
        rolling(place, place + anchor).view(np.int64),
        whole.view(np.int64),
    )


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, or parts of them, with text number and offset; all windows of a text are in one."""
    which, offsets, parts, held = [], [], [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[start : start + PIECE + length - 1]
            if parts and held + len(part) > PIECE + length:
                yield which, offsets, parts
                which, offsets, parts, held = [], [], [], 0
            which.append(i)
            offsets.append(start)
            parts.append(part)
            held += len(part)
    if parts:
        yield which, offsets, parts


def _found_runs(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "data"):
        for which, offsets, parts in _pieces(batch.column("data").to_pylist(), length):
            data = np.frombuffer(b"".join(parts), np.uint8)
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            part, first, last, name, whole = runs_of(data, ends, length, anchor)
            offset = np.array(offsets, np.int64)[part]
            rows = pa.array(np.array(which, np.int64)[part])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(rows),
                    pa.array(name),
                    pa.array(whole),
                    pa.array(first + offset),
                    pa.array(last + offset),
                ],
                ["key", "anchor", "whole", "first", "last"],
            )


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "single", "key", "first", "segment"]
    kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary()]
    for batch in slices(batches, "data"):
        columns = (batch.column(x).to_pylist() for x in ("key", "data", "parts"))
        rows = [
            (x["anchor"], x["single"], key, x["first"], data[x["first"] : x["last"] + length])
            for key, data, parts in zip(*columns, strict=True)
            for x in parts
        ]
        for i in range(0, len(rows), ROWS_OUT):
            arrays = zip(zip(*rows[i : i + ROWS_OUT], strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in arrays], names)


def _sorted_shard(shard: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The repeated spans of the partition's segments; its bytes go to disk as they come."""
    rows: list[tuple] = []

    def segments() -> Iterator[np.ndarray]:
        for part in shard:
            columns = (part.column(x).to_pylist() for x in ("key", "first", "single", "segment"))
            for key, first, single, segment in zip(*columns, strict=True):
                rows.append((key, first, single))
                yield np.frombuffer(segment, np.uint8)

    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        arrays = zip(zip(*found, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in arrays], ["key", "start", "end"])

    found: list[tuple] = []
    for i, starts in repeated(segments(), length):
        key, first, single = rows[i]
        if single and len(starts):
            cuts = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + length))
            ends = np.append(starts[cuts[1:] - 1], starts[-1]) + length
            found += [(key, a, b) for a, b in zip((starts[cuts] + first).tolist(), (ends + first).tolist(), strict=True)]
        if len(found) >= ROWS_OUT:
            yield batch(found)
            found = []
    if found:
        yield batch(found)


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id).alias("id"), data.alias("data"))
    return rows.withColumn("key", F.unhex(F.md5("data")))


def repeated_spans(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(key, start, end) of spans of the texts ``data`` that cover all their repeated strings.

    Spans may overlap. Equal texts have one key, and each of them counts.

    1. A string of ``length`` bytes names its anchor, the substring of ``anchor`` bytes of the
       least hash. Neighbours that have the same anchor make a run, so a text has about
       2 / (length - anchor) runs a byte. Equal strings have equal anchors: only runs of an
       anchor that occurs elsewhere go on.
    2. Runs that agree in all their bytes are repeated as a whole.
    3. Else a run's bytes, once for each different run, are a segment. Segments are dealt to
       shards by anchor, and a shard's suffixes are sorted (``induced``): neighbours that share
       ``length`` bytes are repeated. A shard is on its task's disk, so that a frequent anchor
       needs no more memory.
    """
    bounded_batches(rows.sparkSession)
    schema = "key binary, anchor long, whole long, first long, last long"
    runs = rows.select("key", "data").mapInArrow(lambda b: _found_runs(b, length, anchor), schema)
    runs = stored(runs, "runs")
    often = runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    runs = stored(runs.join(often, "anchor", "left_semi"), "suspects")
    place = F.min(F.struct("key", "first", "last")).alias("place")
    groups = runs.groupBy("anchor", "whole").agg(F.count("*").alias("n"), place)
    groups = stored(groups, "run-groups")
    same = runs.join(groups.where("n > 1").select("anchor", "whole"), ["anchor", "whole"])
    same = same.select("key", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    mixed = groups.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    mixed = mixed.where("kinds > 1 AND least = 1").select("anchor")
    parts = groups.join(mixed, "anchor").select("anchor", (F.col("n") == 1).alias("single"), "place.*")
    parts = stored(parts, "segments")
    size = parts.agg(F.sum(F.col("last") - F.col("first") + length)).first()[0]
    if not size:
        return same
    by_text = parts.groupBy("key").agg(F.collect_list(F.struct("anchor", "single", "first", "last")).alias("parts"))
    once = rows.select("key", "data").join(by_text.select("key"), "key", "left_semi")
    once = once.groupBy("key").agg(F.first("data").alias("data"))
    schema = "anchor long, single boolean, key binary, first long, segment binary"
    segments = once.join(by_text, "key").select("key", "data", "parts")
    segments = segments.mapInArrow(lambda b: _cut(b, length), schema)
    shards = segments.repartition(-(-size // SHARD_BYTES), "anchor")
    found = shards.mapInArrow(lambda b: _sorted_shard(b, length), "key binary, start long, end long")
    return same.unionAll(stored(found, "spans"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "data"):
        spans, kept = [], []
        for data, found in zip(batch.column("data").to_pylist(), batch.column("found").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for x in sorted(found or [], key=lambda x: x["start"]):
                if merged and x["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x["end"])
                else:
                    merged.append([x["start"], x["end"]])
            edges = [0, *(e for span in merged for e in span), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.compute.binary_length(batch.column("data")).cast(pa.int64()),
                pa.array(spans, SPANS),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans``, ``kept``.

    ``spans`` are the maximal runs of bytes (start, end) that lie in a string of ``length``
    bytes which also begins at another place, in the same text or another; overlaps count, and
    all strings are those of the input. ``kept`` is the rest. Texts are taken as UTF-8, null as
    empty; no string crosses texts; rows that repeat a text repeat its strings. Other columns
    are not read; an empty table gives an empty table.
    """
    if not 0 < anchor <= length:
        raise ValueError("an anchor is a part of the strings that are compared")
    rows = _keyed(docs, id, text)
    spans = repeated_spans(rows, length, anchor).distinct()
    found = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = rows.join(found, "key", "left").select("id", "data", "found")
    id_type = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(_without, schema)

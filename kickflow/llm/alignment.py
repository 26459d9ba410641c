"""Alignment of two tokenizers over the same bytes, in Arrow tables.

Both token lists of a text end at byte offsets. Lists are flattened with their parents' indices,
lengths are summed up within each text, and one hash join on (document, end) tells which tokens
end where: places where both do cut the text into groups, and between any two neighbouring ends
lies exactly one link, a pair of tokens that overlap. How many documents hold a pair is counted
by task first and merged by Spark; counts go back to the documents by blocks of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import bounded_batches, slices, stored
from kickflow.llm.word_bpe import byte_symbols

# Text that is aligned at once, text of the documents that get their counts together, and pairs
# that a task holds before it hands on what it has counted.
SLICE_BYTES, BLOCK_BYTES, HELD_PAIRS = 2 << 20, 16 << 20, 1 << 19
# A pair of ids is one number; ids of the second vocabulary are below 2^PLACES.
PLACES = 20


class Side:
    """A vocabulary: texts to ids, and the bytes that each id stands for."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.decimal = pa.array([str(i) for i in range(len(tokens))])

    def ids(self, texts: list[str]) -> pa.ListArray:
        raise NotImplementedError

    def joined(self, ids: pa.ListArray) -> list[bytes]:
        """The bytes of each list of ids, one after the other."""
        flat = ids.flatten().to_numpy()
        sizes = self.sizes[flat]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[flat] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        data = self.bytes[at].tobytes()
        cuts = np.concatenate([[0], ends])[ids.offsets.to_numpy()]
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


class ByteLevel(Side):
    """Byte-level BPE from a tokenizer file. Special tokens' names are plain text."""

    def __init__(self, spec: str, pattern: str):
        parsed = json.loads(spec)
        byte = {name: b for b, name in enumerate(byte_symbols())}
        special = {x["content"] for x in parsed["added_tokens"]}
        vocabulary = {t: i for t, i in parsed["model"]["vocab"].items() if t not in special}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        super().__init__(tokens)
        self.encode = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def ids(self, texts: list[str]) -> pa.ListArray:
        return pa.array([self.encode(" " + text) for text in texts], pa.list_(pa.int32()))


class Pieces(Side):
    """Pieces with byte fallback; the model puts a space before the text."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__(
            [
                bytes([int(name[1:-1], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
                for i, name in enumerate(names)
            ]
        )

    def ids(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.model.encode(texts, num_threads=1), pa.list_(pa.int32()))


@lru_cache(1)
def _sides(files: Broadcast, pattern: str) -> tuple[Side, Side]:
    spec, model = files.value
    return ByteLevel(spec, pattern), Pieces(model)


def ends(ids: pa.ListArray, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """For each token of all lists: the list's index, and where the token ends in its text."""
    parents = pc.cast(pc.list_parent_indices(ids), pa.int64())
    total = pc.cumulative_sum(pa.array(sizes[ids.flatten().to_numpy()], pa.int64()))
    before = np.concatenate([[0], total.to_numpy()])[ids.offsets.to_numpy()[:-1]]
    return parents, pc.subtract(total, pa.array(before).take(parents))


def _grouped(ids: pa.ListArray, cut: np.ndarray, decimal: pa.Array) -> pa.Array:
    """Ids as text, joined by commas up to each cut."""
    last = np.flatnonzero(cut) + 1
    groups = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], last]), pa.int32()), decimal.take(ids.flatten())
    )
    return pc.binary_join(groups, ",")


def align(a: pa.ListArray, b: pa.ListArray, left: Side, right: Side) -> dict[str, pa.Array]:
    """Groups and links of each pair of id lists that stand for the same bytes."""
    n = len(a)
    parent_a, end_a = ends(a, left.sizes)
    parent_b, end_b = ends(b, right.sizes)
    at_a = pa.table({"doc": parent_a, "end": end_a, "a": a.flatten(), "i": pa.array(np.arange(len(end_a)))})
    at_b = pa.table({"doc": parent_b, "end": end_b, "b": b.flatten(), "j": pa.array(np.arange(len(end_b)))})
    both = at_a.join(at_b, ["doc", "end"], join_type="full outer", use_threads=False)
    cuts = both.filter(pc.and_(pc.is_valid(both["i"]), pc.is_valid(both["j"])))
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    cut_a[cuts["i"].to_numpy()] = True
    cut_b[cuts["j"].to_numpy()] = True
    groups = np.bincount(cuts["doc"].to_numpy(), minlength=n)
    offsets = pa.array(np.concatenate([[0], np.cumsum(groups)]), pa.int32())
    texts = pc.binary_join_element_wise(
        _grouped(a, cut_a, left.decimal), _grouped(b, cut_b, right.decimal), "|"
    )
    # What overlaps before an end are the tokens that end there or next.
    both = both.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    token_a = pc.cast(pc.fill_null_backward(both["a"]), pa.int64())
    token_b = pc.cast(pc.fill_null_backward(both["b"]), pa.int64())
    pair = pc.bit_wise_or(pc.shift_left(token_a, PLACES), token_b)
    links = pa.table({"doc": both["doc"], "pair": pair})
    counted = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    counted = counted.sort_by([("doc", "ascending"), ("pair", "ascending")]).combine_chunks()
    per_doc = pa.array(
        np.concatenate([[0], np.cumsum(np.bincount(counted["doc"].to_numpy(), minlength=n))]), pa.int32()
    )

    def lists(column: str, kind: pa.DataType) -> pa.ListArray:
        values = counted[column].combine_chunks().cast(kind)
        return pa.ListArray.from_arrays(per_doc, values)

    return {
        "n_a": pc.cast(pc.list_value_length(a), pa.int64()),
        "n_b": pc.cast(pc.list_value_length(b), pa.int64()),
        "n_groups": pa.array(groups, pa.int64()),
        "n_links": pa.array(np.bincount(both["doc"].to_numpy(), minlength=n), pa.int64()),
        "groups": pc.binary_join(pa.ListArray.from_arrays(offsets, texts), ";"),
        "pairs": lists("pair", pa.int64()),
        "times": lists("count_all", pa.int32()),
    }


ALIGNED = {
    "n_a": "long",
    "n_b": "long",
    "n_groups": "long",
    "n_links": "long",
    "groups": "string",
    "pairs": "array<long>",
    "times": "array<int>",
    "block": "long",
}


def aligned(
    docs: DataFrame, byte_path: str, piece_path: str, pattern: str, text: str = "text"
) -> DataFrame:
    """``docs`` with the alignment of its texts' tokens by two vocabularies.

    ``n_a`` and ``n_b`` count the tokens, ``n_groups`` the stretches between places where both
    sides end, ``n_links`` the overlapping pairs. ``groups`` lists the ids of each stretch
    (``a1,a2|b1;a3|b2,b3``), ``pairs`` the different pairs (the first id shifted by 20 bits, or
    the second) and ``times`` how often each occurs. ``block`` numbers stretches of rows with
    some 16 MB of text. A text that is null or empty, or that either side does not give back
    with a space before it, has no tokens: zeros, an empty text and empty lists. Repeated rows
    stay repeated, no rows give none; columns already named so are replaced.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop(*ALIGNED)
    with open(byte_path, encoding="utf-8") as spec, open(piece_path, "rb") as model:
        files = docs.sparkSession.sparkContext.broadcast((spec.read(), model.read()))
    schema = docs.select("*", *[F.lit(None).cast(t).alias(c) for c, t in ALIGNED.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(files, pattern)
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches, text, SLICE_BYTES):
            given = [x or "" for x in batch.column(text).to_pylist()]
            found = align(*_tokens(given, *sides), *sides)
            found["block"] = pa.array([block] * len(given), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[found[name] for name in ALIGNED]], [*batch.schema.names, *ALIGNED]
            )
            filled += sum(map(len, given))
            if filled >= BLOCK_BYTES:
                block, filled = block + 1, 0

    return docs.mapInArrow(run, schema)


def _tokens(texts: list[str], left: Side, right: Side) -> tuple[pa.ListArray, pa.ListArray]:
    """Ids by both sides; none where either side's bytes differ from the text's."""
    a, b = left.ids(texts), right.ids(texts)
    wanted = [(" " + text).encode() for text in texts]
    same = [
        bool(text) and x == y == z
        for text, x, y, z in zip(texts, left.joined(a), right.joined(b), wanted, strict=True)
    ]
    if all(same):
        return a, b
    return _only(a, same), _only(b, same)


def _only(ids: pa.ListArray, kept: list[bool]) -> pa.ListArray:
    sizes = np.where(kept, np.diff(ids.offsets.to_numpy()), 0)
    flags = pa.array(kept).take(pc.cast(pc.list_parent_indices(ids), pa.int64()))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, ids.flatten().filter(flags))


def partial_counts(docs: DataFrame) -> DataFrame:
    """Documents per ``block`` and ``pair``, as far as a task has seen them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                pairs = batch.column("pairs")
                block = batch.column("block").take(pc.cast(pc.list_parent_indices(pairs), pa.int64()))
                part = pa.table({"block": block, "pair": pairs.flatten()})
                held.append(part.append_column("n", pa.array(np.ones(len(part), np.int64))))
            if sum(map(len, held)) >= HELD_PAIRS:
                held = [_summed(held)]
                if len(held[0]) >= HELD_PAIRS // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from _summed(held).to_batches()

    return docs.select("block", "pairs").mapInArrow(run, "block long, pair long, n long")


def _summed(parts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(parts).group_by(["block", "pair"], use_threads=False).aggregate([("n", "sum")])
    return found.select(["block", "pair", "n_sum"]).rename_columns(["block", "pair", "n"])


def counts(partial: DataFrame) -> DataFrame:
    """Documents per ``pair``, and whether no pair of the same first id is in more of them."""
    total = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    total = total.withColumn("a", F.shiftright("pair", PLACES))
    # One row per id of the vocabulary at most.
    most = total.groupBy("a").agg(F.max("n").alias("most"))
    return total.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def linked(docs: DataFrame) -> DataFrame:
    """Rows of ``aligned`` with ``n_best`` and ``count_sum`` in the place of pairs and block.

    ``count_sum`` adds up over a document's links how many documents (rows) hold their pair;
    ``n_best`` counts the links whose pair is in as many as any other pair of its first id.
    Rows and counts meet by blocks, which are bounded, so no pair is hot. ``docs`` is read
    twice and should be stored.
    """
    partial = stored(partial_counts(docs), "pairs")
    known = partial.select("block", "pair").distinct().join(counts(partial), "pair")
    kept = [c for c in docs.columns if c not in ("pairs", "times", "block")]
    schema = docs.select(*kept, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")).schema

    def look_up(rows: pa.Table, table: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        n = len(rows)
        if not n:
            return pa.table({f.name: pa.array([], f.type) for f in rows.select(kept).schema} | {x: pa.array([], pa.int64()) for x in ("n_best", "count_sum")})
        pairs = _one(rows["pairs"])
        links = pa.table(
            {
                "doc": pc.cast(pc.list_parent_indices(pairs), pa.int64()),
                "pair": pairs.flatten(),
                "times": _one(rows["times"]).flatten(),
            }
        )
        found = links.join(table.select(["pair", "n", "best"]), "pair", join_type="inner", use_threads=False)
        times = pc.cast(found["times"], pa.int64())
        sums = pa.table(
            {
                "doc": found["doc"],
                "n_best": pc.multiply(times, pc.cast(found["best"], pa.int64())),
                "count_sum": pc.multiply(times, found["n"]),
            }
        )
        sums = sums.group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        out = rows.select(kept)
        for name in ("n_best", "count_sum"):
            column = np.zeros(n, np.int64)
            column[sums["doc"].to_numpy()] = sums[f"{name}_sum"].to_numpy()
            out = out.append_column(name, pa.array(column))
        return out

    return docs.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(look_up, schema)


def _one(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)

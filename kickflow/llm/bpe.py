"""Byte-level BPE: texts to token ids and back, merges done on padded matrices of pieces."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import bounded_batches, resident, slices

# Longer pieces are matrices of one row, each round of which merges all it can.
LONGEST_ROW = 1024
# Bounds of memory, on which no result depends: cells of a matrix, text that is encoded at once,
# and pieces that are remembered (twice so many at most).
CELLS, SLICE_BYTES = 1 << 19, 2 << 20
KNOWN_PIECES, KNOWN_BYTES = 1 << 17, 64
NO_PAIR = np.iinfo(np.int32).max
PAD = 0xFFFF
EMPTY = np.uint32(0xFFFFFFFF)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one line per token, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class PairTable:
    """Ranks of adjacent tokens by open addressing; all look-ups of an array at once."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (4 * max(1, len(pairs))).bit_length())
        self.keys = np.full(1 << self.bits, EMPTY, np.uint32)
        self.ranks = np.full(1 << self.bits, NO_PAIR, np.int32)
        keys = np.fromiter(pairs.keys(), np.uint32, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == EMPTY
            _, first = np.unique(slots[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slots[put]] = keys[put]
            self.ranks[slots[put]] = ranks[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, ranks = keys[rest], ranks[rest]
            slots = (slots[rest] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NO_PAIR)
        open_ = (found != keys) & (found != EMPTY)
        while open_.any():
            at = np.nonzero(open_)
            slots[at] = (slots[at] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[at]]
            hit = found == keys[at]
            out[at] = np.where(hit, self.ranks[slots[at]], out[at])
            open_[at] = ~hit & (found != EMPTY)
        out[(left == PAD) | (right == PAD)] = NO_PAIR
        return out


class Coder:
    """Encodes pieces of text, for one set of ranks (below 65,535)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if ranks and max(ranks.values()) >= PAD:
            raise ValueError("ranks must be below 65535")
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Any two tokens whose bytes together are a token may merge, not only the pair
        # that the token was learnt from.
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 16 | right] = rank
        self.pairs = PairTable(pairs)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known, self.older = {}, self.known
        known = self.known
        new = set().union(*split) - known.keys()
        if self.older:
            known.update((piece, self.older[piece]) for piece in new & self.older.keys())
            new -= known.keys()
        long = self._learn(sorted(new))
        ids = [b"".join([known[piece] for piece in pieces]) for pieces in split]
        for piece in long:
            del known[piece]
        return ids

    def _learn(self, pieces: list[str]) -> list[str]:
        """Encode the pieces; returns those that are too long to be kept."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        long = []
        for piece in pieces:
            data = piece.encode("utf-8")
            if len(data) > KNOWN_BYTES:
                long.append(piece)
            if (rank := self.ranks.get(data)) is not None:
                self.known[piece] = rank.to_bytes(4, "little")
            elif len(data) > LONGEST_ROW:
                self.known[piece] = self._row(data)
            else:
                width = len(data) if len(data) <= 32 else 1 << (len(data) - 1).bit_length()
                by_width.setdefault(width, []).append((piece, data))
        for width, rows in by_width.items():
            at_once = max(1, CELLS // width)
            for start in range(0, len(rows), at_once):
                some = rows[start : start + at_once]
                for (piece, _), ids in zip(some, self._matrix([x for _, x in some], width), strict=True):
                    self.known[piece] = ids
        return long

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        """All rows at once: a round merges each row's leftmost pair of least rank.

        A row that has no pair left is written out and taken from the matrix, so every row
        of a round loses exactly one column.
        """
        data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in pieces), np.uint8)
        ids = self.single[data].reshape(len(pieces), width)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids[np.arange(width) >= size[:, None]] = PAD
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(pieces))
        done: list[bytes] = [b""] * len(pieces)
        while len(row):
            best = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            least = (
                ranks[np.arange(len(row)), best]
                if ranks.shape[1]
                else np.full(len(row), NO_PAIR, np.int32)
            )
            ended = least == NO_PAIR
            if ended.any():
                last = ids[ended].astype("<u4")
                counts = (last != PAD).sum(1)
                for i, n, values in zip(row[ended].tolist(), counts.tolist(), last, strict=True):
                    done[i] = values[:n].tobytes()
                live = ~ended
                ids, ranks, row, best, least = ids[live], ranks[live], row[live], best[live], least[live]
                if not len(row):
                    break
            here = np.arange(len(row))
            column = np.arange(ids.shape[1] - 1)
            ids = np.where(column <= best[:, None], ids[:, :-1], ids[:, 1:])
            ids[here, best] = least
            column = column[:-1]
            ranks = np.where(column < best[:, None], ranks[:, :-1], ranks[:, 1:])
            if ids.shape[1] > 1:
                right = np.flatnonzero(best < ids.shape[1] - 1)
                at = best[right]
                ranks[right, at] = self.pairs(ids[right, at], ids[right, at + 1])
                left = np.flatnonzero(best > 0)
                at = best[left] - 1
                ranks[left, at] = self.pairs(ids[left, at], ids[left, at + 1])
        return done

    def _row(self, data: bytes) -> bytes:
        """A matrix of one long row: a round merges its pair of least rank wherever it is.

        That is what so many rounds of one merge each come to, up to the first merge that
        makes a pair of lower rank, which has to go first; a round ends there.
        """
        ids = self.single[np.frombuffer(data, np.uint8)]
        ranks = self.pairs(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != NO_PAIR:
            at = np.flatnonzero(ranks == least)
            # Of neighbours that overlap, every other one, from the left.
            first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            run = np.repeat(first, np.diff(first, append=len(at)))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            made = np.full(len(at), least, ids.dtype)
            # What stands beside each as its turn comes: those on the left are merged by then.
            before = np.where(np.diff(at, prepend=-2) == 2, least, np.where(at > 0, ids[at - 1], PAD))
            after = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], PAD)
            lower = (self.pairs(before, made) < least) | (self.pairs(made, after) < least)
            if lower.any():
                at = at[: lower.argmax() + 1]
            ids[at] = least
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids = ids[kept]
            ranks = ranks[kept[1:]]
            at -= np.arange(len(at))
            for near in (at[at > 0] - 1, at[at < len(ids) - 1]):
                ranks[near] = self.pairs(ids[near], ids[near + 1])
        return ids.astype("<u4").tobytes()


class Tokens:
    """The bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _tables(ranks: Broadcast, pattern: str | None) -> tuple[Coder | None, Tokens]:
    coder = Coder(ranks.value, pattern) if pattern is not None else None
    return coder, Tokens(ranks.value)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit integers).

    Each match of ``pattern`` is encoded by itself, without special tokens. A null or empty
    text has no tokens. Repeated rows stay repeated, no rows give none. A column already named
    so is replaced; all others stay as they are. The rank file is read on the driver and
    broadcast (its size is that of the vocabulary).
    """
    return _coded(docs, ranks_path, pattern, text, decode=False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode``, and ``decoded`` as ``decode`` gives it, in one pass."""
    return _coded(docs, ranks_path, pattern, text, decode=True)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that its ids stand for (null: empty)."""
    return _coded(tokens, ranks_path, None, ids, decode=True)


def _coded(df: DataFrame, ranks_path: str, pattern: str | None, column: str, decode: bool) -> DataFrame:
    """``column`` holds texts to encode, or ids where there is no pattern."""
    bounded_batches(df.sparkSession)
    kinds = {"n_tokens": F.lit(0).cast("long"), "token_ids": F.lit(b"")} if pattern is not None else {}
    kinds |= {"decoded": F.lit(b"")} if decode else {}
    names = list(kinds)
    df = df.drop(*names)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = df.select("*", *[kind.alias(name) for name, kind in kinds.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, tokens = resident(("bpe", ranks, pattern), lambda: _tables(ranks, pattern))
        for batch in slices(batches, column, SLICE_BYTES):
            given, new = batch.column(column).to_pylist(), []
            if pattern is not None:
                ids = coder.encode([x or "" for x in given])
                new += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            else:
                ids = [x or b"" for x in given]
            if decode:
                new.append(pa.array([tokens.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return df.mapInArrow(run, schema)

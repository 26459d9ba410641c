"""BPE with word ends: exact merges by backtracking over longest matches, ids back by offsets.

A sequence of tokens is what the merges give for a word exactly if each token comes out of its
own text and each two neighbours are compatible: no merge ever crosses the place where they
meet. So a word needs no merge rounds. Longest tokens are tried first at each place, found for
all places in one pass of an Aho-Corasick automaton; a neighbour that does not fit is replaced
by the next shorter one, and a place that nothing fits is left for good.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import category

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from kickflow.llm.common import bounded_batches, slices

NEVER = 1 << 60
# A byte that ends its word is another symbol than the same byte inside.
ENDS = 256
# Bounds of what a worker remembers; results do not depend on them.
KNOWN_PIECES, KNOWN_BYTES, KNOWN_PAIRS = 1 << 17, 64, 1 << 19
# Decoded bytes that are gathered at once.
GATHERED = 4 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Fixed rule: printable bytes stand for themselves, the others are numbered from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    names = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Merges:
    """The vocabulary as a tree of merges, and which tokens may stand side by side."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        # The text of a token over 512 symbols: bytes, and bytes that end a word.
        self.text: dict[int, str] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for byte, name in enumerate(byte_symbols()):
            for symbol, at in ((name, byte), (name + suffix, ENDS + byte)):
                self.text[vocabulary[symbol]] = chr(at)
                self.rank[vocabulary[symbol]] = -1
        for rank, merge in enumerate(merges):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, token = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if token in self.text or max(self.rank.get(a, NEVER), self.rank.get(b, NEVER)) >= rank:
                raise ValueError(f"merge {rank} does not make a new token out of older ones")
            self.text[token], self.rank[token] = self.text[a] + self.text[b], rank
            self.parts[token], self.joined[a, b] = (a, b), rank
        self.by_text: dict[str, int] = {}
        for token, text in self.text.items():  # parts come before what they make
            if self.comes_out(token):
                self.by_text[text] = token
        self.length = {token: len(t) for token, t in self.text.items()}
        self._pairs: dict[int, bool] = {}
        self._shorter: dict[int, int | None] = {}

    def spine(self, token: int, side: int) -> list[int]:
        """What stands at one side of a token over time: a symbol at first, then larger parts."""
        out = [token]
        while (parts := self.parts.get(out[-1])) is not None:
            out.append(parts[side])
        return out[::-1]

    def apart(self, left: int, right: int, at_last: bool) -> bool:
        """Whether no merge crosses the place between two texts while each is merged.

        ``at_last`` also forbids the merge of the two whole tokens. Merges run by rank and,
        among equal ones, from the left.
        """
        a, b = self.spine(left, 1), self.spine(right, 0)
        i = j = 0
        while True:
            next_a = self.rank[a[i + 1]] if i + 1 < len(a) else NEVER
            next_b = self.rank[b[j + 1]] if j + 1 < len(b) else NEVER
            done = next_a == next_b == NEVER
            across = self.joined.get((a[i], b[j]), NEVER)
            if across < next_a and across <= next_b and (at_last or not done):
                return False
            if done:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def comes_out(self, token: int) -> bool:
        """Whether the merges make this token of its own text, and so its parts of theirs."""
        if token not in self.parts:
            return True
        whole = all(self.by_text.get(self.text[part]) == part for part in self.parts[token])
        return whole and self.apart(*self.parts[token], at_last=False)

    def fit(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= KNOWN_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.apart(left, right, at_last=True)
        return known

    def shorter(self, token: int) -> int | None:
        """The longest other token that the text of this one starts with."""
        if token not in self._shorter:
            text = self.text[token]
            found = (self.by_text.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self._shorter[token] = next((x for x in found if x is not None), None)
        return self._shorter[token]


class Unassigned(Exception):
    """A character that is a letter to some versions of Unicode and none to others."""


class Recent(dict):
    """Values by key, made when first asked for; keys not asked for lately are forgotten."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= KNOWN_BYTES:
            if len(self) >= KNOWN_PIECES:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Coder:
    """Encodes and decodes texts by one tokenizer file."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model = parsed["model"]
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.known = Recent(self.piece)
        self.automaton = ahocorasick.Automaton()
        for text, token in self.merges.by_text.items():
            self.automaton.add_word(text, (len(text), token))
        self.automaton.make_automaton()
        self.normal = Tokenizer.from_str(spec).normalizer.normalize_str
        pattern = parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.split = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
        self.special = {text: id.to_bytes(4, "little") for text, id in special.items()}
        self.marks = regex.compile("|".join(f"({regex.escape(x)})" for x in special) or r"(?!)")
        names = {id: text for text, id in [*model["vocab"].items(), *special.items()]}
        # A token's text and the space after it; ids that the vocabulary lacks have neither.
        shown = [f"{names[i]} ".encode() if i in names else b"" for i in range(max(names) + 1)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.offsets = np.cumsum([0, *map(len, shown)])

    def piece(self, piece: str) -> bytes:
        if not piece.isascii() and any(category(x) == "Cn" for x in piece):
            raise Unassigned
        return array("I", self.tokens(piece.encode("utf-8"))).tobytes()

    def tokens(self, data: bytes) -> list[int]:
        """Token ids of one word."""
        word = data[:-1].decode("latin-1") + chr(ENDS + data[-1])
        merges = self.merges
        if (whole := merges.by_text.get(word)) is not None:
            return [whole]
        # Matches come by their ends, so the last one of a place is its longest.
        longest = [-1] * len(word)
        for end, (size, token) in self.automaton.iter(word):
            longest[end - size + 1] = token
        out: list[int] = []
        dead = bytearray(len(word) + 1)
        at, token, length = 0, longest[0], merges.length
        while at < len(word):
            while token is not None:
                end = at + length[token]
                if not dead[end] and (not out or merges.fit(out[-1], token)):
                    break
                token = merges.shorter(token)
            if token is None:
                dead[at] = 1
                at -= length[out[-1]]
                token = merges.shorter(out.pop())
                continue
            out.append(token)
            at = end
            if at < len(word):
                token = longest[at]
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for mark in self.marks.finditer(text):
            out += [self._plain(text[at : mark.start()]), self.special[mark[0]]]
            at = mark.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        # Pieces hold no white space, so that of ASCII text need not be made uniform.
        text = text.lower() if text.isascii() else self.normal(text)
        try:
            return b"".join(map(self.known.__getitem__, self.pieces(text)))
        except Unassigned:
            pieces = [piece.encode("utf-8") for piece, _ in self.split(text)]
            return array("I", chain.from_iterable(map(self.tokens, pieces))).tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with a space between."""
        ids = ids[ids < len(self.offsets) - 1]
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        out, first = [], 0
        while first < len(ids):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + GATHERED)))
            n = sizes[first:last]
            shift = starts[first:last] - (ends[first:last] - n - before)
            out.append(self.shown[np.repeat(shift, n) + np.arange(n.sum())].tobytes())
            first = last
        return b"".join(out)[:-1]


@lru_cache(1)
def _coder(spec: Broadcast) -> Coder:
    return Coder(spec.value)


def _coded(df: DataFrame, path: str, column: str, encode: bool, decode: bool) -> DataFrame:
    bounded_batches(df.sparkSession)
    new = ["n_tokens", "token_ids"] * encode + ["decoded"] * decode
    kinds = {"n_tokens": F.lit(0).cast("long"), "token_ids": F.lit(b""), "decoded": F.lit("")}
    df = df.drop(*new)
    with open(path, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())
    schema = df.select("*", *[kinds[name].alias(name) for name in new]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec)
        for batch in slices(batches, column, 4 << 20):
            given = batch.column(column).to_pylist()
            ids = [coder.encode(x or "") for x in given] if encode else [x or b"" for x in given]
            out = [*batch.columns]
            if encode:
                out += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decode:
                texts = [coder.decode(np.frombuffer(x, "<u4")) for x in ids]
                texts = [x.decode("utf-8", "replace") for x in texts]
                out.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names, *new])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit integers).

    ``path`` is a tokenizer file with byte-level BPE and word ends, read on the driver and
    broadcast (its size is that of the vocabulary). The names of special tokens inside a text
    are those tokens; none are added. A null or empty text, or one of white space, has no
    tokens. Repeated rows stay repeated, no rows give none. A column already named so is
    replaced; all others stay as they are.
    """
    return _coded(docs, path, text, encode=True, decode=False)


def decode(tokens: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded``, the texts of its tokens with a space between.

    Null ids give an empty text, ids beyond the vocabulary nothing.
    """
    return _coded(tokens, path, ids, encode=False, decode=True)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: the ids do not leave the task in between."""
    return _coded(docs, path, text, encode=True, decode=True)

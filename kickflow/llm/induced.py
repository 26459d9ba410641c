"""External induced sorting of a shard's suffixes, with their common prefixes.

All large arrays are files that are mapped or read in blocks; what is in memory does not grow
with the shard. Suffixes are compared up to a given length; beyond it their order is open.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np

BLOCK = 1 << 21
HELD = 32 << 20
SYMBOLS = 256
NEVER = np.uint16(0xFFFF)


class Queue:
    """A priority queue on disk: tuples leave by symbol, and within one in order of arrival.

    The symbols of what arrives never go back behind what has left, so each symbol has a list of
    blocks; they are in memory up to ``HELD`` bytes, then are appended to one file.
    """

    def __init__(self, folder: str, name: str, tuple_: np.dtype):
        self.path, self.tuple = os.path.join(folder, name), tuple_
        self.file = open(self.path, "w+b")  # noqa: SIM115
        self.blocks: list[deque] = [deque() for _ in range(SYMBOLS)]
        self.held = 0

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        block = np.empty(len(at), self.tuple)
        block["at"], block["lcp"] = at, lcp
        self.blocks[symbol].append(block)
        self.held += block.nbytes
        if self.held > HELD:
            self._spill()

    def _spill(self) -> None:
        for blocks in self.blocks:
            for i, block in enumerate(blocks):
                if isinstance(block, np.ndarray):
                    self.file.seek(0, os.SEEK_END)
                    blocks[i] = (self.file.tell(), len(block))
                    self.file.write(block.tobytes())
        self.held = 0

    def _load(self, block) -> np.ndarray:
        if isinstance(block, np.ndarray):
            return block
        start, n = block
        self.file.seek(start)
        return np.frombuffer(self.file.read(n * self.tuple.itemsize), self.tuple)

    def pop(self, symbol: int) -> np.ndarray | None:
        """The next tuples of a symbol, some blocks at once; None if there are no more."""
        blocks, taken, n = self.blocks[symbol], [], 0
        while blocks and n < BLOCK:
            block = blocks.popleft()
            if isinstance(block, np.ndarray):
                self.held -= block.nbytes
            taken.append(self._load(block))
            n += len(taken[-1])
        return np.concatenate(taken) if taken else None

    def read(self, symbol: int, backwards: bool = False) -> Iterator[np.ndarray]:
        """All tuples of a symbol, which stay."""
        for block in reversed(self.blocks[symbol]) if backwards else self.blocks[symbol]:
            yield self._load(block)[::-1] if backwards else self._load(block)

    def close(self) -> None:
        self.file.close()
        os.unlink(self.path)


class Shard:
    """The bytes of a shard, the types of its suffixes, and the sorting of these."""

    def __init__(self, data: np.ndarray, length: int, folder: str):
        self.folder, self.cap, self.n = folder, length, len(data)
        self.place = np.dtype("<i4") if self.n < 2**31 - 1 else np.dtype("<i8")
        self.tuple = np.dtype([("at", self.place), ("lcp", "<u2")])
        self.text = self._mapped("text", np.uint8, self.n + 8)
        self.text[: self.n] = data
        self.words = np.ndarray((self.n,), "<u8", self.text, strides=(1,))
        self.small = self._mapped("types", np.bool_, self.n + 1)  # smaller than the next suffix
        self._classify()
        self.starts = self._minima()

    def _queue(self, name: str) -> Queue:
        return Queue(self.folder, name, self.tuple)

    def _mapped(self, name: str, kind, n: int) -> np.ndarray:
        return np.memmap(os.path.join(self.folder, name), kind, "w+", shape=(max(n, 1),))

    def _classify(self) -> None:
        """Type each suffix by the next unequal symbol; the empty suffix is the smallest."""
        self.small[self.n] = True
        following = False  # the last suffix is larger than the empty one
        for end in range(self.n, 0, -BLOCK):
            start = max(0, end - BLOCK)
            here = self.text[start:end].astype(np.int16)
            next_ = np.append(here[1:], self.text[end] if end < self.n else -1)
            unequal = np.flatnonzero(here != next_)
            which = np.searchsorted(unequal, np.arange(end - start))
            types = np.append(here < next_, following)[np.append(unequal, end - start)[which]]
            self.small[start:end] = types
            following = bool(types[0])

    def _minima(self) -> np.ndarray:
        """Where a smaller suffix follows a larger one, in text order; the empty one is last."""
        found = []
        for start in range(0, self.n, BLOCK):
            end = min(self.n, start + BLOCK)
            found.append(np.flatnonzero(self.small[start + 1 : end + 1] & ~self.small[start:end]) + start + 1)
        count = sum(map(len, found))
        out = self._mapped("minima", self.place, count)
        at = 0
        for block in found:
            out[at : at + len(block)] = block
            at += len(block)
        return out[:count]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes, at most ``cap``: eight bytes a step."""
        out = np.zeros(len(a), np.int64)
        most = np.minimum(self.n - np.maximum(a, b), self.cap)
        live = np.flatnonzero(most > 0)
        while len(live):
            x = self.words[a[live] + out[live]] ^ self.words[b[live] + out[live]]
            lowest = (x & (~x + np.uint64(1))).astype(np.float64)
            step = np.where(x == 0, 8, np.log2(np.maximum(lowest, 1)).astype(np.int64) // 8)
            out[live] += step
            live = live[(step == 8) & (out[live] < most[live])]
        return np.minimum(out, np.maximum(most, 0))

    def _induce(self, queue: Queue, state: dict, tuples: np.ndarray, small: bool, carry: bool) -> None:
        """Put the predecessors of sorted suffixes in their queues, if they are of the type.

        A predecessor's common prefix with the one before it in its queue is one more than the
        least of those between the two suffixes that they come from.
        """
        at, lcp = tuples["at"].astype(np.int64), tuples["lcp"]
        before = np.maximum(at - 1, 0)
        found = np.flatnonzero((at > 0) & (self.small[before] == small))
        symbols = self.text[before[found]]
        order = np.argsort(symbols, kind="stable")
        ranked = symbols[order]
        cuts = np.append(np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])), len(ranked)) if len(ranked) else [0]
        since = state["since"]
        if carry:
            since_before = since.copy()
            np.minimum(since, lcp.min(), out=since)
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            symbol = int(ranked[start])
            from_ = found[order[start:end]]
            values = np.zeros(len(from_), np.uint16)
            if carry:
                last = int(from_[-1])
                least = np.minimum.reduceat(lcp[: last + 1], np.append(0, from_[:-1] + 1))
                least[0] = min(least[0], since_before[symbol])
                values = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint16)
                if not state["any"][symbol]:
                    values[0] = 0
                since[symbol] = lcp[last + 1 :].min() if last + 1 < len(lcp) else NEVER
            state["any"][symbol] = True
            queue.push(symbol, at[from_] - 1, values)

    def sort(self, seeds: Queue, carry: bool, visit: Callable[[np.ndarray, bool], None]) -> None:
        """Visit all suffixes from the largest to the smallest, induced from sorted minima.

        First the larger types go upwards from the minima, then the smaller ones downwards from
        the larger types. ``visit`` gets blocks of (position, common prefix with the suffix
        before it), and whether they are of the smaller type.
        """
        fresh = lambda: {"since": np.full(SYMBOLS, NEVER), "any": np.zeros(SYMBOLS, bool)}
        one = lambda at, lcp: np.array([(at, lcp)], self.tuple)
        large, inbox, state = self._queue("large"), self._queue("up"), fresh()
        self._induce(inbox, state, one(self.n, 0), False, carry)
        for symbol in range(SYMBOLS):
            last = None
            while (block := inbox.pop(symbol)) is not None:
                large.push(symbol, block["at"], block["lcp"])
                last = block["at"][-1:]
                self._induce(inbox, state, block, False, carry)
            for i, block in enumerate(seeds.read(symbol)):
                if carry and i == 0:
                    block = block.copy()
                    block["lcp"][0] = 0 if last is None else self.common(last, block["at"][:1])[0]
                self._induce(inbox, state, block, False, carry)
        inbox.close()
        inbox, state = self._queue("down"), fresh()
        for symbol in reversed(range(SYMBOLS)):
            last = None
            while (block := inbox.pop(symbol)) is not None:
                visit(block, True)
                last = block["at"][-1:]
                self._induce(inbox, state, block, True, carry)
            above = 0  # common prefix of the next block's first with what came before it
            for i, block in enumerate(large.read(symbol, backwards=True)):
                if carry and i == 0 and last is not None:
                    above = self.common(last, block["at"][:1])[0]
                down = np.empty(len(block), self.tuple)
                down["at"] = block["at"]
                down["lcp"] = np.append(above, block["lcp"][:-1])
                above = block["lcp"][-1]
                visit(down, False)
                self._induce(inbox, state, down, True, carry)
        inbox.close()
        large.close()

    def _queued(self, name: str, blocks: Iterator[np.ndarray], carry: bool) -> Queue:
        """Minima in the given order, by first symbol, with their common prefixes.

        The empty suffix is left out: ``sort`` begins with it.
        """
        queue, last = self._queue(name), None
        for block in blocks:
            block = block[block < self.n]
            lcp = np.zeros(len(block), np.uint16)
            if carry and len(block):
                before = np.append(block[:1] if last is None else last, block[:-1])
                lcp[:] = self.common(before, block)
            symbols = self.text[block]
            order = np.argsort(symbols, kind="stable")
            cuts = np.flatnonzero(np.append(True, symbols[order][1:] != symbols[order][:-1])) if len(block) else []
            for part in np.split(order, cuts[1:]) if len(block) else []:
                queue.push(int(symbols[part[0]]), block[part], lcp[part])
            last = block[-1:] if len(block) else last
        return queue

    def _names(self) -> np.ndarray:
        """A name per minimum in text order, by the order of what lies up to the next minimum."""
        m = len(self.starts)
        sorted_ = self._mapped("sorted", self.place, m)
        sorted_[0] = self.n
        filled = [m]

        def collect(block: np.ndarray, small: bool) -> None:
            at = block["at"]
            if small:
                at = at[(at > 0) & ~self.small[np.maximum(at - 1, 0)]]
                filled[0] -= len(at)
                sorted_[filled[0] : filled[0] + len(at)] = at[::-1]

        order = (self.starts[i : i + BLOCK] for i in range(0, m, BLOCK))
        seeds = self._queued("seeds", order, False)
        self.sort(seeds, False, collect)
        seeds.close()
        names, name, last = self._mapped("names-0", self.place, m + 1), 0, None
        names[:] = 0
        for i in range(0, m, BLOCK):
            at = np.asarray(sorted_[i : min(m, i + BLOCK)])
            index = np.searchsorted(self.starts, at)
            end = np.where(index + 1 < m, self.starts[np.minimum(index + 1, m - 1)], self.n)
            size = end - at + 1
            before = np.append(at[:1] if last is None else last[0], at[:-1])
            sizes = np.append(-1 if last is None else last[1], size[:-1])
            # The last one ends in the empty suffix, which no other does.
            alike = (sizes == size) & (end < self.n) & (before + size <= self.n)
            live = np.flatnonzero(alike)
            offset = 0
            while len(live):
                x, y = self.words[before[live] + offset], self.words[at[live] + offset]
                left = np.minimum(size[live] - offset, 8).astype(np.uint64)
                mask = np.where(left >= 8, ~np.uint64(0), (np.uint64(1) << (left % np.uint64(8) * np.uint64(8))) - np.uint64(1))
                same = ((x ^ y) & mask) == 0
                alike[live[~same]] = False
                offset += 8
                live = live[same & (size[live] > offset)]
            names[index] = name + np.cumsum(~alike)
            name += int((~alike).sum())
            last = (at[-1:], size[-1:])
        self.distinct = name
        return names

    def _ranked(self) -> Iterator[np.ndarray]:
        """The minima in the order of their suffixes, in blocks.

        The string of names is the smaller problem. As its alphabet is large, a queue per name
        would hold next to nothing; it is induced by doubling instead: the rank of a suffix and
        that of the one ``step`` names on give the rank over twice as many.
        """
        m = len(self.starts)
        names = self._names()
        # Minima are two bytes apart at least, so ``step`` names are twice as many bytes.
        step, turn = 1, 1
        while self.distinct < m and 2 * step < self.cap:
            keys = self._mapped("keys", np.uint64, m)
            for i in range(0, m, BLOCK):
                j = min(m, i + BLOCK)
                on = np.minimum(np.arange(i, j) + step, m)
                keys[i:j] = (names[i:j].astype(np.uint64) << np.uint64(32)) | names[on].astype(np.uint64)
            rank, last = 0, None
            fresh = self._mapped(f"names-{turn}", self.place, m + 1)
            fresh[m] = 0
            for block in ordered(keys, m):
                values = keys[block]
                new = np.append(True if last is None else values[0] != last, values[1:] != values[:-1])
                fresh[block] = rank + np.cumsum(new)
                rank += int(new.sum())
                last = values[-1]
            names, self.distinct = fresh, rank
            step, turn = 2 * step, 1 - turn
        keys = self._mapped("keys", np.uint64, m)
        keys[:m] = names[:m]
        for block in ordered(keys, m):
            yield self.starts[block]

    def sorted_minima(self) -> Queue:
        return self._queued("minima-queue", self._ranked(), True)


def ordered(keys: np.ndarray, m: int) -> Iterator[np.ndarray]:
    """Indexes of keys in ascending order, in blocks that fit in memory.

    Each block is a range of keys between splitters of a sample, collected by one pass over the
    file. A range of one key alone needs no sorting, however long it is.
    """
    if m <= 4 * BLOCK:
        if m:
            yield np.argsort(keys[:m], kind="stable")
        return
    sample = np.sort(np.asarray(keys[:m][:: max(1, m // 100_000)]))
    splitters = np.unique(sample[:: max(1, len(sample) * BLOCK // m)])
    edges = [*splitters.tolist(), None]
    low = 0
    for edge in edges:
        # keys in [low, edge), and edge itself apart
        for first, last, plain in ((low, edge, False), (edge, edge, True)):
            if plain and edge is None:
                continue
            parts = []
            for i in range(0, m, BLOCK):
                block = keys[i : min(m, i + BLOCK)]
                if plain:
                    hit = np.flatnonzero(block == np.uint64(edge)) + i
                    if len(hit):
                        yield hit
                    continue
                inside = block >= np.uint64(first)
                if last is not None:
                    inside &= block < np.uint64(last)
                parts.append(np.flatnonzero(inside) + i)
            if parts and (whole := np.concatenate(parts)).size:
                yield whole[np.argsort(keys[whole], kind="stable")]
        low = (edge or 0) + 1


def repeated(segments: Iterator[np.ndarray], length: int, folder: str | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Per segment its number, and where a string of ``length`` bytes begins that also begins
    elsewhere in the segments (a sorted array of offsets, possibly empty).

    The files are in a temporary folder of the task, which goes with it.
    """
    with tempfile.TemporaryDirectory(dir=folder) as place:
        path, sizes = os.path.join(place, "bytes"), []
        with open(path, "wb") as file:
            for segment in segments:
                file.write(segment.tobytes())
                # No valid text has this byte, so few strings agree across a segment's end;
                # strings that reach over one are not counted in any case.
                file.write(b"\xff")
                sizes.append(len(segment))
        if not sizes:
            return
        ends = np.cumsum(np.array(sizes) + 1)
        shard = Shard(np.memmap(path, np.uint8, "r"), length, place)
        marks = shard._mapped("marks", np.bool_, shard.n)
        marks[:] = False
        open_: list = [0, None]  # valid members so far of the class that may go on, and the last

        def visit(block: np.ndarray, small: bool) -> None:
            at, new = block["at"], block["lcp"] < length
            room = ends[np.searchsorted(ends, at, "right")] - 1 - at
            valid = room >= length
            group = np.cumsum(new)
            n = np.bincount(group, valid, minlength=group[-1] + 1)
            n[0] += open_[0]
            hit = valid & (n[group] > 1)
            marks[at[hit]] = True
            if open_[0] and n[0] > 1:
                marks[open_[1]] = True
            tail = at[valid & (group == group[-1])]
            if group[-1] == 0:
                open_[0] = int(n[0])
                open_[1] = int(tail[-1]) if len(tail) else open_[1]
            else:
                open_[0] = int(n[-1])
                open_[1] = int(tail[-1]) if len(tail) else None

        seeds = shard.sorted_minima()
        shard.sort(seeds, True, visit)
        seeds.close()
        start = 0
        for i, size in enumerate(sizes):
            yield i, np.flatnonzero(marks[start : start + size])
            start += size + 1

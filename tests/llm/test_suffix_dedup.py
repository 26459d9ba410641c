import collections
import random

import numpy as np
import pytest

from kickflow.llm import induced
from kickflow.llm.suffix_dedup import runs_of, without_repeats


def brute_starts(segments, length):
    count = collections.Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
    return [[i for i in range(len(s) - length + 1) if count[s[i : i + length]] > 1] for s in segments]


def random_segments(rng, most):
    letters = rng.integers(1, 5)
    made = [bytes(rng.integers(0, letters, rng.integers(0, most)).astype(np.uint8)) for _ in range(rng.integers(1, 7))]
    if rng.random() < 0.1:
        made.append(b"\xff\xff\x00" * 5)
    return made + [made[0][2:] + b"z" + made[-1]]


@pytest.mark.parametrize("block, held", [(1 << 21, 32 << 20), (8, 100)])
def test_induced_sorting(monkeypatch, block, held):
    """In memory, and with queues and reduced problems on disk."""
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "HELD", held)
    rng = np.random.default_rng(7)
    for _ in range(150):
        segments, length = random_segments(rng, 50), int(rng.integers(1, 12))
        data = [np.frombuffer(s, np.uint8) for s in segments]
        found = [x.tolist() for _, x in induced.repeated(iter(data), length)]
        assert found == brute_starts(segments, length)


def test_common_prefixes_and_order(tmp_path):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 500).astype(np.uint8)
    shard = induced.Shard(data, 60, str(tmp_path))
    visited = []
    shard.sort(shard.sorted_minima(), True, lambda block, small: visited.extend(block.tolist()))
    text = data.tobytes()
    at = [i for i, _ in visited]
    assert at == sorted(range(500), key=lambda i: text[i:], reverse=True)
    for (a, _), (b, lcp) in zip(visited, visited[1:], strict=False):
        common = next((k for k in range(61) if text[a + k : a + k + 1] != text[b + k : b + k + 1]), 60)
        assert lcp == min(common, 60)


def test_runs_cover_all_windows_and_agree():
    rng = np.random.default_rng(5)
    shared = bytes(rng.integers(97, 123, 80).astype(np.uint8))
    texts = [bytes(rng.integers(97, 99, n).astype(np.uint8)) + shared + b"xyz"[: n % 3] for n in (0, 1, 30, 200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    text, first, last, name, _ = runs_of(data, ends, 40, 16)
    names = collections.defaultdict(set)
    for i, t in enumerate(texts):
        windows = [w for a, b in zip(first[text == i], last[text == i], strict=True) for w in range(a, b + 1)]
        assert windows == list(range(max(0, len(t) - 39)))
        for a, b, n in zip(first[text == i], last[text == i], name[text == i], strict=True):
            for w in range(a, b + 1):
                names[t[w : w + 40]].add(n)
    assert all(len(x) == 1 for x in names.values())


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), text, starts in zip(rows, texts, brute_starts(texts, length), strict=True):
        covered = bytearray(len(text))
        for s in starts:
            covered[s : s + length] = b"\1" * length
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(covered), np.uint8), [0]]).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        kept = bytes(b for b, c in zip(text, covered, strict=True) if not c)
        out.append((i, len(text), spans, kept))
    return sorted(out, key=repr)


def sample():
    random.seed(2)
    letters = "abcdefghij éü"
    prose = lambda n: "".join(random.choice(letters) for _ in range(n))
    passage, other = prose(130), prose(64)
    rows = [(i, prose(30 + i) + passage + prose(i)) for i in range(12)]
    rows += [(20 + i, prose(7) + other[i:] + prose(9)) for i in range(5)]
    rows += [
        (40, None), (41, ""), (42, "short"), (43, "x" * 500), (44, "ab" * 200), (45, prose(3000)),
        (46, rows[0][1]), (46, rows[0][1]), (None, passage), (47, passage[:63]), (48, passage[:64]),
        (49, other + "é" + other), (50, prose(50) + rows[3][1][20:] + "!" + rows[4][1][:90]),
    ]
    return rows


@pytest.mark.parametrize("length, anchor", [(64, 24), (64, 64), (40, 8)])
def test_without_repeats(documents, monkeypatch, length, anchor):
    from kickflow.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    rows = sample()
    found = without_repeats(documents(*rows), length=length, anchor=anchor).collect()
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in found]
    assert sorted(got, key=repr) == brute(rows, length)


def test_long_texts_in_pieces(documents, monkeypatch):
    from kickflow.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    pieces = suffix_dedup._pieces([b"a" * 1000, b"", b"b" * 64], 64)
    assert [(w, o, [len(p) for p in parts]) for w, o, parts in pieces][-1][0][-1] == 2
    rows = sample()
    found = without_repeats(documents(*rows), length=64, anchor=24).collect()
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in found]
    assert sorted(got, key=repr) == brute(rows, 64)


def test_empty_table(documents):
    assert without_repeats(documents((1, "a")).where("false")).count() == 0

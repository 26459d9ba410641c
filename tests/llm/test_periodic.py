import hashlib
import random
import zlib
from math import floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kickflow.llm import periodic
from kickflow.llm.queries import QUERIES


def brute(words):
    """All runs by comparing each word with the one a period later, period by period."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            part = words[start : end + q]
            if end > start and len(part) >= max(24, 3 * q):
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((start, len(part), q))
            start = end + 1
    return sorted(found)


def found(*texts):
    texts = [periodic.Text(words) for words in texts]
    periodic.find_runs(texts)
    return [t.found() for t in texts]


def looped(rng, alphabet, n):
    words = [rng.choice(alphabet) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        first = rng.randrange(n)
        cycle = [rng.choice(alphabet) for _ in range(rng.randint(1, max(1, n // 3)))]
        for i in range(rng.randint(0, n - first)):
            words[first + i] = cycle[i % len(cycle)]
    return words


@pytest.mark.parametrize("longest", [8, 32, periodic.LONGEST])
def test_runs_against_brute_force(monkeypatch, longest):
    monkeypatch.setattr(periodic, "LONGEST", longest)
    rng = random.Random(longest)
    texts = [
        looped(rng, [b"%d" % i for i in range(rng.choice([1, 2, 3, 30]))], rng.choice([1, 23, 24, 60, 150, 400]))
        for _ in range(150)
    ]
    assert found(*texts) == [brute(words) for words in texts]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=120))
def test_any_words(words):
    assert found(words) == [brute(words)]


def test_scales_split_into_parts(monkeypatch):
    monkeypatch.setattr(periodic, "CELLS", 32)
    rng = random.Random(5)
    texts = [looped(rng, [b"a", b"b", b"c"], 200) for _ in range(20)]
    assert found(*texts) == [brute(words) for words in texts]


def test_sums_are_exact():
    """Differences whose sum is a multiple of the first prime are no occurrence."""
    p = periodic.primes(16)[0]
    step = int(p**0.5)
    rest, parts = p, []
    while rest:  # the prime as a sum of at most eight squares
        step = int(rest**0.5)
        parts.append(step)
        rest -= step * step
    assert len(parts) <= 8
    blocks = np.full((1, 8), 1, np.int64)
    windows = np.ones((1, 16), np.int64)
    windows[0, : len(parts)] += parts
    hits = periodic.occurrences(blocks, windows, int(windows.max()))
    wanted = [bool((windows[0, d : d + 8] == 1).all()) for d in range(9)]
    assert hits[0].tolist() == wanted and not wanted[0]


@pytest.mark.parametrize("points", [16, 64, 128, 4096, 1 << 13])
def test_transform_and_back(points):
    rng = np.random.default_rng(points)
    for p in periodic.primes(points):
        w = periodic.root(points, p)
        x = periodic.reduced(rng.integers(0, p, (3, points)).astype(float), p)
        again = periodic.back(periodic.transform(x, w, p), pow(w, -1, p), p)
        assert ((again - x * points) % p == 0).all()


def test_long_text_of_one_word():
    assert found([b"a"] * 50_000 + [b"b"]) == [[(0, 50_000, 1)]]


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + floor((n - a) / (3 + g % 8))
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = rewritten(doc_id, (text or "").encode().split())
    (runs,) = found(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    milli = 1000 * best[1] // best[2] if best else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)]
    return (len(runs), *(best or (None, None, None)), milli, *digests), words, runs


def test_query(spark):
    path = "/root/testdata/sf0.01"
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    some = 0
    for doc in docs:
        row, words, runs = expected(doc.doc_id, doc.text)
        assert rows[doc.doc_id] == row
        if len(words) <= 500 and zlib.crc32(str(doc.doc_id).encode()) % 10 == 0:
            some += len(runs)
            assert runs == brute(words)
    assert some > 20


def test_frames(documents):
    cycle = " ".join("abcdefgh") + "\n"
    rows = [(1, cycle * 4), (1, cycle * 4), (None, None), (2, ""), (3, " \t "), (4, "x\x1cy " * 30)]
    docs = documents(*rows).withColumnRenamed("found", "runs")
    out = periodic.periodic_runs(docs)
    assert out.columns == [c for c in docs.columns if c != "runs"] + ["runs", "collapsed"]
    got = [([tuple(r) for r in x.runs], x.collapsed) for x in out.collect()]
    one = ([(0, 32, 8)], " ".join("abcdefgh"))
    assert got == [one, one, ([], ""), ([], ""), ([], ""), ([(0, 30, 1)], "x\x1cy")]
    assert periodic.periodic_runs(docs.where("false")).count() == 0

import random

import numpy as np
import pytest

from kickflow.llm.near_dedup import drop_near, near_groups, signatures, similarity, weighted

random.seed(4)
VOCABULARY = [f"w{i}" for i in range(3000)]


def prose(n):
    return [random.choice(VOCABULARY) for _ in range(n)]


def edited(words, n):
    words = list(words)
    for i in random.sample(range(len(words)), n):
        words[i] = random.choice(VOCABULARY)
    return words


def exact(a, b):
    """The definition, term by term."""
    x, y = ({}, {})
    for words, d in ((a, x), (b, y)):
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)]
        for run in runs:
            d[run] = d.get(run, 0) + 1
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys())
    return total


def pair(a, b):
    texts = [" ".join(a), " ".join(b)]
    of, hashes, weights = weighted(texts)
    sets = [(hashes[of == i], weights[of == i]) for i in (0, 1)]
    return similarity(*sets), texts


@pytest.mark.parametrize("n, edits, repeats", [(40, 1, 1), (60, 3, 1), (30, 1, 4), (200, 8, 2), (3, 1, 1)])
def test_similarity_and_estimate(n, edits, repeats):
    a = prose(n)
    b = edited(a, edits) + prose(5)
    a, b = a * repeats + a[:10], b * repeats
    value, texts = pair(a, b)
    assert value == pytest.approx(exact(a, b))
    rows = signatures(texts, 4096)
    assert np.mean(rows[0] == rows[1]) == pytest.approx(value, abs=0.03)


def test_signature_does_not_depend_on_the_batch():
    texts = [" ".join(prose(n)) for n in (1, 4, 5, 50, 700)]
    alone = np.vstack([signatures([t], 216) for t in texts])
    assert (signatures(texts, 216) == alone).all()
    assert not signatures([""], 8).any()


def brute(rows):
    """Classes by all pairs."""
    texts = [(t or "").lower().split() for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if texts[i] and texts[j] and exact(texts[i], texts[j]) >= 0.8:
                root[find(i)] = find(j)
    out = []
    for i, (id, _) in enumerate(rows):
        members = [k for k in range(len(rows)) if find(k) == find(i)]
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        out.append((id, min(ids, default=None), len(members)))
    return sorted(out, key=repr)


def sample():
    rows, base = [], [prose(n) for n in (30, 80, 200, 400)]
    i = 100
    for words in base:
        chain = words
        for step in range(6):
            rows.append((i, " ".join(chain)))
            chain = edited(chain, max(1, len(chain) // 60))  # neighbours are close, ends need not be
            i -= 1
    rows += [(i + k, " ".join(prose(60))) for k in range(300, 320)]
    words = rows[0][1].split()
    rows += [
        (500, "  " + rows[0][1].upper() + "\n"), (501, None), (502, ""), (503, " \t"), (504, "one two"),
        (505, "One  two"), (None, rows[6][1]), (506, "one"), (507, " ".join(words[:25])),
        (508, " ".join(prose(5) * 4000)),
    ]
    return rows


def test_groups(documents):
    rows = sample()
    found = near_groups(documents(*rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in found), key=repr) == brute(rows)
    kept = [r.doc_id for r in found if r.kept]
    assert sorted(kept) == sorted({c for _, c, _ in brute(rows)} - {None})


def test_drop(documents):
    rows = sample() + [(600, "one two three"), (600, "one two three")]
    docs = documents(*rows)
    left = drop_near(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c, _ in brute(rows)} - {None})


def test_links_outside_stars(spark, documents):
    """In one bucket the least key need not be near all others that are near each other."""
    a = prose(100)
    rows = [(i, " ".join(edited(a, k))) for i, k in enumerate([0, 2, 3, 4, 4, 5, 6, 7, 8, 2, 3, 4] * 4)]
    found = near_groups(documents(*rows)).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in found), key=repr) == brute(rows)


def test_empty_table(documents):
    none = documents((1, "a")).where("false")
    assert near_groups(none).count() == 0
    assert drop_near(none).count() == 0
    only_blank = documents((1, ""), (2, None))
    assert sorted((r.doc_id, r.class_id) for r in near_groups(only_blank).collect()) == [(1, 1), (2, 2)]


def test_components(spark):
    from kickflow.llm.components import components

    random.seed(1)
    n = 400
    pairs = [(random.randrange(n), random.randrange(n)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    links = spark.createDataFrame(pairs, "a int, b int")
    found = {(r.node, r.root) for r in components(links).collect()}
    nodes = {i for a, b in pairs if a != b for i in (a, b)}
    assert found == {(i, find(i)) for i in nodes}
    assert components(links.where("false")).count() == 0


def test_shingles_of_little_text_are_held_at_once():
    """Batches of 16 MB, whose shingles take some hundred times as much, ended executors."""
    import inspect

    from kickflow.llm import near_dedup

    source = inspect.getsource(near_dedup)
    assert near_dedup.SLICE_BYTES <= 1 << 20
    assert source.count("in slices(batches, ") == source.count("SLICE_BYTES):") == 5


def test_driver_gives_back_what_is_done_with(spark, documents):
    """Before a step of many plans, what earlier steps left on the driver goes."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    used = lambda: (runtime.totalMemory() - runtime.freeMemory()) >> 20
    spark._jvm.java.lang.System.gc()
    before = used()
    for _ in range(3):
        # Objects of half a region or more are old at once, and stay until the old ones are collected.
        spark.sparkContext._gateway.new_array(spark._jvm.byte, 200 << 20)
    assert used() > before + 500
    near_groups(documents((1, "a b c d e f"), (2, "a b c d e f g")))
    assert used() < before + 400

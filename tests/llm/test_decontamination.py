import random

import numpy as np
import pytest

from kickflow.llm import decontamination
from kickflow.llm.decontamination import Items, contaminations, drop_contaminated, size_class

random.seed(6)
VOCABULARY = [f"v{i}" for i in range(500)]


def prose(n):
    return [random.choice(VOCABULARY) for _ in range(n)]


def runs(text):
    words = (text or "").lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(docs, items):
    out = []
    for d, text in docs:
        have = runs(text)
        for i, item in {(i, " ".join((t or "").lower().split())) for i, t in items}:
            want = runs(item)
            if want and len(want & have) >= 0.8 * len(want):
                out.append((d, i, len(want & have), len(want)))
    return sorted(out, key=repr)


def sample():
    items = [(i, " ".join(prose(n))) for i, n in enumerate([5, 9, 14, 20, 33, 40, 59, 120, 3, 1, 6])]
    items += [(20, None), (21, " "), (22, items[2][1]), (3, items[3][1].upper()), (None, " ".join(prose(12)))]
    docs = [(k, " ".join(prose(random.choice([10, 60, 3000])))) for k in range(30)]
    for k, (_, text) in enumerate(items):
        words = (text or "").split()
        docs.append((100 + k, " ".join(prose(50) + words + prose(4000))))
        docs.append((200 + k, " ".join(words[: -len(words) // 12] + prose(20))))
        half = len(words) // 2
        docs.append((300 + k, " ".join(words[half - 4 :] + prose(900) + words[: half + 4])))
    docs += [(None, docs[40][1]), (500, None), (501, ""), (100, docs[30][1]), (502, items[4][1].upper())]
    return docs, items


def frame(spark, items):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, n_item int, key string")


def pairs(df):
    return sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in df.collect()), key=repr)


@pytest.mark.parametrize("at_once", [20_000, 4])
def test_pairs(spark, documents, monkeypatch, at_once):
    monkeypatch.setattr(decontamination, "ITEMS_AT_ONCE", at_once)
    docs, items = sample()
    found = contaminations(documents(*docs), frame(spark, items))
    assert pairs(found) == brute(docs, items)


@pytest.mark.parametrize("at_once", [20_000, 4])
def test_drop(spark, documents, monkeypatch, at_once):
    monkeypatch.setattr(decontamination, "ITEMS_AT_ONCE", at_once)
    docs, items = sample()
    frame_ = documents(*docs)
    left = drop_contaminated(frame_, frame(spark, items))
    assert left.columns == frame_.columns
    bad = [text for d, text in docs if brute([(d, text)], items)]
    assert sorted(map(repr, (r.text for r in left.collect()))) == sorted(repr(t) for _, t in docs if t not in bad)


def test_empty_tables(spark, documents):
    docs, items = sample()
    assert contaminations(documents(*docs).where("false"), frame(spark, items)).count() == 0
    assert contaminations(documents(*docs), frame(spark, items).where("false")).count() == 0
    assert drop_contaminated(documents(*docs), frame(spark, items).where("false")).count() == len(docs)


def test_recall_of_the_search_alone():
    """Before verification: items of exactly 0.8 inside long texts are nearly always found."""
    rng = random.Random(1)
    texts, items = [], []
    for i in range(400):
        words = [f"i{i}_{j}" for j in range(rng.choice([14, 25, 54, 104]))]
        n = max(1, len(words) - 4)
        cut = words[: 4 + -(-8 * n // 10)]
        items.append(" ".join(words))
        texts.append(" ".join([f"d{i}_{j}" for j in range(rng.randrange(2000))] + cut + [f"e{i}_{j}" for j in range(900)]))
    found = Items(list(range(400)), items, 5, decontamination.HASHES).search(texts, 0.8)
    assert {(t, m) for t, m, _ in found} == {(i, i) for i in range(400)}
    assert size_class(np.array([1, 2, 3, 8, 9, 16, 17])).tolist() == [1, 2, 4, 8, 16, 16, 32]


def test_items_of_one_shingle_are_always_found():
    """Five words inside 200: no such item is missed, whatever its neighbours."""
    rng = np.random.default_rng(3)
    for part in range(4):
        items = [" ".join(f"i{part}x{n}w{j}" for j in range(5)) for n in range(250)]
        texts = []
        for item in items:
            words = [f"w{x}" for x in rng.integers(0, 10**9, 195)]
            at = int(rng.integers(0, 196))
            texts.append(" ".join([*words[:at], item, *words[at:]]))
        found = Items(list(range(250)), items, 5, 48).search(texts, 0.8)
        assert sorted((text, item) for text, item, _ in found) == [(n, n) for n in range(250)]

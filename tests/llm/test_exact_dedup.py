import hashlib
import re

from kickflow.llm.exact_dedup import drop_exact, exact_groups

ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (4, "a b "), (7, None), (6, ""), (None, "a\n\x0bb"),
    (2, "c"), (2, "c"), (1, "a b"), (None, "d"), (8, "x " * 50_000), (10, "x  " * 50_000),
]


def brute(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        ids = [j for (j, _), u in zip(rows, texts, strict=True) if u == t]
        least = min((j for j in ids if j is not None), default=None)
        out.append((i, least, len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups(documents):
    found = exact_groups(documents(*ROWS)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in found), key=repr) == brute(ROWS)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.digest for r in found}) == len({r.digest for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_drop(documents):
    docs = documents(*ROWS)
    left = drop_exact(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([3, 4, 6, 2, 1, None, 8], key=repr)


def test_empty_table(documents):
    none = documents(*ROWS).where("false")
    assert exact_groups(none).count() == 0
    assert drop_exact(none).count() == 0


def test_tree_rounds_do_not_matter(spark):
    from pyspark.sql import functions as F

    from kickflow.llm.exact_dedup import fingerprint, merge_runs

    rows = spark.range(1000).select(
        (F.col("id") % 37).cast("int").alias("run"), "id",
        fingerprint((F.col("id") % 101).cast("string")).alias("print"),
    )
    for runs, fan_in in ((1, 2), (64, 8), (5, 2)):
        found = {(r.keep, r.n) for r in merge_runs(rows, runs, fan_in).collect()}
        assert found == {(i, len(range(i, 1000, 101))) for i in range(101)}

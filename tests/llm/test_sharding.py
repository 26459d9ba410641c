import collections

from kickflow.llm.sharding import shards, write_shards

ROWS = [(i, "x" * (i % 50)) for i in range(400)] + [(None, None), (1000, "y" * 700), (5, ""), (5, "")]


def placed(df):
    return [(r.doc_id, r.n_bytes, r.shard, r.shard_bytes, r.shard_rows) for r in df.collect()]


def check(rows, limit):
    """Shards are a prefix code, their sums are right, and only oversized buckets were split."""
    sums, counts = collections.Counter(), collections.Counter()
    for _, n, shard, _, _ in rows:
        sums[shard] += n
        counts[shard] += 1
    for _, _, shard, total, n in rows:
        assert (total, n) == (sums[shard], counts[shard])
    for shard in sums:
        assert not any(other != shard and other.startswith(shard) for other in sums)
        if shard:
            parent = shard[:-1]
            assert sum(v for s, v in sums.items() if s.startswith(parent)) > limit
    return sums


def test_limits(documents):
    docs = documents(*ROWS)
    for limit in (300, 1500, 10**9):
        rows = placed(shards(docs, limit=limit))
        assert sorted((i, n) for i, n, *_ in rows if i is not None) == sorted((i, len(t)) for i, t in ROWS if i is not None)
        sums = check(rows, limit)
        assert all(v <= limit or v == 700 for v in sums.values())
    assert set(sums) == {""}


def test_hot_key(documents):
    """Rows of one key have one hash, and are split by the rest of the row."""
    rows = placed(shards(documents(*ROWS), key="source", limit=600))
    sums = check(rows, 600)
    assert all(v <= 600 or v == 700 for v in sums.values())
    assert all(len(s) > 32 for s in sums)


def test_repeated_rows_stay_together(documents):
    rows = placed(shards(documents(*[(1, "abc")] * 5), limit=4))
    assert {(r[3], r[4]) for r in rows} == {(15, 5)}


def test_files(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(documents(*ROWS), path, limit=1500)
    back = spark.read.option("recursiveFileLookup", "true").parquet(path)
    assert sorted(map(repr, back.select("doc_id", "text").collect())) == sorted(
        map(repr, documents(*ROWS).select("doc_id", "text").collect())
    )
    names = {r[1]: r[2] for r in placed(shards(documents(*ROWS), limit=1500))}
    assert {p.name for p in (tmp_path / "shards").glob("shard=*")} >= {f"shard=b{s}" for s in names.values()}


def test_empty_table(documents):
    assert shards(documents(*ROWS).where("false")).count() == 0

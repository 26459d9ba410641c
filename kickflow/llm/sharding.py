"""Shards of bounded size by extendible hashing over a directory of hash prefixes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import stored

LIMIT = 16 << 20
BITS = 64
STEP = 8


def hashed(key: F.Column, rest: list[F.Column]) -> F.Column:
    """64 bits: 32 of the key's digest, then 32 of the whole row's, which split one key's rows.

    A null key hashes like the empty text.
    """
    key = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10)
    tail = F.xxhash64(*rest).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(key.cast("long"), 32).bitwiseOR(tail)


def _prefix(hash: str, depth: int) -> F.Column:
    return F.shiftrightunsigned(hash, BITS - depth) if depth else F.lit(0).cast("long")


def directory(rows: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """The directory over ``rows`` (hash, bytes), as pages of (prefix, depth, shard sums).

    All buckets begin as one. A bucket of more than ``limit`` bytes is split on its next bit,
    others are not; the sums of ``STEP`` bits are taken in one pass, over the rows of buckets
    that are still too large. A page at ``d`` bits has an entry per prefix of ``d`` bits that
    belongs to a finished bucket, so entries grow with the number of shards and not of rows.
    Buckets that 64 bits cannot split (one row alone, or rows that are the same) stay too large.
    """
    pages, open_, depth = [], None, 0
    while depth < BITS:
        top = depth + STEP
        level = rows.select(_prefix("hash", depth).alias("base"), _prefix("hash", top).alias("leaf"), "bytes")
        if open_ is not None:
            level = level.join(open_, "base", "left_semi")
        sizes = level.groupBy("base", "leaf").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        sizes = stored(sizes, "bucket-sizes")
        # The root is a bucket of its own; later pages begin one bit below buckets too large.
        depths = range(depth if depth == 0 else depth + 1, top + 1)
        sums = reduce(
            DataFrame.unionAll,
            [
                sizes.groupBy(F.shiftrightunsigned("leaf", top - d).alias("prefix"))
                .agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
                .withColumn("depth", F.lit(d))
                for d in depths
            ],
        )
        fits = sums.where((F.col("shard_bytes") <= limit) | F.lit(top == BITS) & (F.col("depth") == top))
        entries = reduce(
            DataFrame.unionAll, [sizes.select("leaf", F.shiftrightunsigned("leaf", top - d).alias("prefix"), F.lit(d).alias("depth")) for d in depths]
        ).join(fits, ["prefix", "depth"])
        first = F.min_by(F.struct("prefix", "shard_bytes", "shard_rows"), "depth").alias("s")
        page = entries.groupBy("leaf").agg(F.min("depth").alias("depth"), first)
        page = stored(page.select("leaf", "depth", "s.*"), "directory")
        pages.append((top, page))
        open_ = sizes.join(page, "leaf", "left_anti").select(F.col("leaf").alias("base")).distinct()
        open_ = stored(open_, "open-buckets")
        if open_.isEmpty():
            break
        depth = top
    return pages


def assign(rows: DataFrame, pages: list[tuple[int, DataFrame]]) -> DataFrame:
    """``rows`` (with ``hash``) and the ``shard`` of each, the bits that all its rows share.

    Further columns: ``shard_bytes`` and ``shard_rows``. The root bucket's name is empty.
    """
    for i, (depth, page) in enumerate(pages):
        page = page.select(
            F.col("leaf").alias("_leaf"),
            F.when(F.col("depth") == 0, F.lit(""))
            .otherwise(F.expr("substring(lpad(bin(prefix), depth, '0'), 1, depth)"))
            .alias(f"_s{i}"),
            F.col("shard_bytes").alias(f"_b{i}"),
            F.col("shard_rows").alias(f"_n{i}"),
        )
        rows = rows.join(page, _prefix("hash", depth) == F.col("_leaf"), "left").drop("_leaf")
    n = range(len(pages))
    names = {"shard": "s", "shard_bytes": "b", "shard_rows": "n"}
    rows = rows.withColumns({k: F.coalesce(*[F.col(f"_{x}{i}") for i in n]) for k, x in names.items()})
    return rows.drop(*[f"_{x}{i}" for x in names.values() for i in n])


def shards(docs: DataFrame, id: str = "doc_id", text: str = "text", key: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``shard``, ``shard_bytes``, ``shard_rows``.

    Rows are placed by a hash of ``key`` (default: the id) and, if one key's rows exceed
    ``limit`` bytes, by the rest of it. Null texts have 0 bytes. Every shard fits ``limit``
    unless it is a single longer row or consists of rows that repeat each other. An empty table
    gives an empty table; other columns are not read.
    """
    rows = docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"),
        hashed(F.col(key or id), [F.col(id), F.col(text)]).alias("hash"),
    )
    rows = stored(rows, "hashed")
    placed = assign(rows, directory(rows, limit))
    return placed.select("doc_id", F.col("bytes").alias("n_bytes"), "shard", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", key: str | None = None, limit: int = LIMIT) -> None:
    """``docs`` below ``path``, a folder per shard (``shard=b...``); the rows of one share a task."""
    names = docs.columns
    rows = docs.select(
        F.struct(*[docs[name] for name in names]).alias("whole"),
        F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long").alias("bytes"),
        hashed(docs[key or id], [docs[id], docs[text]]).alias("hash"),
    )
    placed = assign(rows, directory(rows.select("hash", "bytes"), limit))
    placed = placed.select("whole.*", F.concat(F.lit("b"), "shard").alias("shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)

"""Near duplicates by ProbMinHash over weighted shingles, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kickflow.llm.common import (
    SIMILARITY,
    WORDS,
    bounded_batches,
    mix,
    shingles,
    slices,
    stored,
    tidy,
    words_of,
)
from kickflow.llm.components import components

# A pair of similarity 0.8 agrees in a band of 6 with probability 0.26; in none of 36 bands
# with 1.8e-5.
ROWS = 6
BANDS = 36
# Against rounding.
SLACK = 1e-9
# All pairs of a bucket of up to so many texts are compared, if its texts are not yet of one
# class; in larger ones, those that share a rare shingle.
BUCKET = 32
# Hash values that tell which shingles two texts lack of each other.
BITS = 2048
# Hash values by which shingles are counted, to tell rare ones from frequent ones.
SLOTS = 1 << 19
# Text whose shingles are held at once; they take some hundred times as much.
SLICE_BYTES = 1 << 20

_U = np.uint64


def weighted(texts: list[str], k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash, and how often it occurs (weight)."""
    hashes, n = shingles(texts, k)
    of = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], hashes[at], np.diff(np.append(at, len(hashes)))


def signatures(texts: list[str], m: int, k: int = WORDS) -> np.ndarray:
    """ProbMinHash signatures, a row of ``m`` shingle hashes per text.

    Each shingle is a Poisson process of a rate equal to its weight; its points are seeded by
    the shingle alone, and each falls on one of the ``m`` components. A component keeps the
    shingle of its earliest point, so two texts agree in a component with the probability
    Jaccard similarity of their weights. A shingle stops as soon as its next point is later
    than the latest of all components' earliest points. All shingles of all texts take their
    i-th point together. Texts without words have a row of zeros.
    """
    of, shingle, weight = weighted(texts, k)
    first = np.full(len(texts) * m, np.inf)
    held = np.zeros(len(texts) * m, _U)
    rate = 1.0 / weight
    time = np.zeros(len(of))
    state = mix(shingle ^ _U(0xA0761D6478BD642F))
    latest = np.full(len(texts), np.inf)
    while len(of):
        state = state + _U(0x9E3779B97F4A7C15)
        draw = mix(state)
        # 40 bits make the waiting time, 24 others the component.
        time = time - np.log(((draw >> _U(24)).astype(float) + 0.5) * 2.0**-40) * rate
        slot = of * m + ((draw & _U(0xFFFFFF)) * _U(m) >> _U(24)).astype(np.int64)
        live = time < latest[of]
        slot, at = slot[live], np.flatnonzero(live)
        np.minimum.at(first, slot, time[at])
        won = time[at] == first[slot]
        held[slot[won]] = shingle[at[won]]
        latest = first.reshape(-1, m).max(1)
        live &= time < latest[of]
        of, shingle, rate, time, state = of[live], shingle[live], rate[live], time[live], state[live]
    return held.reshape(-1, m)


def bands_of(rows: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per text and band; keys of different bands differ."""
    parts = rows.reshape(len(rows), bands, -1)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=_U)), (len(rows), bands))
    for i in range(parts.shape[2]):
        key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two texts' (hashes, weights), hashes sorted.

    For each shared shingle d: 1 / sum over all x of max(a(x) / a(d), b(x) / b(d)). With equal
    weights this is the plain Jaccard similarity.
    """
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    wa, wb = a[1].astype(float), b[1].astype(float)
    left, right = wa[i], wb[j]
    only_a, only_b = wa.sum() - left.sum(), wb.sum() - right.sum()
    # max(a(x)/a(d), b(x)/b(d)) depends on d through the ratio a(d)/b(d) alone: sort by it.
    ratio = left / right
    order = np.argsort(ratio, kind="stable")
    left, right, ratio = left[order], right[order], ratio[order]
    below_b = np.append(0.0, np.cumsum(right))
    above_a = left.sum() - np.append(0.0, np.cumsum(left))
    # x with a(x)/b(x) > a(d)/b(d) give a(x)/a(d), the others b(x)/b(d).
    at = np.searchsorted(ratio, ratio, "right")
    total = (only_a + above_a[at]) / left + (only_b + below_b[at]) / right
    return float((1 / total).sum())


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Id, words and their digest: texts of the same words are one node of the graph."""
    words = docs.select(F.col(id).alias("id"), words_of(F.col(text)).alias("words"))
    return words.withColumn("key", F.unhex(F.md5("words")))


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, similarity) of pairs (a, b) of keys, whose words are in ``texts``."""
    both = pairs.join(
        texts.select(F.col("key").alias("a"), F.col("words").alias("left")).hint("merge"), "a"
    ).join(texts.select(F.col("key").alias("b"), F.col("words").alias("right")).hint("merge"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "left", SLICE_BYTES):
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            different = list(dict.fromkeys(left + right))
            of, hashes, weights = weighted(different, words)
            cuts = np.searchsorted(of, np.arange(len(different) + 1))
            sets = {
                t: (hashes[cuts[i] : cuts[i + 1]], weights[cuts[i] : cuts[i + 1]])
                for i, t in enumerate(different)
            }
            found = [similarity(sets[x], sets[y]) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())],
                ["a", "b", "similarity"],
            )

    bounded_batches(pairs.sparkSession)
    both = both.select("a", "b", "left", "right")
    return both.mapInArrow(run, "a binary, b binary, similarity double")


def _masks(texts: DataFrame, words: int) -> DataFrame:
    """(key, mask, whole): which of ``BITS`` hash values a text's shingles have, and its weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words", SLICE_BYTES):
            of, hashes, weights = weighted(batch.column("words").to_pylist(), words)
            bits = hashes % _U(BITS)
            masks = np.zeros((len(batch), BITS // 64), _U)
            at = (of, (bits >> _U(6)).astype(np.int64))
            np.bitwise_or.at(masks, at, _U(1) << (bits & _U(63)))
            whole = np.bincount(of, weights, len(batch)).astype(np.int64)
            flat = pa.array(masks.view(np.int64).ravel())
            steps = pa.array(np.arange(len(batch) + 1) * (BITS // 64), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.ListArray.from_arrays(steps, flat), pa.array(whole)],
                ["key", "mask", "whole"],
            )

    schema = "key binary, mask array<long>, whole long"
    return stored(texts.select("key", "words").mapInArrow(run, schema), "masks")


def _pairs_of(
    rows: DataFrame, group: str, least: float, masks: DataFrame | None = None
) -> DataFrame:
    """Pairs (a, b) of keys that are in one group, but not yet of one root.

    ``spent`` is the share of a text that a pair is known not to have in common; with shares
    u and v, similarity is at most (1 - u) (1 - v) / (1 - u v). (Each term of the sum is at most
    1 / (1 / p + v / q) for a shingle's shares p and q; this is concave, so the sum is at most
    its value for the sums of p and q, which are at most 1 - u and 1 - v.) With ``masks``,
    each hash value that the other text lacks is a shingle that it lacks.
    """
    mixed = rows.groupBy(group).agg(F.min("root").alias("x"), F.max("root").alias("y"))
    rows = rows.join(mixed.where("x <> y").select(group), group)
    columns = ["root", "spent"]
    if masks is not None:
        rows = rows.join(masks.hint("merge"), "key")
        columns += ["mask", "whole"]
    left = rows.select(group, F.col("key").alias("a"), *columns)
    right = rows.select(group, F.col("key").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])

    def may_be_near(u: Column, v: Column) -> Column:
        # Without a division, as both shares may be 1.
        return (1 - u) * (1 - v) >= (least - SLACK) * (1 - u * v)

    spent = F.col("spent"), F.col("spent_b")
    wanted = (F.col("root") != F.col("root_b")) & (F.col("a") < F.col("b")) & may_be_near(*spent)
    if masks is not None:

        def lost(own: str, other: str, whole: str) -> Column:
            words = [
                F.bit_count(F.col(own)[i].bitwiseAND(F.bitwise_not(F.col(other)[i])))
                for i in range(BITS // 64)
            ]
            return reduce(add, words) / F.col(whole)

        u = F.greatest(spent[0], lost("mask", "mask_b", "whole"))
        v = F.greatest(spent[1], lost("mask_b", "mask", "whole_b"))
        # The masks are looked at only where the rest holds.
        wanted = F.when(wanted, may_be_near(u, v)).otherwise(F.lit(False))
    return left.join(right, group).where(wanted).select("a", "b")


def _tally(texts: DataFrame, words: int) -> np.ndarray:
    """How many texts have a shingle of each of ``SLOTS`` hash values, at least.

    At most that many rows leave a task, and as many come to the driver, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, np.int64)
        for batch in slices(batches, "words", SLICE_BYTES):
            _, hashes, _ = weighted(batch.column("words").to_pylist(), words)
            seen += np.bincount((hashes % _U(SLOTS)).astype(np.int64), minlength=SLOTS)
        slots = np.flatnonzero(seen)
        for some in np.array_split(slots, max(1, len(slots) // 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], ["slot", "n"])

    found = texts.select("words").mapInArrow(run, "slot long, n long")
    found = found.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int32)
    often[found["slot"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo(np.int32).max)
    return often


def _prefixes(texts: DataFrame, words: int, least: float) -> DataFrame:
    """(shingle, key, root, spent): the rarest shingles of each text, of which near ones share one.

    Similarity is at most the sum over shingles of the lesser of two texts' shares. So the
    first shared shingle, in an order that is the same for all texts, has before it at most
    ``1 - least`` of either text (``spent``). This is exact for any order. Here it is that of
    a sketch of the frequencies, which is sent to the tasks, so what many texts have in common
    makes no candidates, unless there is hardly anything else in them. Only the prefixes move.
    """
    often = texts.sparkSession.sparkContext.broadcast(_tally(texts, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words", SLICE_BYTES):
            of, hashes, weights = weighted(batch.column("words").to_pylist(), words)
            n = often.value[(hashes % _U(SLOTS)).astype(np.int64)]
            order = np.lexsort((hashes, n, of))
            of, hashes, weights, n = of[order], hashes[order], weights[order], n[order]
            before = np.cumsum(weights) - weights
            first = np.searchsorted(of, np.arange(len(batch)))
            whole = np.bincount(of, weights, len(batch))
            before = before - np.append(before, 0)[first][of]
            spent = before / whole[of]
            kept = (spent <= 1 - least + SLACK) & (n > 1)
            rows = pa.array(of[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[kept].view(np.int64)),
                    batch.column("key").take(rows),
                    batch.column("root").take(rows),
                    pa.array(spent[kept]),
                ],
                ["shingle", "key", "root", "spent"],
            )

    schema = "shingle long, key binary, root binary, spent double"
    return stored(texts.select("key", "root", "words").mapInArrow(run, schema), "rare")


def _classes(
    keyed: DataFrame, words: int, least: float, bands: int, rows: int
) -> tuple[DataFrame, DataFrame]:
    """Stored (id, key) of each row, and (node, root) of the keys that have a near duplicate."""
    spark = keyed.sparkSession
    bounded_batches(spark)
    tidy(spark)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words", SLICE_BYTES):
            texts = batch.column("words").to_pylist()
            different = list(dict.fromkeys(texts))
            at = {t: i for i, t in enumerate(different)}
            keys = bands_of(signatures(different, bands * rows, words), bands)
            column = [keys[at[t]] if t else None for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(column, pa.list_(pa.int64()))],
                ["id", "key", "bands"],
            )

    id_type = keyed.schema["id"].dataType.simpleString()
    sketched = stored(
        keyed.mapInArrow(sketch, f"id {id_type}, key binary, bands array<long>"), "sketches"
    )
    nodes = sketched.groupBy("key").agg(F.first("bands").alias("bands"))
    members = stored(nodes.select("key", F.explode("bands").alias("bucket")), "buckets")
    # A frequent bucket is combined before the shuffle.
    counts = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(members.join(counts, "bucket"), "shared")
    # What meets most others, like the text that many have been copied from, stands for its
    # buckets: the others of a bucket are compared with it.
    weight = shared.groupBy("key").agg(F.sum("n").alias("weight"))
    heavy = F.max(F.struct("weight", "key")).alias("most")
    pivots = shared.join(weight, "key").groupBy("bucket").agg(heavy, F.count("*").alias("n"))
    pivots = stored(pivots.select("bucket", F.col("most.key").alias("pivot"), "n"), "pivots")
    # All texts that may be compared, moved once.
    wanted = shared.select("key").distinct().hint("merge")
    texts = keyed.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("words").alias("words"))
    texts = stored(texts, "texts")
    tidy(spark)
    stars = shared.join(pivots, "bucket").where("key <> pivot")
    stars = stars.select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    stars = stored(_compared(stars, texts, words), "compared")
    links = stars.where(F.col("similarity") >= least - SLACK)
    roots = stored(components(links), "roots")
    # A pair without a pivot matters only where a bucket still has several components.
    ends = roots.select(F.col("node").alias("key"), "root")
    placed = members.join(pivots.where("n > 2"), "bucket").join(ends, "key", "left")
    placed = placed.select("bucket", "n", "pivot", "key", F.coalesce("root", "key").alias("root"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    open_ = open_.where("x <> y").select("bucket")
    placed = stored(placed.where("key <> pivot").join(open_, "bucket"), "open")
    tidy(spark)
    few = placed.where(F.col("n") <= BUCKET).select("bucket", "key", "root", F.lit(0.0).alias("spent"))
    few = _pairs_of(few, "bucket", least)
    many = placed.where(F.col("n") > BUCKET).select("key", "root").distinct()
    many = stored(many.join(texts.hint("merge"), "key"), "crowded")
    rare = _pairs_of(_prefixes(many, words, least), "shingle", least, _masks(many, words))
    more = few.unionByName(rare).distinct()
    more = stored(more.join(stars.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    tidy(spark)
    if not more.isEmpty():
        found = stored(_compared(more, texts, words), "compared")
        links = links.unionByName(found.where(F.col("similarity") >= least - SLACK))
        roots = stored(components(links), "roots")
    return sketched.select("id", "key"), roots


def near_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id``, ``class_size``, ``kept``.

    Two texts are linked if the probability Jaccard similarity of their runs of ``words``
    words, weighted by how often each occurs, is at least ``least``; a class is a connected
    component, named by its smallest id (nulls last), and that row is kept (one of them, if
    several rows repeat the id). Words are compared in lower case, without regard to the kind
    of white space. Texts of the same words are one class. Null texts and texts without words
    have no shingles and are classes of their own. Other columns are not read. An empty table gives an
    empty table.
    """
    rows_, roots = _classes(_keyed(docs, id, text), words, least, bands, rows)
    blank = F.unhex(F.md5(F.lit("")))
    rows_ = stored(
        rows_.select(
            F.col("id").alias("doc_id"), "key", F.monotonically_increasing_id().alias("row")
        ).join(roots, F.col("key") == roots["node"], "left")
        .select(
            "doc_id",
            "row",
            F.coalesce("root", "key").alias("root"),
            F.when(F.col("key") == blank, F.col("row")).alias("alone"),
        ),
        "rows",
    )
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = rows_.groupBy("root", "alone").agg(smallest.alias("least"), F.count("*").alias("class_size"))
    classes = classes.withColumnsRenamed({"root": "r", "alone": "s"})
    same = (rows_["root"] == classes["r"]) & rows_["alone"].eqNullSafe(classes["s"])
    return rows_.join(classes, same).select(
        "doc_id",
        F.col("least.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("least.row")).alias("kept"),
    )


def drop_near(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    least: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all their columns.

    Rows that repeat the smallest id of a class are told apart by their other columns; the
    smallest stays. Rows without words all stay.
    """
    names = docs.columns
    keyed = _keyed(docs, id, text)
    held, roots = _classes(keyed, words, least, bands, rows)
    blank = F.unhex(F.md5(F.lit("")))
    placed = held.where(F.col("key") != blank).join(roots, F.col("key") == roots["node"], "left")
    placed = stored(placed.select("id", "key", F.coalesce("root", "key").alias("root")), "rows")
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    classes = placed.groupBy("root").agg(smallest.alias("least"), F.count("*").alias("n"))
    several = placed.join(classes.where("n > 1"), "root")
    stays = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("key") == F.col("least.key"))
    several = several.select("id", "key", "root", stays.alias("stays")).distinct()
    several = stored(several, "classes")
    whole = docs.select(
        F.struct(*[docs[name] for name in names]).alias("whole"),
        docs[id].alias("id"),
        F.unhex(F.md5(words_of(docs[text]))).alias("key"),
    )
    gone = several.where("NOT stays").select("id", "key")
    same = whole["id"].eqNullSafe(gone["id"]) & (whole["key"] == gone["key"])
    rest = whole.join(gone, same, "left_anti")
    # Rows of a class that repeat both the id and the words.
    twice = placed.groupBy("id", "key").agg(F.count("*").alias("n")).where("n > 1")
    twice = stored(twice.select(F.col("id").alias("i"), F.col("key").alias("k")), "twice")
    marked = rest.join(
        twice, rest["id"].eqNullSafe(twice["i"]) & (rest["key"] == twice["k"]), "left"
    )
    once = marked.where("k IS NULL").select("whole.*")
    again = marked.where("k IS NOT NULL").groupBy("id", "key").agg(F.min("whole").alias("whole"))
    return once.unionByName(again.select("whole.*"))

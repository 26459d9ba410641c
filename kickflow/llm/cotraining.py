"""Text quality by co-training: a classifier of the text and one of the page's metadata."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from kickflow.llm.common import bounded_batches, slices, stored

LABELLED = 20_000
ROUNDS = 5
# In a round each view labels this share of the pool for the other, where it is this sure.
SHARE = 0.05
SURE = 0.9
THRESHOLD = 0.5
BUCKETS = 32
# Steps of the logit in which the surest rows are counted, and their number.
STEP = 0.001
STEPS = 30_000

_words = re.compile(r"\w+").findall
TEXT_FEATURES = 20


def text_features(text: str | None) -> list[float]:
    """What a text looks like: shares of kinds of characters, repetition, lengths, entropy."""
    text = text or ""
    n, words = max(len(text), 1), text.split()
    tokens = _words(text)
    k = max(len(words), 1)
    letters = Counter(text)
    lines = text.split("\n")
    filled = [line for line in lines if line.strip()]
    count = lambda test: sum(c for x, c in letters.items() if test(x)) / n
    entropy = -sum(c / n * math.log2(c / n) for c in letters.values())
    counts = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / k
    pairs = Counter(zip(words, words[1:], strict=False))
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        sum(map(len, words)) / k,
        len(counts) / k,
        max(counts.values(), default=0) / k,
        again,
        max(pairs.values(), default=0) / k,
        count(str.isupper),
        count(str.isdigit),
        count(str.isspace),
        count(lambda x: not x.isalnum() and not x.isspace()),
        count(lambda x: x in ".,;:"),
        count(lambda x: x in "!?"),
        count(lambda x: x in "#$%&*|<>{}[]=_~^@\\/"),
        sum(w.isupper() for w in words) / k,
        sum(not any(map(str.isalnum, w)) for w in words) / k,
        sum(w[-1] in "!#$%&*" for w in words) / k,
        len(set(filled)) / max(len(filled), 1),
        entropy,
        max(map(len, tokens), default=0) / 20,
    ]


def metadata_features(values: list, length: float | None) -> list[float]:
    """Length and hashed categories; a null value is a category of its own."""
    row = [0.0] * (2 + BUCKETS * len(values))
    row[0], row[1] = math.log1p(max(length or 0, 0)), float(length is None)
    for i, value in enumerate(values):
        key = "" if value is None else f"={value}"
        row[2 + BUCKETS * i + zlib.crc32(key.encode("utf-8")) % BUCKETS] = 1.0
    return row


@dataclass
class View:
    """A logistic regression on one view, and the line that calibrates its logit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return self.slope * (np.clip(z, -8, 8) @ self.weights[1:] + self.weights[0]) + self.shift


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (intercept first) by Newton's method with a ridge penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sums(view: View, x: np.ndarray, y: np.ndarray, weight: float) -> list[np.ndarray]:
    """Gradient and Hessian of the rows' logistic loss at the view's weights."""
    x = np.column_stack([np.ones(len(x)), np.clip((x - view.mean) / view.scale, -8, 8)])
    p = _probability(x @ view.weights)
    return [x.T @ (weight * (p - y)), (x * (weight * p * (1 - p))[:, None]).T @ x]


def _given(history: list, x: tuple) -> list[np.ndarray]:
    """What labels (or -1) each view has been given for pool rows, after the rounds so far."""
    given = [np.full(len(x[0]), -1) for _ in x]
    for models, lines in history:
        for i in (0, 1):
            z, other = models[i].logit(x[i]), given[1 - i]
            free = other < 0
            other[free & (z >= lines[i][1])] = 1
            other[free & (-z >= lines[i][0])] = 0
        clash = (given[0] >= 0) & (given[1] >= 0) & (given[0] != given[1])
        for pseudo in given:
            pseudo[clash] = -1
    return given


def _fit(views: tuple, y: np.ndarray, history: list, total: Callable) -> list[View]:
    """A view's model each, by Newton's method on sums over labelled rows and the pool."""

    def moments(x: tuple) -> list[np.ndarray]:
        taken = [v[g >= 0] for v, g in zip(x, _given(history, x), strict=True)]
        return [z for t in taken for z in (np.array([len(t)]), t.sum(0), (t**2).sum(0))]

    extra = total(moments) if history else None
    models, steps = [], [np.inf, np.inf]
    for i, x in enumerate(views):
        sums = [np.array([len(x)]), x.sum(0), (x**2).sum(0)]
        if extra:
            sums = [a + b for a, b in zip(sums, extra[3 * i : 3 * i + 3], strict=True)]
        mean = sums[1] / sums[0]
        scale = np.sqrt(np.maximum(sums[2] / sums[0] - mean**2, 0))
        scale[scale < 1e-6] = 1.0
        models.append(View(mean, scale, np.zeros(x.shape[1] + 1)))

    def slopes(x: tuple) -> list[np.ndarray]:
        out = []
        for model, v, g in zip(models, x, _given(history, x), strict=True):
            out += _sums(model, v[g >= 0], g[g >= 0], 0.5)
        return out

    for _ in range(30):
        extra = total(slopes) if history else None
        for i, (model, x) in enumerate(zip(models, views, strict=True)):
            gradient, hessian = _sums(model, x, y, 1.0)
            if extra:
                gradient, hessian = gradient + extra[2 * i], hessian + extra[2 * i + 1]
            penalty = np.append(1e-6, np.ones(x.shape[1]))
            step = np.linalg.solve(hessian + np.diag(penalty + 1e-9), gradient + penalty * model.weights)
            model.weights = model.weights - step
            steps[i] = np.abs(step).max()
        if max(steps) < 1e-6:
            break
    return models


def _lines(models: list[View], history: list, total: Callable, wanted: tuple[int, int]) -> list:
    """Per view and label the logit from which on it labels rows: about ``wanted`` of the surest.

    Rows are counted in steps of the logit; a step is taken whole, and the first in any case.
    """
    sure = float(np.log(SURE / (1 - SURE)))

    def counts(x: tuple) -> list[np.ndarray]:
        out, given = [], _given(history, x)
        for i in (0, 1):
            z = models[i].logit(x[i])[given[1 - i] < 0]
            for side in (-z, z):
                at = np.minimum((side[side >= sure] - sure) / STEP, STEPS - 1).astype(int)
                out.append(np.bincount(at, minlength=STEPS))
        return out

    lines = []
    for j, n in enumerate(total(counts)):
        down = np.cumsum(n[::-1])
        some = np.flatnonzero(down)
        taken = max(int(np.searchsorted(down, wanted[j % 2], "right")), int(some[0]) + 1 if len(some) else 0)
        lines.append(sure + STEP * (STEPS - taken) if len(some) else np.inf)
    return [lines[:2], lines[2:]]


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Model:
    views: list[View]
    weights: np.ndarray

    def score(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by both views together, by the text, and by the metadata."""
        logits = [v.logit(x) for v, x in zip(self.views, (text, metadata), strict=True)]
        both = self.weights[0] + self.weights[1] * logits[0] + self.weights[2] * logits[1]
        return tuple(_probability(x) for x in (both, *logits))


def co_train(
    text: np.ndarray,
    metadata: np.ndarray,
    labels: np.ndarray,
    pool_text: np.ndarray | None = None,
    pool_metadata: np.ndarray | None = None,
    rounds: int = ROUNDS,
    share: float = SHARE,
    total: Callable | None = None,
    n_pool: int | None = None,
) -> Model:
    """Two views teach each other on the pool, then are calibrated and combined.

    Every third labelled row calibrates and is not learnt from. In a round each view gives the
    other the pool rows it is surest of, as many per label as the labels' shares ask for;
    what both have been given with different labels is dropped. Pseudo-labels weigh a half.
    Of the pool only sums are needed: ``total`` adds up what a function returns for its parts.
    """
    views, pools = (text, metadata), (pool_text, pool_metadata)
    if total is None:
        total, n_pool = (lambda part: part(pools)), len(pool_text)
    aside = np.arange(len(labels)) % 3 == 2
    if len(np.unique(labels[~aside])) < 2 or len(np.unique(labels[aside])) < 2:
        aside = np.zeros(len(labels), bool)
    learn, check = ~aside, aside if aside.any() else ~aside
    positive = labels[learn].mean()
    history: list = []
    learnt = tuple(x[learn] for x in views)
    models = _fit(learnt, labels[learn].astype(float), history, total)
    n = max(1, int(share * n_pool))
    wanted = (max(1, int(n * (1 - positive))), max(1, int(n * positive)))
    for _ in range(rounds if n_pool else 0):
        history.append((models, _lines(models, history, total, wanted)))
        models = _fit(learnt, labels[learn].astype(float), history, total)
    models = [View(m.mean, m.scale, m.weights) for m in models]
    for model, x in zip(models, views, strict=True):
        line = _logistic(model.logit(x[check])[:, None], labels[check], np.ones(check.sum()), 1e-2)
        if line[1] > 0:
            model.slope, model.shift = float(line[1]), float(line[0])
    logits = np.column_stack([m.logit(x[check]) for m, x in zip(models, views, strict=True)])
    return Model(models, _logistic(logits, labels[check], np.ones(check.sum()), 1e-2))


def features(docs: DataFrame, id: str, text: str, categories: list[str], length: str) -> DataFrame:
    """Stored (id, text_view, metadata_view) of every row; the texts are read once."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id).alias("id"),
        F.col(text).alias("text"),
        F.col(length).cast("double").alias("length"),
        F.array(*[F.col(c).cast("string") for c in categories]).alias("categories"),
    )
    view = ArrayType(FloatType())
    schema = StructType(
        [rows.schema["id"], StructField("text_view", view), StructField("metadata_view", view)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            metadata = zip(
                batch.column("categories").to_pylist(), batch.column("length").to_pylist(), strict=True
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([text_features(t) for t in batch.column("text").to_pylist()], FLOATS),
                    pa.array([metadata_features(c, n) for c, n in metadata], FLOATS),
                ],
                schema.names,
            )

    return stored(rows.mapInArrow(run, schema), "features")


FLOATS = pa.list_(pa.float32())
# Sums of tasks that are added up at once, and that the driver gets.
MERGED = 8


def _packed(sums: list[np.ndarray]) -> bytes:
    return zlib.compress(pickle.dumps(sums), 1)


def _added(packed: Iterable[bytes]) -> list[np.ndarray] | None:
    """The sums of sums, one after the other; None if there are none."""
    total = None
    for x in packed:
        found = pickle.loads(zlib.decompress(x))
        total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
    return total


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    flat = [batch.column(x).flatten().to_numpy() for x in ("text_view", "metadata_view")]
    return tuple(x.astype(float).reshape(len(batch), -1) if len(batch) else np.zeros((0, 0)) for x in flat)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    categories: tuple[str, ...] = ("lang", "source"),
    length: str = "n_chars",
    label_id: str = "doc_id",
    label: str = "quality",
    labelled: int = LABELLED,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score``, ``text_score``, ``metadata_score``.

    Scores are probabilities of label 1. The classifiers learn from at most ``labelled`` rows
    with a label (0 or 1; the highest, if a document has several), the first by a hash of the
    id, and all rows without. Null texts count as empty, null metadata is a value
    of its own; a null id has no label. With labels of one kind alone every score is that
    label, and 0.5 without any. An empty table gives an empty table.
    """
    rows = features(docs, id, text, list(categories), length)
    marks = labels.select(F.col(label_id).alias("i"), F.col(label).cast("int").alias("label"))
    marks = marks.where("label IN (0, 1)").groupBy("i").agg(F.max("label").alias("label"))
    joined = rows.join(marks, rows["id"] == marks["i"], "left").withColumn("order", F.xxhash64("id"))
    known = joined.where("label IS NOT NULL").orderBy("order", "id", "text_view").limit(labelled).collect()
    y = np.array([r.label for r in known], float)
    if len(set(y.tolist())) < 2:
        flat = float(y[0]) if len(y) else 0.5
        return rows.select(
            F.col("id").alias("doc_id"),
            *[F.lit(flat).alias(x) for x in ("score", "text_score", "metadata_score")],
        )
    matrix = lambda rows, name, width: np.array([r[name] for r in rows], float).reshape(len(rows), width)
    width = 2 + BUCKETS * len(categories)
    pool = stored(joined.where("label IS NULL").select("text_view", "metadata_view"), "pool")
    pool_tasks = pool.rdd.getNumPartitions()

    def total(part: Callable) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                if not len(batch):
                    continue
                found = part(_views(batch))
                sums = found if sums is None else [a + b for a, b in zip(sums, found, strict=True)]
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array([_packed(sums)])], ["sums"])

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = _added(x for batch in batches for x in batch.column("sums").to_pylist())
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array([_packed(sums)])], ["sums"])

        found, tasks = pool.mapInArrow(run, "sums binary"), pool_tasks
        # A tree of merges: the driver gets as many sums however many tasks there are.
        while tasks > MERGED:
            tasks = max(MERGED, -(-tasks // MERGED))
            found = found.repartition(tasks).mapInArrow(merged, "sums binary")
        return _added(row.sums for row in found.collect())

    model = co_train(
        matrix(known, "text_view", TEXT_FEATURES),
        matrix(known, "metadata_view", width),
        y,
        total=total,
        n_pool=pool.count(),
    )
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("doc_id", rows.schema["id"].dataType)])
    for name in ("score", "text_score", "metadata_score"):
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = held.value.score(*_views(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(x) for x in found]], schema.names
            )

    return rows.mapInArrow(run, schema)

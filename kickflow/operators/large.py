"""Replies too large to be one row's work: their arrays are cut between elements.

A scan over brackets and quotes finds where the elements of an array are, without reading any. The
body becomes pieces of bounded size, each a body of its own with some of the elements in order,
and one with all other members. Tasks parse the pieces apart; what they find wrong is put
together per body, so that the rows are those of the reply read as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.functions.bodies import member
from kickflow.operators.rows import rows_or_error
from kickflow.session import stored

# Bytes that are scanned at once, and that are handed on at once.
STEP, HANDED = 1 << 20, 4 << 20
# Bytes of a body that is not worth arrays.
SMALL = 1 << 13


def _marks(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Places, characters and depths of the brackets, commas and colons outside of strings.

    Only those of the outermost object and of what is directly in it (a bracket has the depth
    of its inside). None if the brackets or quotes do not close.
    """
    found, inside, slashes, depth = [], 0, 0, 0
    for start in range(0, len(body), STEP):
        c = np.frombuffer(body, np.uint8, min(STEP, len(body) - start), start)
        at = np.arange(len(c))
        # Backslashes in a row up to each place, to tell escaped quotes.
        last = np.maximum.accumulate(np.where(c == 92, -1, at))
        run = np.where(last < 0, at + 1 + slashes, at - last)
        quote = (c == 34) & (np.concatenate([[slashes], run[:-1]]) % 2 == 0)
        text = (np.cumsum(quote) + inside) % 2 == 1
        opens, closes = np.isin(c, (91, 123)) & ~text, np.isin(c, (93, 125)) & ~text
        level = depth + np.cumsum(opens.astype(np.int64) - closes)
        own = level + closes
        kept = np.flatnonzero((opens | closes | (np.isin(c, (44, 58)) & ~text)) & (own <= 2))
        found.append((kept + start, c[kept], own[kept]))
        inside, slashes, depth = (inside + int(quote.sum())) % 2, int(run[-1]), int(level[-1])
        if level.min() < 0:
            return None
    if inside or depth or not found:
        return None
    places, chars, depths = (np.concatenate(x) for x in zip(*found, strict=True))
    return places, chars, depths


def marks(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    return _small_marks(body) if len(body) < SMALL else _marks(body)


# A string or, alone, one of the characters that count; an open quote is one, too.
_token = re.compile(rb'"(?:[^"\\]|\\.)*"|[\[\]{},:"\\]', re.DOTALL)


def _small_marks(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """``marks`` of a short body, for which arrays of all its characters would take longer."""
    places, chars, depths, depth = [], [], [], 0
    for token in _token.finditer(body):
        c = body[token.start()]
        if c == 34:
            if token.end() == token.start() + 1:
                return None
            continue
        if c == 92:
            # A backslash outside of strings may escape a quote: the long way tells.
            return _marks(body)
        opens, closes = c in (91, 123), c in (93, 125)
        depth += opens - closes
        if depth < 0:
            return None
        if depth + closes <= 2:
            places.append(token.start())
            chars.append(c)
            depths.append(depth + closes)
    if depth or not places:
        return None
    return np.array(places), np.array(chars, np.uint8), np.array(depths)


def pieces(body: bytes, name: str, most: int) -> list[tuple[int, int]] | None:
    """Ranges of ``body``: the array ``name`` of the outermost object, then its parts.

    A part has whole elements and ``most`` bytes, more only for its last one. None if there is
    nothing to cut, or the scan cannot tell: no such array or several, open brackets, a part
    without any element.
    """
    found = marks(body)
    if found is None:
        return None
    places, chars, depths = found
    key = re.compile(rb'[{,]\s*"' + re.escape(name.encode()) + rb'"\s*\Z')
    window = len(name) + 64
    colons = np.flatnonzero((chars == 58) & (depths == 1))
    own = [i for i in colons.tolist() if key.search(body[max(0, places[i] - window) : places[i]])]
    if len(own) != 1 or own[0] + 1 == len(places) or chars[own[0] + 1] != 91:
        return None
    first = own[0] + 1
    if body[places[own[0]] + 1 : places[first]].strip() or depths[first] != 2:
        return None
    last = first + 1 + int(np.argmax((chars[first + 1 :] == 93) & (depths[first + 1 :] == 2)))
    commas = places[first + 1 : last][chars[first + 1 : last] == 44]
    start, end = int(places[first]), int(places[last])
    parts, at = [], start + 1
    while at <= end:
        i = int(np.searchsorted(commas, at + most))
        cut = int(commas[i]) if i < len(commas) else end
        if not body[at:cut].strip():
            return None
        parts.append((at, cut))
        at = cut + 1
    return [(start, end), *parts]


def cut(replies: DataFrame, name: str, most: int) -> DataFrame:
    """Replies as rows ``source, piece, body`` beside their columns; piece 0 is all but the array.

    A body that is not cut is piece 0 as a whole.
    """
    schema = T.StructType([*replies.schema, *T.StructType.fromDDL("source STRING, piece INT")])
    rows = replies.withColumns({"source": F.sha2("body", 256), "piece": F.lit(0)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The pieces of many bodies are handed on together, those of a large one by and by.
            held: list[tuple[int, int, bytes]] = []
            size = 0
            for i, text in enumerate(batch.column("body").cast(pa.binary())):
                for n, body in _cut(text.as_py(), name, most):
                    held.append((i, n, body))
                    size += len(body)
                    if size >= HANDED:
                        yield _rows(batch, held)
                        held, size = [], 0
            if held:
                yield _rows(batch, held)

    return rows.mapInArrow(run, schema)


def _cut(text: bytes, name: str, most: int) -> Iterator[tuple[int, bytes]]:
    """The pieces of one body, by number; the body itself where it can't be cut."""
    found = pieces(text, name, most)
    if found is None:
        yield 0, text
        return
    (start, end), *parts = found
    yield 0, text[: start + 1] + text[end:]
    for n, (a, b) in enumerate(parts, 1):
        yield n, b'{"%s":[%s]}' % (name.encode(), text[a:b])


def _rows(batch: pa.RecordBatch, held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """The row of each piece, with its body."""
    rows, numbers, bodies = zip(*held, strict=True)
    at = pa.array(rows, pa.int64())
    own = {
        "piece": pa.array(numbers, pa.int32()),
        "body": pa.array(bodies, pa.binary()).cast(pa.string()),
    }
    columns = [own.get(x, batch.column(x).take(at) if x not in own else None) for x in batch.schema.names]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def rows_by_pieces(
    replies: DataFrame, name: str, found: Callable[[], Column], most: int, on_bad: str
) -> DataFrame:
    """``rows_or_error`` for replies whose bodies may have any size.

    ``found`` gives the records of a body. Only bodies of more than ``most`` bytes are cut; their
    pieces are written to the shared folder, dealt to all tasks. A body of which one piece
    cannot be read counts as unreadable, and with ``on_bad="truncate"`` no piece after one
    with a bad element counts.
    """
    large = (F.col("status_code") == 200) & (F.octet_length("body") > most)
    large = F.coalesce(large, F.lit(False))
    whole = rows_or_error(replies.where(~large), found(), on_bad)
    parts = cut(replies.where(large), name, most).repartition("source", "piece")
    parts, _ = stored(parts, "pieces")
    records = found()
    readable = member(F.col("body"), [name], T.ArrayType(T.VariantType())).isNotNull()
    seen = parts.select(
        "source",
        readable.alias("readable"),
        F.when(F.exists(records, lambda r: r.isNull()), F.col("piece")).alias("bad"),
    )
    # Bodies without any fault have no verdict, so that their pieces need not move to meet it.
    seen = seen.where("NOT readable OR bad IS NOT NULL")
    verdicts = seen.groupBy("source").agg(F.min("readable").alias("readable"), F.min("bad").alias("bad"))
    judged = parts.join(verdicts, "source", "left")
    judged = judged.withColumn("readable", F.coalesce("readable", F.lit(True)))
    counted = F.lit(True) if on_bad == "skip" else F.col("bad").isNull() | (F.col("piece") <= F.col("bad"))
    judged = judged.where((F.col("readable") & counted) | (~F.col("readable") & (F.col("piece") == 0)))
    judged = judged.withColumn("body", F.when(F.col("readable"), F.col("body")))
    rows = rows_or_error(judged.select("key", "ds", "status_code", "body"), records, on_bad)
    return whole.unionByName(rows)

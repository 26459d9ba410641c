"""What replies look like, day by day: shapes that are kept and merged instead of inferred anew.

A sketch is one row per endpoint and day: the union of all that the day's records have, as a
type. Sketches are merged without the replies, so inference reads days that have none yet, and
two neighbouring days tell what came, went or changed between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.functions.bodies import has_object, member, plain
from kickflow.functions.nested import leaves
from kickflow.sinks.store import Store

NOTHING = T.NullType()


def sketches(replies: DataFrame, path: Sequence[str]) -> DataFrame:
    """``ds, shape, records, replies``: the records of the array at ``path`` on each day.

    A day without a record has no shape. One aggregation, combined in the tasks first.
    """
    records = member(F.col("body"), path, T.ArrayType(T.VariantType()))
    good = replies.select("ds", F.when(F.col("status_code") == 200, records).alias("records"))
    whole = good.select("ds", F.explode_outer("records").alias("record"))
    known = F.when(has_object(F.col("record")), F.col("record"))
    found = whole.groupBy("ds").agg(
        F.schema_of_variant_agg(known).alias("shape"), F.count(known).alias("records")
    )
    return found.withColumn("shape", F.when(F.col("records") > 0, F.col("shape")))


def parsed(shape: str) -> T.DataType:
    """A type as Spark names it for variants."""
    quoted = re.split(r"(`(?:[^`]|``)*`)", shape)
    quoted[::2] = [part.replace("OBJECT<", "STRUCT<") for part in quoted[::2]]
    return T.DataType.fromDDL("".join(quoted))


def united(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that has a place for the values of both, as inference over all of them finds it."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a}
        for f in b:
            fields[f.name] = united(fields.get(f.name, NOTHING), f.dataType)
        return T.StructType([T.StructField(name, fields[name]) for name in sorted(fields)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(united(a.elementType, b.elementType))
    numbers = [_number(x) for x in (a, b)]
    if None in numbers:
        return T.VariantType()
    if T.DoubleType() in (a, b):
        return T.DoubleType()
    scale = max(s for _, s in numbers)
    digits = max(p - s for p, s in numbers) + scale
    return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()


def _number(x: T.DataType) -> tuple[int, int] | None:
    if isinstance(x, T.DecimalType):
        return x.precision, x.scale
    return {T.LongType(): (20, 0), T.DoubleType(): (0, 0)}.get(x)


def record_of(shapes: Iterable[str | None]) -> T.StructType:
    """The record shape for all of some sketches."""
    found = reduce(united, [parsed(x) for x in shapes if x], NOTHING)
    return plain(found) if isinstance(found, T.StructType) else T.StructType([])


def refresh(store: Store, endpoint: str, replies: DataFrame, path: Sequence[str], days: Iterable[str] = ()) -> int:
    """Sketch the days of ``replies`` that have no sketch yet, and ``days`` anew; how many that were.

    Only these days of the replies are read.
    """
    table = f"shapes_{endpoint}"
    held = store.state().tables.get(table)
    again = set(days)
    known = sorted(set(held.days if held else ()) - again)
    staged = store.stage(table, sketches(replies.where(~F.col("ds").isin(known)), path))
    store.commit([staged], days={*staged.counts, *again})
    return len(staged.counts)


def inferred(store: Store, endpoint: str, first: str | None = None, last: str | None = None) -> T.StructType:
    """The record shape of an endpoint's sketched days; reads no reply."""
    rows = store.read(f"shapes_{endpoint}", first, last).select("shape").distinct()
    return record_of(row.shape for row in rows.collect())


def drift(store: Store, endpoint: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """What changed, and on which day: ``ds, field, change, type, before``.

    ``change`` is ``came``, ``went`` or ``changed`` (the type, where all numbers are one), against the last day before that
    had records. Days without records tell nothing.
    """
    days = store.read(f"shapes_{endpoint}", first, last).where("shape IS NOT NULL")
    # Each different shape is taken apart once; there are no more of them than days.
    known = [row.shape for row in days.select("shape").distinct().collect()]
    parts = [(shape, ".".join(path), kind) for shape in known for path, kind in _leaves(shape)]
    fields = store.spark.createDataFrame(parts, "shape STRING, field STRING, type STRING")
    # One short row a day: which day came before each.
    days = days.select("ds", "shape", F.lag("ds").over(Window.orderBy("ds")).alias("before"))
    own = days.join(fields, "shape").drop("shape")
    old = own.select(F.col("ds").alias("before"), "field", F.col("type").alias("was"))
    after = days.select("before", F.col("ds").alias("next")).where("before IS NOT NULL")
    came = own.where("before IS NOT NULL").join(old, ["before", "field"], "left").where("was IS NULL OR was <> type")
    came = came.select("ds", "field", F.when(F.col("was").isNull(), "came").otherwise("changed").alias("change"), "type", F.col("was").alias("before"))
    now = own.select(F.col("ds").alias("next"), "field")
    went = old.join(after, "before").join(now, ["next", "field"], "left_anti")
    went = went.select(F.col("next").alias("ds"), "field", F.lit("went").alias("change"), F.lit(None).cast("string").alias("type"), F.col("was").alias("before"))
    return came.unionByName(went)


def _leaves(shape: str) -> Iterator[tuple[tuple[str, ...], str]]:
    record = parsed(shape)
    if isinstance(record, T.StructType):
        record = plain(record)
        for path in leaves(record):
            kind = reduce(lambda at, name: at[name].dataType, path, record)
            # A feed writes the same number as 1 or as 1.0.
            number = isinstance(kind, (T.LongType, T.DecimalType, T.DoubleType))
            yield path, "number" if number else kind.simpleString()

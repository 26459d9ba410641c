"""Shapes of replies by day: kept, merged and compared."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.operators import endpoints
from kickflow.plans import shapes
from kickflow.schemas import REPLIES
from kickflow.session import shared_folder
from kickflow.sinks.store import Store


@pytest.fixture
def store(spark):
    return Store(spark, shared_folder(spark, "shapes"))


def frame(spark, *rows):
    """Shots out of (ds, record or body)."""
    rows = [(ds, x if isinstance(x, str) else json.dumps({"shotmap": [x]})) for ds, x in rows]
    return spark.createDataFrame([("shotmap", "k", 200, body, ds) for ds, body in rows], REPLIES)


DAYS = ["2023-08-01", "2023-08-02", "2023-08-03", "2023-08-04"]


def any_value(rng, depth=0):
    kind = rng.randrange(9 if depth < 2 else 7)
    if kind < 7:
        return rng.choice([None, True, 1, 10**18, 1.5, 0.125, 123456.75, 1e300, "x", ""])
    if kind == 7:
        return [any_value(rng, depth + 1) for _ in range(rng.randint(0, 2))]
    return {name: any_value(rng, depth + 1) for name in rng.sample(["a", "b", "c", "D e", "f`g"], rng.randint(0, 3))}


def test_merged_sketches_are_the_inference_over_all(spark, store):
    """Whatever the records, and whichever way they are dealt to days."""
    for seed in range(12):
        rng = random.Random(seed)
        records = [{n: any_value(rng) for n in rng.sample("uvwxyz", 3)} for _ in range(8)]
        rows = frame(spark, *[(DAYS[i % 4], r) for i, r in enumerate(records)])
        wanted = endpoints.infer(rows, ["shotmap"])
        found = [r.shape for r in shapes.sketches(rows, ["shotmap"]).collect()]
        for _ in range(3):
            rng.shuffle(found)
            assert fields(shapes.record_of(found)) == fields(wanted), seed


def fields(record):
    """A type whatever the order of its fields."""
    if isinstance(record, T.StructType):
        return {f.name: fields(f.dataType) for f in record}
    return [fields(record.elementType)] if isinstance(record, T.ArrayType) else record.simpleString()


def test_only_new_days_are_read(spark, store, monkeypatch):
    first = frame(spark, (DAYS[0], {"id": 1}), (DAYS[1], {"id": 2, "x": "a"}))
    assert shapes.refresh(store, "shotmap", first, ["shotmap"]) == 2
    guarded = first.withColumn("body", F.raise_error("read again").cast("string"))
    more = guarded.unionByName(frame(spark, (DAYS[2], {"id": 2.5})))
    assert shapes.refresh(store, "shotmap", more, ["shotmap"]) == 1
    assert shapes.inferred(store, "shotmap").simpleString() == "struct<id:double,x:string>"
    assert shapes.inferred(store, "shotmap", DAYS[0], DAYS[0]).simpleString() == "struct<id:bigint>"
    # A day that has landed anew is sketched anew.
    again = frame(spark, (DAYS[2], {"id": 7}))
    assert shapes.refresh(store, "shotmap", again, ["shotmap"], days=[DAYS[2]]) == 1
    assert shapes.inferred(store, "shotmap").simpleString() == "struct<id:bigint,x:string>"


def test_drift(spark, store):
    rows = frame(
        spark,
        (DAYS[0], {"id": 1, "p": {"a": 1, "b": "x"}}),
        (DAYS[1], '{"shotmap": []}'),
        (DAYS[2], {"id": 2, "p": {"a": 1}, "new": True}),
        (DAYS[3], {"id": "2", "p": {"a": 1}, "new": True}),
    )
    shapes.refresh(store, "shotmap", rows, ["shotmap"])
    found = sorted(map(tuple, shapes.drift(store, "shotmap").collect()), key=repr)
    assert found == [
        (DAYS[2], "new", "came", "boolean", None),
        (DAYS[2], "p.b", "went", None, "string"),
        (DAYS[3], "id", "changed", "string", "number"),
    ]
    assert shapes.drift(store, "shotmap", DAYS[2], DAYS[3]).count() == 1
    assert shapes.drift(store, "shotmap", DAYS[0], DAYS[1]).count() == 0


def test_nothing_to_tell(spark, store):
    rows = frame(spark, (DAYS[0], "{"), (DAYS[1], '{"shotmap": [5, null]}')).unionByName(
        spark.createDataFrame([("shotmap", "k", 404, "{}", DAYS[2])], REPLIES)
    )
    assert shapes.refresh(store, "shotmap", rows, ["shotmap"]) == 3
    assert shapes.inferred(store, "shotmap") == T.StructType([])
    assert shapes.drift(store, "shotmap").count() == 0
    assert shapes.refresh(store, "shotmap", rows, ["shotmap"]) == 0
    assert shapes.refresh(store, "none", rows.limit(0), ["shotmap"]) == 0
    assert shapes.inferred(store, "none") == T.StructType([])

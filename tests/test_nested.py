"""Flattening and column helpers."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.functions.bodies import infer_record, items
from kickflow.functions.dates import week_start
from kickflow.functions.nested import (
    arrays_to_json,
    expand,
    fill_text_nulls,
    flatten,
    project_like,
    underscore_names,
)
from kickflow.sinks.tables import create_like, table_name


def test_flatten_names(spark):
    shape = "id INT, a STRUCT<b: INT, c: STRUCT<d: STRING>>, l ARRAY<INT>, `x.y` INT"
    df = spark.createDataFrame([(1, (2, ("x",)), [1, 2], 3), (4, None, None, None)], shape)
    flat = flatten(df)
    assert flat.columns == ["id", "a_b", "a_c_d", "l", "x_y"]
    assert [tuple(row) for row in flat.collect()] == [
        (1, 2, "x", [1, 2], 3),
        (4, None, None, None, None),
    ]


@pytest.mark.parametrize(
    "shape", ["a STRUCT<b: INT>, a_b INT", "`a.b` INT, a_b INT", "s STRUCT<id: INT, ID: INT>"]
)
def test_flatten_collisions(spark, shape):
    with pytest.raises(ValueError, match="both give column"):
        flatten(spark.createDataFrame([], T.StructType.fromDDL(shape)))


def test_random_records_flatten_like_pandas(spark):
    """Against pandas, without its columns for null parents and its int-to-float."""
    dice = random.Random(3)

    def one(depth=0):
        record = {"n": dice.choice([None, 5, 7]), "l": [dice.randint(0, 9)], "t.t": "x"}
        if depth < 3:
            for name in "op":
                record[name] = dice.choice([None, one(depth + 1), one(depth + 1)])
        return {name: value for name, value in record.items() if dice.random() < 0.8}

    for _ in range(6):
        records = [one() for _ in range(8)]
        frame = spark.createDataFrame([(json.dumps({"r": records}),)], "body STRING")
        variants = frame.select(F.explode(F.from_json("body", "r ARRAY<VARIANT>").r).alias("v"))
        shape = infer_record(variants, "v")
        rows = frame.select(F.explode(items(F.col("body"), ["r"], shape)).alias("v"))
        got = expand(rows, "v", keep=[])
        wanted = pd.json_normalize(records)
        wanted.columns = [name.replace(".", "_") for name in wanted.columns]
        # A parent is a column in pandas wherever it is null, in ours where it is never an object.
        parents = {name for name in wanted.columns if name[-1] in "op"}
        never = [name for name in got.columns if name[-1] in "op"]
        assert all(row[name] is None for row in got.collect() for name in never)
        assert set(got.columns) - set(never) == set(wanted.columns) - parents
        got = got.drop(*never)
        for mine, theirs in zip(got.collect(), wanted.to_dict("records"), strict=True):
            for name in got.columns:
                value = theirs[name]
                assert mine[name] == (None if value is None or value != value else value)


def test_underscore_names(spark):
    assert underscore_names(spark.createDataFrame([], "`a.b` INT, c INT")).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        underscore_names(spark.createDataFrame([], "`a.b` INT, a_b INT"))


def test_null_text(spark):
    df = spark.createDataFrame([(None, None, None)], "s STRING, i INT, b BOOLEAN")
    assert tuple(fill_text_nulls(df).first()) == ("null", None, None)


def test_arrays_to_json(spark):
    df = spark.createDataFrame([([1, 2], "x")], "l ARRAY<INT>, s STRING")
    assert tuple(arrays_to_json(df).first()) == ("[1,2]", "x")


def test_project_like(spark, database):
    target = table_name(database, "T")
    assert target == f"{database.lower()}.t"
    create_like(spark.createDataFrame([], "a INT, b STRING, ds STRING"), target)
    df = spark.createDataFrame([("d", 1.5, "x", 1)], "ds STRING, more DOUBLE, b STRING, a INT")
    assert project_like(df, target, extra="drop").columns == ["a", "b", "ds"]
    with pytest.raises(ValueError, match="no column for more"):
        project_like(df, target)
    row = project_like(df.drop("b", "more"), target).first()
    assert (row.a, row.b, row.ds) == (1, None, "d")


@pytest.mark.parametrize("ds", ["2023-07-31", "2023-08-02", "2023-08-06"])
def test_week_start(spark, ds):
    start = spark.range(1).select(
        F.date_format(week_start(F.lit(ds)), "yyyy-MM-dd HH:mm:ss").alias("s")
    )
    assert start.first().s == "2023-07-30 17:00:00"

"""Shapes of the reply table and of the records whose fields are fixed."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, FLAG = T.StringType(), T.BooleanType()
INT, LONG, REAL = T.IntegerType(), T.LongType(), T.DoubleType()

# How much of a day's name gives the folder of its rows.
UNITS = {"day": 10, "month": 7, "year": 4}


def struct_of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


REPLIES = struct_of(endpoint=TEXT, key=TEXT, status_code=INT, body=TEXT, ds=TEXT)
# Replies in a landing folder also have when they were written there, in microseconds.
LANDED = struct_of(**{f.name: f.dataType for f in REPLIES}, landed=LONG)

# Members and fields the feed names, in the feed's order.
STATISTIC_ITEM = struct_of(
    name=TEXT,
    home=TEXT,
    away=TEXT,
    compareCode=INT,
    statisticsType=TEXT,
    valueType=TEXT,
    homeValue=REAL,
    awayValue=REAL,
    renderType=INT,
    key=TEXT,
)
LINEUP_ENTRY = struct_of(shirtNumber=LONG, jerseyNumber=TEXT, position=TEXT, substitute=FLAG)
BEST_PLAYER = struct_of(
    value=TEXT,
    label=TEXT,
    player=struct_of(
        name=TEXT,
        slug=TEXT,
        shortName=TEXT,
        position=TEXT,
        jerseyNumber=TEXT,
        userCount=LONG,
        id=LONG,
        marketValueCurrency=TEXT,
        dateOfBirthTimestamp=LONG,
        fieldTranslations=struct_of(
            nameTranslation=struct_of(ar=TEXT), shortNameTranslation=struct_of(ar=TEXT)
        ),
    ),
)
MATCH_ENDPOINTS = (
    "shotmap",
    "match_event",
    "match_incident",
    "match_lineups",
    "match_manager",
    "match_statistics",
    "match_summary",
)


def ddl(shape: T.StructType) -> str:
    return f"STRUCT<{shape.toDDL()}>"

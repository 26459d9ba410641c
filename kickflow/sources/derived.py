"""Replies derived from the order tables, in the shape in which the feed sends them.

An order is a match, its line items are the detail records, its customer is the
custom id. Order status gives the outcome of the request: F is answered with 200,
O with 404 (and a body that has to be ignored), P fails. The body of an order
below ``TRUNCATED_BELOW`` has lost its last character. An order without line
items gets an empty array, a null member or no member, by its priority.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.schemas import FLAG, INT, LONG, REAL, TEXT, struct_of
from kickflow.session import stored

# A reply holds about this many records; a key with more is answered in several.
PAGE_RECORDS = 5000

TRUNCATED_BELOW = 20_000.0
# Days whose match list is not found, is damaged, or whose request fails; and their weeks.
CLOSED = ("1998-01-01", "1997-12-29")
TRUNCATED = ("1999-12-01", "1999-11-29")
FAILED = ("2000-02-01", "2000-01-31")
CUSTOMER_DS = "2001-08-02"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(rows: DataFrame) -> DataFrame:
    """A table, with its ``_metadata``, with ``source_row`` in its place.

    It is the same in every attempt to read a row.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return rows.withColumn("source_row", place).drop("_metadata")


def day(column: str = "o_orderdate") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def week(column: str = "o_orderdate") -> Column:
    """The Monday of a week, for a feed that is crawled once a week."""
    return F.date_format(F.date_trunc("week", column), "yyyy-MM-dd")


def month(column: str = "o_orderdate") -> Column:
    return F.date_format(F.trunc(column, "MM"), "yyyy-MM-dd")


def hot_keys(rows: DataFrame, key: str, *facts: Column) -> DataFrame:
    """Keys with more rows than one reply holds: their number of replies, and facts of all rows.

    Stored, so that Spark knows how many there are: it sends few to the rows, and otherwise
    deals out both.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    pages = F.ceil(F.col("n") / PAGE_RECORDS).alias("pages")
    hot, _ = stored(counts.where(F.col("n") > PAGE_RECORDS).select(key, pages), "hot-keys")
    if not facts:
        return hot
    # Only the rows of hot keys are looked at again: all of them would be sorted for the facts.
    found = rows.join(hot.select(key), key, "left_semi").groupBy(key).agg(*facts)
    return stored(hot.join(found, key, "left"), "hot-keys")[0]


def dealt(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Rows with a ``page``; those of a hot key go to pages by their place in the file."""
    return (
        numbered(rows)
        .join(hot.select(key, "pages"), key, "left")
        .withColumn("page", F.pmod("source_row", F.coalesce("pages", F.lit(1))))
        .drop("pages", "source_row")
    )


def collected(rows: DataFrame, key: str, record: Column) -> DataFrame:
    """Arrays of records per key and page.

    Rows are shuffled as they are: collecting them before as well would not make
    them any smaller, and would sort them once more.
    """
    together = rows.repartition(key, "page").groupBy(key, "page")
    return together.agg(F.collect_list(record).alias("records"))


def with_records(
    parents: DataFrame,
    key: str,
    children: DataFrame,
    child_key: str,
    record: Column,
    *facts: Column,
) -> DataFrame:
    """Each parent with its child rows as an array ``records``, in pages from 0 on.

    A parent without children has NULL records. Children are shuffled once, by key
    and page, so the rows of a hot parent go to many tasks. The parents follow them:
    one row for each page. That join stays a shuffle, as arrays are larger than they
    are estimated to be. ``facts`` are aggregates of all children of a parent of several
    pages (``pages`` is not NULL), where one page alone could not tell.
    """
    hot = hot_keys(children, child_key, *facts)
    filled = collected(dealt(children, child_key, hot), child_key, record)
    filled = filled.withColumnRenamed(child_key, key)
    slots = parents.join(hot.withColumnRenamed(child_key, key), key, "left").withColumn(
        "page", F.explode(F.sequence(F.lit(0), F.coalesce("pages", F.lit(1)) - 1))
    )
    joined = slots.join(filled.hint("merge"), [key, "page"], "left")
    wanted = F.col("records").isNotNull() | F.col("pages").isNull() | (F.col("page") == 0)
    return joined.where(wanted)


def truncated(body: Column) -> Column:
    return F.substring(body, F.lit(1), F.length(body) - 1)


def without_records(name: str) -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority.isin("1-URGENT", "2-HIGH"), f'{{"{name}":[]}}')
        .when(priority == "3-MEDIUM", f'{{"{name}":null}}')
        .otherwise("{}")
    )


def outcome(endpoint: str | Column, key: str, whole: Column, ds: Column | str) -> list[Column]:
    """Columns of the reply of an order whose undamaged body is ``whole``."""
    status = F.when(F.col("o_orderstatus") == "F", 200).when(F.col("o_orderstatus") == "O", 404)
    body = F.when(F.col("o_totalprice") < TRUNCATED_BELOW, truncated(whole)).otherwise(whole)
    return [
        (F.lit(endpoint) if isinstance(endpoint, str) else endpoint).alias("endpoint"),
        F.col(key).cast("string").alias("key"),
        status.alias("status_code"),
        F.when(status.isNotNull(), body).alias("body"),
        (F.col(ds) if isinstance(ds, str) else ds).alias("ds"),
    ]


# What a line item's reply needs of it; the shapes below are made of the collected lines.
LINE = (
    "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag"
    " l_linestatus l_shipdate"
).split()

# Of all lines of an order in several pages: whether the away team has any, and the first
# player without statistics.
RANK = ("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_returnflag", "l_tax")


def _rank(line: Column) -> Column:
    return F.struct(*[line[name].alias(name) for name in RANK])


def _damaged(line: Column) -> Column:
    return (line["l_returnflag"] == "R") & (line["l_linenumber"] >= 4)


def _facts() -> list[Column]:
    own = F.struct(*[F.col(name).alias(name) for name in LINE])
    first = F.when(_damaged(own) & (own["l_linestatus"] == "F"), _rank(own))
    return [
        F.max(F.col("l_linestatus") == "O").alias("has_away"),
        F.min(first).alias("first_damaged"),
    ]


def line_replies(
    spark: SparkSession, sf_dir: str, endpoints: Sequence[str], ds: Column | None = None, **options
) -> DataFrame:
    """Replies of several endpoints per order (and page), made of one pass over its line items.

    ``options`` are those of the shapes: ``damaged`` and ``ends`` of line-ups, ``complete`` of
    statistics.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        (day() if ds is None else ds).alias("ds"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE, "_metadata")
    record = F.struct(*LINE)
    answered = with_records(orders, "o_orderkey", lines, "l_orderkey", record, *_facts())
    # An order without lines has no records, one whose first page is empty has none on it.
    none = F.col("records").isNull() & F.col("pages").isNull()
    records = F.coalesce("records", F.array().cast(answered.schema["records"].dataType))

    def whole(name: str) -> Column:
        body, empty = SHAPES[name](records, **options)
        return F.when(none, empty).otherwise(F.to_json(body))

    each = F.array(
        *[F.struct(F.lit(name).alias("endpoint"), whole(name).alias("whole")) for name in endpoints]
    )
    rows = answered.select("*", F.explode(each).alias("reply"))
    return rows.select(*outcome(F.col("reply.endpoint"), "o_orderkey", F.col("reply.whole"), "ds"))


Shape = tuple[Column, Column]


def _shots(lines: Column, **_) -> Shape:
    def shot(r: Column) -> Column:
        return F.struct(
            r["l_linenumber"].alias("id"),
            r["l_discount"].alias("xg"),
            F.struct(r["l_partkey"].alias("id"), r["l_returnflag"].alias("flag")).alias("player"),
        )

    return F.struct(F.transform(lines, shot).alias("shotmap")), without_records("shotmap")


# The second to fifth shot of each match, and what has become of their values.
DRIFTS = (
    (r'("id":2,"xg":)([^,]*)', r'$1"$2"'),
    (r'("id":3,"xg":[^,]*,"player":)\{"id":(\d+),"flag":"\w"\}', r'$1"player $2"'),
    (r'"id":4,("xg":)', r'"id":4.5,$1'),
    (r'("id":5,"xg":[^,]*,"player":\{"id":)(\d+)', r'$1[$2]'),
)


def drifted(shots: DataFrame) -> DataFrame:
    """Replies of the shots whose values are of other types than before."""
    body = reduce(lambda b, drift: F.regexp_replace(b, *drift), DRIFTS, F.col("body"))
    return shots.withColumn("body", body)


def evolving(shots: DataFrame) -> DataFrame:
    """Replies of the shots of a feed that changes: no flag in 1997 and 1998, text for xg from 1999 on."""
    body, ds = F.col("body"), F.col("ds")
    without = F.regexp_replace(body, r',"flag":"\w"', "")
    text = F.regexp_replace(body, r'"xg":([^,]*)', r'"xg":"$1"')
    body = F.when(ds >= "1999", text).when(ds >= "1997", without).otherwise(body)
    return shots.withColumn("body", body)


def _incidents(lines: Column, **_) -> Shape:
    """Records of three kinds, each with fields the others lack."""

    def incident(r: Column) -> Column:
        flag = r["l_returnflag"]
        team = F.struct(r["l_linestatus"].alias("code")).alias("team")
        return F.struct(
            r["l_linenumber"].alias("id"),
            flag.alias("incidentType"),
            F.when(flag == "A", r["l_quantity"].cast("bigint")).alias("time"),
            F.when(flag == "A", F.struct(r["l_partkey"].alias("id"), team)).alias("player"),
            F.when(flag == "R", F.concat(F.lit("reason "), r["l_suppkey"])).alias("reason"),
            F.when(flag == "N", r["l_linestatus"] == "O").alias("isLive"),
        )

    return F.struct(F.transform(lines, incident).alias("incidents")), without_records("incidents")


def _lineups(lines: Column, damaged: bool = False, ends: bool = False, **_) -> Shape:
    """Players whose statistics overwrite ``rating``: with a value, with null, or not.

    ``damaged`` gives the players in a fixed order and leaves some without statistics. With
    ``ends`` an answer in several pages ends at the first of these: it is the last player of
    the first page, and no page has one that comes later.
    """

    def statistics(r: Column) -> Column:
        flag, minutes = r["l_returnflag"], r["l_quantity"]
        pairs = [F.lit("minutes"), minutes, F.lit("rating")]
        found = (
            F.when(flag == "A", F.create_map(*pairs, r["l_discount"]))
            .when(flag == "R", F.create_map(*pairs, F.lit(None).cast("double")))
            .otherwise(F.create_map(F.lit("minutes"), minutes))
        )
        return F.when(~_damaged(r), found) if damaged else found

    def entry(r: Column) -> Column:
        flag = r["l_returnflag"]
        return F.struct(
            r["l_linenumber"].alias("shirtNumber"),
            F.struct(
                r["l_partkey"].alias("id"),
                r["l_tax"].alias("rating"),
                flag.alias("position"),
                F.struct(r["l_suppkey"].alias("id")).alias("country"),
            ).alias("player"),
            r["l_suppkey"].cast("string").alias("jerseyNumber"),
            F.concat(F.lit("p"), flag).alias("position"),
            (r["l_linenumber"] > 4).alias("substitute"),
            statistics(r).alias("statistics"),
        )

    def ordered(lines: Column) -> Column:
        by_rank = F.transform(lines, lambda r: F.struct(_rank(r).alias("rank"), r.alias("line")))
        return F.transform(F.array_sort(by_rank), lambda x: x["line"])

    def team(status: str) -> Column:
        own = F.filter(lines, lambda r: r["l_linestatus"] == status)
        own = ordered(own) if damaged else own
        entries = F.transform(own, entry)
        if ends and status == "F":
            first = F.col("first_damaged")
            before = F.transform(F.filter(own, lambda r: _rank(r) < first), entry)
            bad = F.when(F.col("page") == 0, F.array(F.lit(None).cast(LINEUP_PLAYER)))
            cut = F.concat(before, F.coalesce(bad, F.array().cast(T.ArrayType(LINEUP_PLAYER))))
            entries = F.when(F.col("pages").isNotNull() & first.isNotNull(), cut).otherwise(entries)
        return F.struct(entries.alias("players"))

    empty = (
        F.when(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
            '{"home":{"players":[]},"away":{"players":[]}}',
        )
        .when(F.col("o_orderpriority") == "3-MEDIUM", '{"home":null}')
        .otherwise("{}")
    )
    return F.struct(team("F").alias("home"), team("O").alias("away")), empty


LINEUP_PLAYER = struct_of(
    shirtNumber=INT,
    player=struct_of(id=LONG, rating=REAL, position=TEXT, country=struct_of(id=LONG)),
    jerseyNumber=TEXT,
    position=TEXT,
    substitute=FLAG,
    statistics=T.MapType(TEXT, REAL),
)


def _statistics(lines: Column, complete: bool = True, **_) -> Shape:
    """Line items nested in periods (line status) and groups (return flag).

    ``complete`` replies have the member even where there are no line items.
    """

    def item(r: Column) -> Column:
        return F.struct(
            F.concat(F.lit("part "), r["l_partkey"]).alias("name"),
            r["l_quantity"].cast("int").cast("string").alias("home"),
            r["l_suppkey"].cast("string").alias("away"),
            F.when(r["l_tax"] > r["l_discount"], 1).otherwise(2).alias("compareCode"),
            F.lit("positive").alias("statisticsType"),
            F.lit("event").alias("valueType"),
            r["l_quantity"].alias("homeValue"),
            r["l_extendedprice"].alias("awayValue"),
            r["l_linenumber"].alias("renderType"),
            F.concat(F.lit("supplier "), r["l_suppkey"]).alias("key"),
        )

    def parts(lines: Column, field: str, made: Callable[[Column, Column], Column]) -> Column:
        values = F.array_distinct(F.transform(lines, lambda r: r[field]))
        return F.transform(values, lambda v: made(v, F.filter(lines, lambda r: r[field] == v)))

    def group(name: Column, own: Column) -> Column:
        return F.struct(name.alias("groupName"), F.transform(own, item).alias("statisticsItems"))

    def period(name: Column, own: Column) -> Column:
        return F.struct(name.alias("period"), parts(own, "l_returnflag", group).alias("groups"))

    body = F.struct(parts(lines, "l_linestatus", period).alias("statistics"))
    return body, F.lit('{"statistics":[]}') if complete else without_records("statistics")


def _summary(lines: Column, **_) -> Shape:
    """Best players of both teams; an order without lines of status O lacks the away member.

    In several pages, only the first lacks it.
    """

    def best(r: Column) -> Column:
        text = r["l_partkey"].cast("string")
        names = F.struct(
            F.struct(F.concat(F.lit("ar "), text).alias("ar")).alias("nameTranslation"),
            F.struct(F.concat(F.lit("a "), text).alias("ar")).alias("shortNameTranslation"),
        )
        player = F.struct(
            F.concat(F.lit("Player "), text).alias("name"),
            F.concat(F.lit("player-"), text).alias("slug"),
            F.concat(F.lit("P. "), text).alias("shortName"),
            r["l_returnflag"].alias("position"),
            r["l_linenumber"].cast("string").alias("jerseyNumber"),
            r["l_quantity"].cast("bigint").alias("userCount"),
            r["l_partkey"].alias("id"),
            F.lit("EUR").alias("marketValueCurrency"),
            F.unix_timestamp(r["l_shipdate"].cast("timestamp")).alias("dateOfBirthTimestamp"),
            F.when(r["l_returnflag"] != "N", names).alias("fieldTranslations"),
        )
        return F.struct(
            r["l_suppkey"].cast("string").alias("value"),
            r["l_returnflag"].alias("label"),
            player.alias("player"),
        )

    def team(status: str) -> Column:
        return F.transform(F.filter(lines, lambda r: r["l_linestatus"] == status), best)

    away = F.exists(lines, lambda r: r["l_linestatus"] == "O")
    in_pages = F.col("has_away") | (F.col("page") > 0)
    shown = F.when(F.col("pages").isNull(), away).otherwise(in_pages)
    body = F.struct(
        team("F").alias("bestHomeTeamPlayers"),
        F.when(shown, team("O")).alias("bestAwayTeamPlayers"),
    )
    empty = (
        F.when(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
            '{"bestHomeTeamPlayers":[],"bestAwayTeamPlayers":[]}',
        )
        .when(F.col("o_orderpriority") == "3-MEDIUM", '{"bestHomeTeamPlayers":null}')
        .otherwise("{}")
    )
    return body, empty


SHAPES: Mapping[str, Callable[..., Shape]] = {
    "shotmap": _shots,
    "match_incident": _incidents,
    "match_lineups": _lineups,
    "match_statistics": _statistics,
    "match_summary": _summary,
}


def manager_replies(spark: SparkSession, sf_dir: str, ds: Column | None = None) -> DataFrame:
    """One object per order; an order without a given priority has an empty one."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    orders = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    managers = F.struct(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.struct(F.col("n_name").alias("name")).alias("country"),
        ).alias("homeManager"),
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")).alias(
            "awayManager"
        ),
    )
    whole = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "{}").otherwise(
        F.to_json(managers)
    )
    return orders.select(
        *outcome("match_manager", "o_orderkey", whole, day() if ds is None else ds)
    )


def _customer_status() -> Column:
    """Customers in debt are not found, requests for the richest ones fail."""
    balance = F.col("c_acctbal")
    return F.when(balance < 0, 404).when(balance < 9000, 200)


def event_replies(spark: SparkSession, sf_dir: str, ds: Column | None = None) -> DataFrame:
    """One reply per customer (and page) with all of its orders as events.

    With ``ds``, a column of orders, one per customer and day with the orders of that day.
    """
    event = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("type")).alias("status"),
        F.struct(F.col("o_totalprice").alias("current")).alias("homeScore"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("startTimestamp"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, sf_dir, "orders").select("*", "_metadata")
    if ds is None:
        answered = with_records(customers, "c_custkey", orders, "o_custkey", event)
        answered = answered.withColumn("ds", F.lit(CUSTOMER_DS))
    else:
        dated = orders.withColumn("asked", F.struct("o_custkey", ds.alias("ds")))
        asked = dated.select("asked").distinct()
        asked = asked.join(customers, F.col("asked.o_custkey") == F.col("c_custkey"))
        answered = with_records(asked, "asked", dated, "asked", event)
        answered = answered.withColumn("ds", F.col("asked.ds"))
    events = F.coalesce(F.col("records"), F.array())
    status = _customer_status()
    return answered.select(
        F.lit("match_event").alias("endpoint"),
        F.col("c_custkey").cast("string").alias("key"),
        status.alias("status_code"),
        F.when(status.isNotNull(), F.to_json(F.struct(events.alias("events")))).alias("body"),
        "ds",
    )


def matchday_replies(spark: SparkSession, sf_dir: str, ds: Column | None = None) -> DataFrame:
    """One reply per day (and page); the market segment BUILDING plays football."""
    segment = F.col("c_mktsegment")
    event = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("customId"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("startTimestamp"),
        F.struct(F.col("o_orderstatus").alias("type")).alias("status"),
        F.struct(
            F.col("o_orderpriority").alias("name"),
            F.struct(
                F.struct(
                    F.when(segment == "BUILDING", "Football").otherwise(segment).alias("name")
                ).alias("sport")
            ).alias("category"),
        ).alias("tournament"),
    )
    ds = day() if ds is None else ds
    orders = table(spark, sf_dir, "orders").select("*", "_metadata").withColumn("ds", ds)
    customers = table(spark, sf_dir, "customer")
    played = dealt(orders, "ds", hot_keys(orders, "ds")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    listed = collected(played, "ds", event).withColumn(
        "whole", F.to_json(F.struct(F.col("records").alias("events")))
    )
    status = F.when(F.col("ds").isin(*CLOSED), 404).when(~F.col("ds").isin(*FAILED), 200)
    body = F.when(F.col("ds").isin(*TRUNCATED), truncated(F.col("whole")))
    return listed.select(
        F.lit("matchday").alias("endpoint"),
        F.col("ds").alias("key"),
        status.alias("status_code"),
        F.when(status.isNotNull(), body.otherwise(F.col("whole"))).alias("body"),
        "ds",
    )


def all_replies(spark: SparkSession, sf_dir: str, ds: Column | None = None) -> DataFrame:
    """Replies of all endpoints; ``ds``, a column of orders, is the day of the crawl."""
    ds = week() if ds is None else ds
    parts = [
        matchday_replies(spark, sf_dir, ds),
        line_replies(spark, sf_dir, list(SHAPES), ds, complete=False),
        event_replies(spark, sf_dir, ds),
        manager_replies(spark, sf_dir, ds),
    ]
    return reduce(DataFrame.unionByName, parts)

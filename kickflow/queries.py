"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kickflow.functions.bodies import member
from kickflow.functions.dates import week_start
from kickflow.functions.nested import fill_text_nulls
from kickflow.operators import endpoints
from kickflow.plans import daily, shapes
from kickflow.plans.daily import run_days
from kickflow.plans.job import JobConfig, run_job, table_export
from kickflow.plans.retention import expire, expired_days
from kickflow.schemas import FLAG, INT, LONG, REAL, REPLIES, TEXT, struct_of
from kickflow.session import configure, shared_folder, stored
from kickflow.sinks.store import Store
from kickflow.sinks.tables import (
    append,
    create_database,
    create_like,
    replace_day,
    replace_days,
    table_name,
)
from kickflow.sources import derived
from kickflow.sources.files import read_files
from kickflow.sources.replies import (
    bucket_keys,
    for_keys,
    hot_replies,
    land,
    land_bucketed,
    lookup,
    of_endpoint,
    read_replies,
)
from kickflow.streaming.incremental import latest, take_in

# Of bucketed reply tables; a cluster takes some times its cores.
BUCKETS = 16

MATCH = struct_of(
    id=LONG,
    customId=TEXT,
    startTimestamp=LONG,
    status=struct_of(type=TEXT),
    tournament=struct_of(name=TEXT, category=struct_of(sport=struct_of(name=TEXT))),
)
SHOT = struct_of(id=INT, xg=REAL, player=struct_of(id=LONG, flag=TEXT))
EVENT = struct_of(
    id=LONG, status=struct_of(type=TEXT), homeScore=struct_of(current=REAL), startTimestamp=LONG
)
INCIDENT = struct_of(
    id=INT,
    incidentType=TEXT,
    time=LONG,
    player=struct_of(id=LONG, team=struct_of(code=TEXT)),
    reason=TEXT,
    isLive=FLAG,
)
PLAYER = struct_of(id=LONG, rating=REAL, position=TEXT, country=struct_of(id=LONG))
PLAYER_STATISTICS = struct_of(minutes=REAL, rating=REAL)
MANAGERS = struct_of(
    homeManager=struct_of(id=LONG, name=TEXT, country=struct_of(name=TEXT)),
    awayManager=struct_of(id=LONG, name=TEXT),
)
LINEUPS = {"player": PLAYER, "statistics": PLAYER_STATISTICS}
RUN_OPTIONS: Mapping[str, Mapping] = {
    "matchday": {"record": MATCH},
    "shotmap": {"record": SHOT},
    "match_event": {"record": EVENT},
    "match_incident": {"record": INCIDENT},
    "match_lineups": LINEUPS,
    "match_manager": {"record": MANAGERS},
}


def _database(spark: SparkSession, purpose: str) -> str:
    """A new database in the shared folder."""
    name = f"{purpose}_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, shared_folder(spark, purpose))
    return name


def matchday_football(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.matchday(derived.matchday_replies(configure(spark), sf_dir), MATCH)


def matchday_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = derived.matchday_replies(configure(spark), sf_dir)
    return endpoints.matchday_audit(replies).distinct()


def shotmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.shotmap(derived.line_replies(configure(spark), sf_dir, ["shotmap"]), SHOT)


def shotmap_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shape is that of stored sketches, made of the replies day by day."""
    replies, _ = stored(derived.line_replies(configure(spark), sf_dir, ["shotmap"]), "replies")
    store = Store(spark, shared_folder(spark, "shapes"), "year")
    shapes.refresh(store, "shotmap", replies, ["shotmap"])
    return endpoints.shotmap(replies, shapes.inferred(store, "shotmap"))


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots lose a field in 1997, and one has another type in 1999: on which day, from sketches made in two steps."""
    replies, _ = stored(derived.evolving(derived.line_replies(configure(spark), sf_dir, ["shotmap"])), "replies")
    store = Store(spark, shared_folder(spark, "shapes"), "year")
    for part in (replies.where(F.col("ds") < "1998-06-01"), replies):
        shapes.refresh(store, "shotmap", part, ["shotmap"])
    return shapes.drift(store, "shotmap")


def shotmap_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of more than two shots or so are cut between them, and parsed apart."""
    replies = derived.line_replies(configure(spark), sf_dir, ["shotmap"])
    return endpoints.shotmap(replies, SHOT, split=150)


def value_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots whose values have changed their types: what the columns lose is kept by path."""
    replies = derived.drifted(derived.line_replies(configure(spark), sf_dir, ["shotmap"]))
    found = endpoints.shotmap(replies, SHOT, rescue="rescued")
    return found.withColumn("rescued", F.to_json("rescued"))


def failures_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that all have failed, so that no record tells any column."""
    replies = derived.line_replies(configure(spark), sf_dir, ["shotmap"])
    failed = replies.where("status_code IS NULL OR status_code <> 200")
    return endpoints.shotmap(failed)


def match_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.match_event(derived.event_replies(configure(spark), sf_dir), EVENT)


def match_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.match_incident(derived.line_replies(configure(spark), sf_dir, ["match_incident"]), INCIDENT)


def match_lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.match_lineups(derived.line_replies(configure(spark), sf_dir, ["match_lineups"]), **LINEUPS)


def match_lineups_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = derived.line_replies(configure(spark), sf_dir, ["match_lineups"])
    return endpoints.match_lineups(replies, sides=("home", "away"), **LINEUPS)


def match_lineups_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = derived.line_replies(
        configure(spark), sf_dir, ["match_lineups"], damaged=True, ends=True
    )
    return endpoints.match_lineups(replies, **LINEUPS)


def match_lineups_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = derived.line_replies(configure(spark), sf_dir, ["match_lineups"], damaged=True)
    return endpoints.match_lineups(replies, on_bad="skip", **LINEUPS)


def match_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.match_manager(derived.manager_replies(configure(spark), sf_dir), MANAGERS)


def match_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.match_statistics(derived.line_replies(configure(spark), sf_dir, ["match_statistics"]))


def match_statistics_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = derived.line_replies(configure(spark), sf_dir, ["match_statistics"], complete=False)
    return endpoints.match_statistics(replies, strict=False)


def match_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return endpoints.match_summary(derived.line_replies(configure(spark), sf_dir, ["match_summary"]))


def _listed_and_landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Keys of the day's football matches, and shot replies; those of failed requests never landed."""
    matches = endpoints.matchday(derived.matchday_replies(configure(spark), sf_dir), MATCH)
    replies, _ = stored(derived.line_replies(spark, sf_dir, ["shotmap"]).where("status_code IS NOT NULL"), "replies")
    return matches.select(F.col("match_id").alias("key"), "ds"), replies


def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots of listed matches, from replies in a folder."""
    keys, replies = _listed_and_landed(spark, sf_dir)
    keys, _ = stored(keys, "keys")
    return endpoints.shotmap(for_keys(of_endpoint(replies, "shotmap"), keys), SHOT)


def keyed_lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table that holds replies and keys in the same buckets: nothing moves."""
    keys, replies = _listed_and_landed(spark, sf_dir)
    database = _database(spark, "buckets")
    raw, wanted = table_name(database, "raw"), table_name(database, "wanted")
    land_bucketed(replies, raw, BUCKETS, hot_replies(replies), unit="year")
    bucket_keys(keys, wanted, "shotmap", raw, BUCKETS)
    return endpoints.shotmap(lookup(spark, wanted, raw, "shotmap", unit="year"), SHOT)


def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shotmap(spark, sf_dir).where(F.col("status_code") == 404)


def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_text_nulls(shotmap(spark, sf_dir))


def week_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = derived.day()
    start = F.date_format(week_start(ds), "yyyy-MM-dd HH:mm:ss")
    orders = derived.table(configure(spark), sf_dir, "orders")
    return orders.select("o_orderkey", ds.alias("ds"), start.alias("week_start"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derived.table(configure(spark), sf_dir, "events")
    return events.select("event_id", member(F.col("props"), ["k"], LONG).alias("k"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", derived.month().alias("ds")
    )


def project_like_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order and one too many, written by position."""
    target = table_name(_database(configure(spark), "Projected").upper(), "Orders")
    orders = _orders(spark, sf_dir)
    create_like(orders.select("o_orderpriority", "o_totalprice", "o_orderkey", "ds"), target)
    append(orders.withColumn("extra", F.col("o_orderkey")), target, extra="drop")
    return spark.table(target)


def append_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three periods: the second lacks a column, the third has two that the table lacks."""
    target = table_name(_database(configure(spark), "drifting"), "orders")
    orders = derived.table(spark, sf_dir, "orders").withColumn("ds", derived.month())
    first, second = F.col("ds") < "1997-01-01", F.col("ds") < "1999-01-01"
    more = {"residue": "more"}
    append(orders.where(first).select("o_orderkey", "o_totalprice", "ds"), target, **more)
    append(orders.where(~first & second).select("ds", "o_orderkey"), target, **more)
    new = ["o_custkey", "o_orderpriority"]
    append(orders.where(~second).select("o_orderkey", "o_totalprice", *new, "ds"), target, **more)
    return spark.table(target).withColumn("more", F.to_json("more"))


def append_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table_name(_database(configure(spark), "appended"), "orders")
    orders = _orders(spark, sf_dir).drop("ds")
    for _ in range(2):
        append(orders, target, ds="2001-08-02")
    return spark.table(target)


def replace_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months, then 1998 rewritten with urgent orders only, one month new, one emptied."""
    target = table_name(_database(configure(spark), "replaced"), "orders")
    orders = _orders(spark, sf_dir)
    append(orders, target)
    urgent = orders.where(F.col("ds").startswith("1998") & (F.col("o_orderpriority") == "1-URGENT"))
    months = [f"1998-{month:02}-01" for month in range(1, 13)]
    replace_days(urgent, target, months)
    march = orders.where(F.col("ds") == "1997-03-01")
    for _ in range(2):
        replace_day(march.withColumn("o_totalprice", F.lit(0.0)), target, "1997-03-01", num_out=2)
    replace_day(orders.where(F.lit(False)), target, "1997-04-01")
    return spark.table(target)


def column_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names of the flattened incidents, whose shape is read off all replies."""
    incidents = endpoints.match_incident(derived.line_replies(configure(spark), sf_dir, ["match_incident"]))
    return spark.createDataFrame([(name,) for name in incidents.columns], "column_name STRING")


def _landed(spark: SparkSession, sf_dir: str, ds: Column, **layout) -> DataFrame:
    folder = shared_folder(spark, "landing")
    land(derived.all_replies(spark, sf_dir, ds), folder, **layout)
    return read_replies(spark, folder)


# Per table, the id that its rows carry and a number of their content.
CONTENT = {
    "matchday": ("match_id", "startTimestamp"),
    "shotmap": ("match_id", "player_id"),
    "match_event": ("coalesce(customId, match_id)", "id"),
    "match_incident": ("match_id", "time"),
    "match_lineups": ("match_id", "shirtNumber"),
    "match_manager": ("match_id", "awayManager_id"),
    "match_statistics": ("match_id", "renderType"),
    "match_summary": ("match_id", "player_userCount"),
}


def _content(spark: SparkSession, source: str) -> DataFrame:
    """Rows, sum of ids and sum of content per table and day, as the tables hold them."""

    def of(name: str) -> DataFrame:
        id, value = CONTENT[name]
        return spark.table(table_name(source, name)).groupBy("ds").agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n"),
            F.expr(f"sum(cast({id} AS BIGINT))").alias("ids"),
            F.expr(f"sum(cast({value} AS BIGINT))").alias("total"),
        )

    return reduce(DataFrame.unionByName, [of(name) for name in CONTENT])


def run_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as the matches of a single day; rows and content per table."""
    ds = derived.CUSTOMER_DS
    replies = _landed(configure(spark), sf_dir, F.lit(ds), folder_per_day=False)
    source = _database(spark, "run")
    audit = daily.run_day(replies, source, ds, options=RUN_OPTIONS, write="append")
    held = _content(spark, source).drop("n")
    return audit.join(held, ["table_name", "ds"], "left").select(
        "table_name", "rows", "ids", "total"
    )


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days from the first order to the last in one run, twice: rows, content and reason per table and day.

    The second run puts every day in the place of itself, in all tables by one commit.
    """
    replies = _landed(configure(spark), sf_dir, derived.day(), folder_per_day=False)
    source = _database(spark, "backfill")
    orders = derived.table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min(derived.day()), F.max(derived.day())).first()
    for _ in range(2):
        audit = run_days(replies, source, first, last, RUN_OPTIONS, unit="year")
    held = _content(spark, source)
    return audit.join(held, ["table_name", "ds"], "left").select(
        "table_name", "ds", "rows", F.coalesce("n", F.lit(0)).alias("held"), "ids", "total", "reason"
    )


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders left after months more than 1000 days old are dropped."""
    target = table_name(_database(configure(spark), "retained"), "orders")
    append(_orders(spark, sf_dir), target)
    expire(spark, target, as_of="2001-08-02", max_age=1000, enable_delete=False)
    expire(spark, target, as_of="2001-08-02", max_age=1000)
    return spark.table(target)


def retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table_name(_database(configure(spark), "reported"), "orders")
    append(_orders(spark, sf_dir), target)
    return expired_days(spark, target, as_of="2001-08-02", max_age=1000)


def file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over JSON lines, and one without rows that is skipped."""
    folder = shared_folder(configure(spark), "lines")
    derived.line_replies(spark, sf_dir, ["shotmap"], derived.week()).write.json(folder)
    database = _database(spark, "jobs")
    config = JobConfig(database, "Shots", "2001-08-02", {"in_path": folder, "skip_empty": True})
    target = table_name(config.source_id, config.in_file)

    def read() -> DataFrame:
        return read_files(spark, config, REPLIES)

    def etl(df: DataFrame) -> DataFrame:
        return endpoints.shotmap(df, SHOT)

    export = table_export(config)
    run_job(config, read, etl, export)
    run_job(config, lambda: read().where(F.lit(False)), etl, export, no_rows_is_empty=True)
    return spark.table(target)


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings: the second corrects a third of the first one's replies, and adds new keys."""
    folder = shared_folder(configure(spark), "landing")
    checkpoint = shared_folder(spark, "progress")
    store = Store(spark, shared_folder(spark, "stream"), "year")
    replies, _ = stored(derived.line_replies(spark, sf_dir, ["shotmap"]), "replies")
    part = F.crc32("key") % 4
    wrong = {"status_code": F.lit(404), "body": F.lit("busy")}
    early = replies.where(part == 0).withColumns(wrong).unionByName(replies.where(part.isin(1, 2)))
    for landing in (early, replies.where(part.isin(0, 3))):
        land(landing, folder, folder_per_day=False)
        take_in(spark, folder, "shotmap", lambda df: endpoints.shotmap(df, SHOT), store, "shotmap", checkpoint)
    return latest(store, "shotmap")


QUERIES = {
    query.__name__: query
    for query in (
        matchday_football,
        matchday_audit,
        shotmap,
        shotmap_inferred,
        failures_inferred,
        drift_report,
        shotmap_split,
        value_rescue,
        match_event,
        match_incident,
        match_lineups,
        match_lineups_both,
        match_lineups_bad,
        match_lineups_skip,
        match_manager,
        match_statistics,
        match_statistics_lenient,
        match_summary,
        keyed_lookup,
        keyed_lookup_bucketed,
        status_filter,
        null_fill,
        week_starts,
        json_props,
        project_like_table,
        append_ds,
        append_drift,
        replace_ds,
        column_list,
        run_day,
        backfill,
        retention,
        retention_report,
        file_read,
        incremental,
    )
}

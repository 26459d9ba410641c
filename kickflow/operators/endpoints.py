"""The match list and the seven per-match endpoints.

Each takes replies ``key, ds, status_code, body`` of its endpoint and returns the
flat table with ``ds``. Where a record shape is not given it is inferred from the
replies, which costs one more pass over them. Where one is given, a value of another type is
NULL; ``rescue`` names a column for such values, as JSON text by their path. ``split`` has
larger bodies parsed in pieces of so many bytes, for replies that no single task should read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.functions.bodies import (
    has,
    has_object,
    infer_record,
    items,
    member,
    or_single,
    rescued,
    rescued_items,
    variant_path,
)
from kickflow.functions.nested import at, check_names, expand, flat_name, leaves
from kickflow.operators.large import rows_by_pieces
from kickflow.operators.rows import row_status, rows_or_error
from kickflow.schemas import BEST_PLAYER, LINEUP_ENTRY, STATISTIC_ITEM, TEXT, ddl, struct_of

VARIANTS = T.ArrayType(T.VariantType())


def infer(replies: DataFrame, path: Sequence[str]) -> T.StructType:
    """Record shape of the array at ``path`` over all good replies."""
    good = replies.where(F.col("status_code") == 200)
    found = good.select(F.explode(member(F.col("body"), path, VARIANTS)).alias("item"))
    return infer_record(found, "item")


def _records(path: Sequence[str], record: T.StructType, rescue: str | None) -> Column:
    """The records of a body; with ``rescue``, a field of that name holds what their shape loses."""
    if rescue is None:
        return items(F.col("body"), path, record)
    return rescued_items(F.col("body"), path, record, rescue)


def matchday(
    replies: DataFrame,
    record: T.StructType | None = None,
    sport: str = "Football",
    rescue: str | None = None,
) -> DataFrame:
    """Events of one sport; a failed or unreadable day gives no rows."""
    record = record or infer(replies, ["events"])
    events = replies.where(F.col("status_code") == 200).select(
        "ds", F.explode(_records(["events"], record, rescue)).alias("record")
    )
    flat = expand(events, "record", keep=["ds"]).withColumnRenamed("id", "match_id")
    missing = [name for name in ("match_id", "customId") if name not in flat.columns]
    flat = flat.withColumns({name: F.lit(None).cast("string") for name in missing})
    flat = flat.withColumn("match_id", F.col("match_id").cast("string"))
    if "tournament_category_sport_name" not in flat.columns:
        return flat.where(F.lit(False))
    return flat.where(F.col("tournament_category_sport_name") == sport)


def matchday_audit(replies: DataFrame) -> DataFrame:
    """Why a day has no match list; NULL reason where it has one."""
    status = F.col("status_code")
    events = member(F.col("body"), ["events"], VARIANTS)
    reason = (
        F.when(status.isNull(), "request failed")
        .when(status != 200, F.concat(F.lit("status "), status.cast("string")))
        .when(events.isNull(), "unreadable body")
    )
    return replies.select("ds", "status_code", reason.alias("reason"))


def _rows(
    replies: DataFrame, name: str, record: T.StructType, on_bad: str, rescue: str | None, split: int | None
) -> DataFrame:
    """Rows of the array ``name``; bodies of more than ``split`` bytes are parsed in pieces."""
    if split is None:
        return rows_or_error(replies, _records([name], record, rescue), on_bad)
    return rows_by_pieces(replies, name, lambda: _records([name], record, rescue), split, on_bad)


def _per_match(
    replies: DataFrame,
    name: str,
    record: T.StructType | None,
    on_bad: str,
    rescue: str | None,
    split: int | None,
) -> DataFrame:
    record = record or infer(replies, [name])
    rows = _rows(replies, name, record, on_bad, rescue, split)
    return expand(
        rows.withColumnRenamed("key", "match_id"),
        "record",
        keep=["match_id", "status_code", "ds"],
    )


def shotmap(
    replies: DataFrame,
    record: T.StructType | None = None,
    on_bad: str = "truncate",
    rescue: str | None = None,
    split: int | None = None,
) -> DataFrame:
    return _per_match(replies, "shotmap", record, on_bad, rescue, split)


def match_incident(
    replies: DataFrame,
    record: T.StructType | None = None,
    on_bad: str = "truncate",
    rescue: str | None = None,
    split: int | None = None,
) -> DataFrame:
    return _per_match(replies, "incidents", record, on_bad, rescue, split)


def match_event(
    replies: DataFrame,
    record: T.StructType | None = None,
    on_bad: str = "truncate",
    rescue: str | None = None,
    split: int | None = None,
) -> DataFrame:
    """Head-to-head events by custom id; an error row has that id in ``match_id``."""
    record = record or infer(replies, ["events"])
    rows = _rows(replies, "events", record, on_bad, rescue, split)
    found = F.col("record").isNotNull()
    match_id = F.when(~found, F.col("key"))
    if "match_id" in record.names:
        match_id = F.coalesce(match_id, F.col("record.match_id").cast("string"))
    rows = rows.withColumns(
        {"customId": F.when(found, F.col("key")), "match_id": match_id}
    )
    return expand(rows, "record", keep=["customId", "match_id", "status_code", "ds"])


def match_manager(
    replies: DataFrame, record: T.StructType | None = None, rescue: str | None = None
) -> DataFrame:
    """The whole object as one row."""
    if record is None:
        good = replies.where(F.col("status_code") == 200)
        record = infer_record(
            good.select(member(F.col("body"), [], T.VariantType()).alias("reply")), "reply"
        )
    reply = F.when(F.col("status_code") == 200, member(F.col("body"), [], record))
    rows = replies.withColumn("record", reply).withColumnRenamed("key", "match_id")
    rows = rows.withColumn("status_code", row_status(F.col("record")))
    if rescue is not None:
        whole = member(F.col("body"), [], T.VariantType())
        lost = F.when(F.col("record").isNotNull(), rescued(whole, F.col("record"), record))
        rows = rows.withColumn(rescue, lost)
    return expand(rows, "record", keep=[*[rescue] * (rescue is not None), "match_id", "status_code", "ds"])


def match_summary(
    replies: DataFrame, record: T.StructType = BEST_PLAYER, on_bad: str = "truncate"
) -> DataFrame:
    """Best players of both teams; both members are needed, home comes first."""
    teams = {"home": "bestHomeTeamPlayers", "away": "bestAwayTeamPlayers"}
    shape = T.StructType([T.StructField(name, T.ArrayType(record)) for name in teams.values()])
    parsed = replies.withColumn("players", member(F.col("body"), [], shape))

    def tagged(team: str, name: str) -> Column:
        return F.transform(
            or_single(F.col("players").getField(name), F.col("body"), [name], record),
            lambda p: F.when(p.isNotNull(), F.struct(p.alias("best"), F.lit(team).alias("team"))),
        )

    rows = rows_or_error(parsed, _home_then(*[tagged(*pair) for pair in teams.items()]), on_bad)
    rows = rows.select(
        F.col("key").alias("match_id"),
        "status_code",
        "ds",
        F.col("record.best").alias("best"),
        F.col("record.team").alias("team"),
    )
    return expand(rows, "best", keep=["team", "match_id", "status_code", "ds"])


def _home_then(first: Column, *others: Column) -> Column:
    """Arrays in order; a missing later array counts as a bad element at its place."""
    return reduce(
        lambda done, array: F.concat(done, F.coalesce(array, F.array(F.lit(None)))),
        others,
        first,
    )


def match_lineups(
    replies: DataFrame,
    player: T.StructType | None = None,
    statistics: T.StructType | None = None,
    sides: Sequence[str] = ("home",),
    on_bad: str = "truncate",
) -> DataFrame:
    """One row per player: player fields, overwritten by statistics, then line-up fields.

    More than one side adds ``team``.
    """
    body, good = F.col("body"), F.col("status_code") == 200
    if player is None or statistics is None:
        entries = F.flatten(
            F.array(*[F.coalesce(_entries(body, side), F.array()) for side in sides])
        )
        entries = replies.where(good).select(F.explode(entries).alias("entry"))
        parts = {
            name: F.variant_get("entry", variant_path(name), "variant")
            for name in ("player", "statistics")
        }
        player = player or infer_record(entries.select(parts["player"].alias("v")), "v")
        statistics = statistics or infer_record(
            entries.select(parts["statistics"].alias("v")), "v"
        )

    shared = [name for name in player.names if name in statistics.names]
    typed = [_typed_players(body, side, player, statistics, shared) for side in sides]
    single = [_single_players(body, side, player, statistics, shared) for side in sides]
    parsed = replies.withColumn("typed", F.when(good, F.concat(*typed)))
    complete = F.forall("typed", lambda p: p.isNotNull())
    found = F.when(complete, F.col("typed")).otherwise(_home_then(*single))
    rows = rows_or_error(parsed, found, on_bad)

    row = F.col("record")
    keep = ["match_id", "status_code", "ds"] + (["team"] if len(sides) > 1 else [])
    early = {flat_name(p): p for p in leaves(player) if p[0] not in LINEUP_ENTRY.names + keep}
    late = {flat_name(p): p for p in leaves(statistics) if p[0] not in LINEUP_ENTRY.names + keep}
    paths = {**early, **late}
    check_names([*paths.values(), *[(name,) for name in LINEUP_ENTRY.names + keep]])

    def merged(name: str) -> Column:
        value = at(row.player, early[name]) if name in early else F.lit(None)
        later = at(row.statistics, late[name]) if name in late else F.lit(None)
        top = paths[name][0]
        if top in shared:
            return F.when(row.shown[top], later).otherwise(value)
        return later if name in late else value

    return rows.select(
        *[merged(name).alias(name) for name in paths],
        *[row.place[name].alias(name) for name in LINEUP_ENTRY.names],
        F.col("key").alias("match_id"),
        "status_code",
        "ds",
        *([row.team.alias("team")] if len(sides) > 1 else []),
    )


def _entries(body: Column, side: str) -> Column:
    return member(body, [side, "players"], VARIANTS)


def _typed_players(
    body: Column, side: str, player: T.StructType, statistics: T.StructType, shared: list[str]
) -> Column:
    """Players of a side; one is NULL if its values do not say what overwrites what.

    That is so where a line-up field is NULL: it may be null, or absent, which is an
    error. The statistics are kept as a variant, which tells the two apart, so that a
    field that only some players have needs no second reading of the reply.
    """
    loose = T.StructType().add("statistics", T.VariantType())
    entry = T.StructType([*struct_of(player=player), *loose, *LINEUP_ENTRY])

    def row(e: Column) -> Column:
        clear = reduce(
            lambda ok, name: ok & e[name].isNotNull(),
            LINEUP_ENTRY.names,
            e.player.isNotNull() & F.try_variant_get(e.statistics, "$", "struct<>").isNotNull(),
        )
        place = F.struct(*[e[name].alias(name) for name in LINEUP_ENTRY.names])
        shown = {name: has(e.statistics, name) for name in shared}
        values = F.try_variant_get(e.statistics, "$", ddl(statistics))
        return F.when(clear, _player_row(e.player, values, place, shown, side))

    return F.transform(member(body, [side, "players"], T.ArrayType(entry)), row)


def _single_players(
    body: Column, side: str, player: T.StructType, statistics: T.StructType, shared: list[str]
) -> Column:
    """Players of a side, read one by one; one that lacks a member is NULL.

    A variant tells null from absent: a field of the statistics that is there with
    null overwrites the player's.
    """

    def row(e: Column) -> Column:
        well_formed = reduce(
            lambda ok, name: ok & has(e, name),
            LINEUP_ENTRY.names,
            has_object(e, "player") & has_object(e, "statistics"),
        )
        return F.when(
            well_formed,
            _player_row(
                F.try_variant_get(e, "$.player", ddl(player)),
                F.try_variant_get(e, "$.statistics", ddl(statistics)),
                F.try_variant_get(e, "$", ddl(LINEUP_ENTRY)),
                {name: has(e, "statistics", name) for name in shared},
                side,
            ),
        )

    return F.transform(_entries(body, side), row)


def _player_row(
    player: Column, statistics: Column, place: Column, shown: dict[str, Column], side: str
) -> Column:
    flags = [flag.alias(name) for name, flag in shown.items()]
    return F.struct(
        player.alias("player"),
        statistics.alias("statistics"),
        place.alias("place"),
        F.lit(side).alias("team"),
        *([F.struct(*flags).alias("shown")] if flags else []),
    )


def match_statistics(replies: DataFrame, strict: bool = True) -> DataFrame:
    """Statistic items of all periods and groups, 14 columns and ``ds``.

    A member that is missing fails the job when ``strict``; otherwise it counts as
    a bad element: rows before it stay and one error row follows.
    """
    good = F.col("status_code") == 200
    parsed = replies.withColumn("typed", F.when(good, _typed_items(F.col("body"))))
    complete = F.forall("typed", _has_all_values)
    found = F.when(complete, F.col("typed")).otherwise(_single_items(F.col("body")))
    if strict:
        parsed = parsed.withColumn("items", F.when(good, found))
        message = F.concat(F.lit("statistics of match "), F.col("key"), F.lit(" lack a member"))
        readable = member(F.col("body"), [], T.VariantType()).isNotNull()
        broken = F.exists("items", lambda e: e.isNull()) | (
            good & F.col("items").isNull() & readable
        )
        found = F.when(broken, F.raise_error(message)).otherwise(F.col("items"))
    rows = rows_or_error(parsed, found).withColumnRenamed("key", "match_id")
    record = F.col("record")
    return rows.select(
        record.period.alias("period"),
        record.groupName.alias("groupName"),
        *[record["item"][name].alias(name) for name in STATISTIC_ITEM.names],
        "status_code",
        "match_id",
        "ds",
    )


def _item_row(period: Column, group: Column, item: Column) -> Column:
    return F.struct(period.alias("period"), group.alias("groupName"), item.alias("item"))


def _typed_items(body: Column) -> Column:
    """All items of a reply in order; NULL if an array on the way is missing."""
    group = struct_of(groupName=TEXT, statisticsItems=T.ArrayType(STATISTIC_ITEM))
    period = struct_of(period=TEXT, groups=T.ArrayType(group))
    return F.flatten(
        F.transform(
            member(body, ["statistics"], T.ArrayType(period)),
            lambda p: F.flatten(
                F.transform(
                    p.groups,
                    lambda g: F.transform(
                        g.statisticsItems, lambda i: _item_row(p.period, g.groupName, i)
                    ),
                )
            ),
        )
    )


def _has_all_values(row: Column) -> Column:
    values = [row["item"][name] for name in STATISTIC_ITEM.names]
    return reduce(
        lambda ok, value: ok & value.isNotNull(), values, row.period.isNotNull() & row.groupName.isNotNull()
    )


def _single_items(body: Column) -> Column:
    """All items in order, read one by one; one that lacks a member is NULL.

    Needed where a value is NULL, as only a variant tells null from absent.
    """

    def array(value: Column, name: str) -> Column:
        return F.try_variant_get(value, variant_path(name), "array<variant>")

    def row(period: Column, group: Column, item: Column) -> Column:
        complete = reduce(
            lambda ok, name: ok & has(item, name),
            STATISTIC_ITEM.names,
            has(period, "period") & has(group, "groupName"),
        )
        text = "string"
        return F.when(
            complete,
            _item_row(
                F.try_variant_get(period, "$.period", text),
                F.try_variant_get(group, "$.groupName", text),
                F.try_variant_get(item, "$", ddl(STATISTIC_ITEM)),
            ),
        )

    def each(values: Column, rows_of: Callable[[Column], Column]) -> Column:
        bad = F.array(F.lit(None))
        return F.flatten(F.transform(values, lambda v: F.coalesce(rows_of(v), bad)))

    return each(
        member(body, ["statistics"], VARIANTS),
        lambda p: each(
            array(p, "groups"),
            lambda g: F.transform(array(g, "statisticsItems"), lambda i: row(p, g, i)),
        ),
    )

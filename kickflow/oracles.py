"""The same answers in plain SQL over the base tables, without any JSON."""

from __future__ import annotations

_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_WEEK = "strftime(date_trunc('week', o_orderdate), '%Y-%m-%d')"
_MONTH = "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')"


def _matches(ds: str = _DAY) -> str:
    """Orders as matches: ok where the reply is readable, n, home and away line counts."""
    return f"""
    m AS (
      SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS match_id, {ds} AS ds,
             o_orderpriority, o_custkey, o_orderstatus,
             o_orderstatus = 'F' AND o_totalprice >= 20000 AS ok,
             CAST(CASE WHEN o_orderstatus = 'O' THEN 404 END AS INTEGER) AS error_status,
             coalesce(n, 0) AS n, coalesce(home, 0) AS home, coalesce(away, 0) AS away,
             o_orderpriority IN ('1-URGENT', '2-HIGH') AS empty_array
      FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS n,
               count(*) FILTER (WHERE l_linestatus = 'F') AS home,
               count(*) FILTER (WHERE l_linestatus = 'O') AS away
        FROM lineitem GROUP BY l_orderkey
      ) ON o_orderkey = l_orderkey
    ),
    l AS (
      SELECT * FROM lineitem JOIN m ON l_orderkey = o_orderkey WHERE ok
    )"""


_ERROR = "NOT ok OR (n = 0 AND NOT empty_array)"
_OK_STATUS = "CAST(200 AS INTEGER) AS status_code"


def _shotmap(ds: str = _DAY, id_type: str = "INTEGER") -> str:
    return f"""
    WITH {_matches(ds)}
    SELECT CAST(l_linenumber AS {id_type}) AS id, l_discount AS xg, l_partkey AS player_id,
           l_returnflag AS player_flag, match_id, {_OK_STATUS}, ds
    FROM l
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, match_id, error_status, ds FROM m WHERE {_ERROR}
    """


def _lineups(where: str, errors: str, team: str = "") -> str:
    return f"""
    WITH {_matches()},
    p AS (
      SELECT *, l_returnflag = 'R' AND l_linenumber >= 4 AS bad,
             coalesce(max(CASE WHEN l_returnflag = 'R' AND l_linenumber >= 4 THEN 1 ELSE 0 END)
               OVER (PARTITION BY l_orderkey
                     ORDER BY l_linenumber, l_extendedprice, l_partkey, l_suppkey,
                              l_returnflag, l_tax
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS bad_so_far
      FROM l WHERE {where}
    )
    SELECT l_partkey AS id,
           CASE l_returnflag WHEN 'A' THEN l_discount WHEN 'N' THEN l_tax END AS rating,
           l_suppkey AS country_id, l_quantity AS minutes,
           CAST(l_linenumber AS BIGINT) AS "shirtNumber",
           CAST(l_suppkey AS VARCHAR) AS "jerseyNumber", 'p' || l_returnflag AS position,
           l_linenumber > 4 AS substitute, match_id, {_OK_STATUS}, ds
           {", CASE l_linestatus WHEN 'F' THEN 'home' ELSE 'away' END AS team" if team else ""}
    FROM p {errors.split("|")[0]}
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, match_id, error_status, ds
           {", NULL" if team else ""}
    FROM m WHERE {errors.split("|")[1]}
    """


_ITEM = """
           l_linestatus AS period, l_returnflag AS "groupName", 'part ' || l_partkey AS name,
           CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS home,
           CAST(l_suppkey AS VARCHAR) AS away,
           CAST(CASE WHEN l_tax > l_discount THEN 1 ELSE 2 END AS INTEGER) AS "compareCode",
           'positive' AS "statisticsType", 'event' AS "valueType",
           l_quantity AS "homeValue", l_extendedprice AS "awayValue",
           CAST(l_linenumber AS INTEGER) AS "renderType", 'supplier ' || l_suppkey AS key"""
_NO_ITEM = ", ".join(["NULL"] * 12)


def _statistics(errors: str) -> str:
    return f"""
    WITH {_matches()}
    SELECT {_ITEM}, {_OK_STATUS}, match_id, ds FROM l
    UNION ALL
    SELECT {_NO_ITEM}, error_status, match_id, ds FROM m WHERE {errors}
    """


_SEGMENT = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Football' ELSE c_mktsegment END"
_NO_LIST = (
    "('1998-01-01', '1999-12-01', '2000-02-01', '1997-12-29', '1999-11-29', '2000-01-31')"
)


def _football(ds: str = _DAY) -> str:
    return f"""
    f AS (
      SELECT *, {ds} AS match_ds FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE c_mktsegment = 'BUILDING' AND {ds} NOT IN {_NO_LIST}
    )"""


_REASON = """
    CASE WHEN ds IN ('1998-01-01', '1997-12-29') THEN 'status 404'
         WHEN ds IN ('1999-12-01', '1999-11-29') THEN 'unreadable body'
         WHEN ds IN ('2000-02-01', '2000-01-31') THEN 'request failed' END"""

ORACLES: dict[str, str] = {
    "matchday_football": f"""
    WITH {_football()}
    SELECT CAST(o_orderkey AS VARCHAR) AS match_id, CAST(o_custkey AS VARCHAR) AS "customId",
           CAST(epoch(o_orderdate) AS BIGINT) AS "startTimestamp", o_orderstatus AS status_type,
           o_orderpriority AS tournament_name, {_SEGMENT} AS tournament_category_sport_name,
           match_ds AS ds
    FROM f
    """,
    "matchday_audit": f"""
    SELECT ds, CAST(CASE WHEN ds IN ('1998-01-01', '1997-12-29') THEN 404
                        WHEN ds NOT IN ('2000-02-01', '2000-01-31') THEN 200 END AS INTEGER) AS status_code, {_REASON} AS reason
    FROM (SELECT DISTINCT {_DAY} AS ds FROM orders)
    """,
    "shotmap": _shotmap(),
    "shotmap_split": _shotmap(),
    "drift_report": f"""
    WITH {_matches()},
    first AS (
      SELECT min(ds) FILTER (WHERE ds >= '1997') AS ds97, min(ds) FILTER (WHERE ds >= '1999') AS ds99,
             count(*) FILTER (WHERE ds < '1997') AS n95, count(*) FILTER (WHERE ds >= '1997' AND ds < '1999') AS n97
      FROM l
    )
    SELECT ds97 AS ds, 'player.flag' AS field, 'went' AS change, CAST(NULL AS VARCHAR) AS type, 'string' AS before
    FROM first WHERE n95 > 0 AND n97 > 0
    UNION ALL
    SELECT ds99, 'player.flag', 'came', 'string', NULL FROM first WHERE n97 > 0 AND ds99 IS NOT NULL
    UNION ALL
    SELECT ds99, 'xg', 'changed', 'string', 'number' FROM first WHERE n95 + n97 > 0 AND ds99 IS NOT NULL
    """,
    "shotmap_inferred": _shotmap(id_type="BIGINT"),
    "failures_inferred": f"""
    WITH {_matches()}
    SELECT match_id, error_status AS status_code, ds FROM m WHERE o_orderstatus <> 'F'
    """,
    "value_rescue": f"""
    WITH {_matches()}
    SELECT CASE WHEN l_linenumber <> 4 THEN CAST(l_linenumber AS INTEGER) END AS id,
           CASE WHEN l_linenumber <> 2 THEN l_discount END AS xg,
           CASE WHEN l_linenumber NOT IN (3, 5) THEN l_partkey END AS player_id,
           CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS player_flag,
           CASE l_linenumber
             WHEN 2 THEN '{{"xg":"\\"' || l_discount || '\\""}}'
             WHEN 3 THEN '{{"player":"\\"player ' || l_partkey || '\\""}}'
             WHEN 4 THEN '{{"id":"4.5"}}'
             WHEN 5 THEN '{{"player.id":"[' || l_partkey || ']"}}' END AS rescued,
           match_id, {_OK_STATUS}, ds
    FROM l
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, match_id, error_status, ds FROM m WHERE {_ERROR}
    """,
    "append_drift": f"""
    SELECT o_orderkey,
           CASE WHEN {_MONTH} NOT BETWEEN '1997-01-01' AND '1998-12-31' THEN o_totalprice END
             AS o_totalprice,
           CASE WHEN {_MONTH} >= '1999-01-01'
                THEN '{{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority
                     || '"}}' END AS more,
           {_MONTH} AS ds
    FROM orders
    """,
    "match_event": """
    SELECT o_orderkey AS id, o_orderstatus AS status_type, o_totalprice AS "homeScore_current",
           CAST(epoch(o_orderdate) AS BIGINT) AS "startTimestamp",
           CAST(c_custkey AS VARCHAR) AS "customId", CAST(NULL AS VARCHAR) AS match_id,
           CAST(200 AS INTEGER) AS status_code, '2001-08-02' AS ds
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_acctbal >= 0 AND c_acctbal < 9000
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, CAST(c_custkey AS VARCHAR),
           CAST(CASE WHEN c_acctbal < 0 THEN 404 END AS INTEGER), '2001-08-02'
    FROM customer WHERE c_acctbal < 0 OR c_acctbal >= 9000
    """,
    "match_incident": f"""
    WITH {_matches()}
    SELECT CAST(l_linenumber AS INTEGER) AS id, l_returnflag AS "incidentType",
           CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END AS time,
           CASE WHEN l_returnflag = 'A' THEN l_partkey END AS player_id,
           CASE WHEN l_returnflag = 'A' THEN l_linestatus END AS player_team_code,
           CASE WHEN l_returnflag = 'R' THEN 'reason ' || l_suppkey END AS reason,
           CASE WHEN l_returnflag = 'N' THEN l_linestatus = 'O' END AS "isLive",
           match_id, {_OK_STATUS}, ds
    FROM l
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, match_id, error_status, ds
    FROM m WHERE {_ERROR}
    """,
    "match_lineups": _lineups("l_linestatus = 'F'", f"|{_ERROR}"),
    "match_lineups_both": _lineups(
        "TRUE", f"|{_ERROR}", team="team"
    ),
    "match_lineups_bad": _lineups(
        "l_linestatus = 'F'",
        f"WHERE bad_so_far = 0|{_ERROR} OR o_orderkey IN (SELECT l_orderkey FROM p WHERE bad)",
    ),
    "match_lineups_skip": _lineups("l_linestatus = 'F'", f"WHERE NOT bad|{_ERROR}"),
    "match_manager": f"""
    WITH {_matches()}
    SELECT CASE WHEN given THEN c_custkey END AS "homeManager_id",
           CASE WHEN given THEN c_name END AS "homeManager_name",
           CASE WHEN given THEN n_name END AS "homeManager_country_name",
           CASE WHEN given THEN o_orderkey END AS "awayManager_id",
           CASE WHEN given THEN o_orderpriority END AS "awayManager_name",
           match_id, CASE WHEN ok THEN CAST(200 AS INTEGER) ELSE error_status END AS status_code,
           ds
    FROM (SELECT *, ok AND o_orderpriority <> '4-NOT SPECIFIED' AS given FROM m)
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """,
    "match_statistics": _statistics("NOT ok"),
    "match_statistics_lenient": _statistics(_ERROR),
    "match_summary": f"""
    WITH {_matches()}
    SELECT CAST(l_suppkey AS VARCHAR) AS value, l_returnflag AS label,
           'Player ' || l_partkey AS player_name, 'player-' || l_partkey AS player_slug,
           'P. ' || l_partkey AS "player_shortName", l_returnflag AS player_position,
           CAST(l_linenumber AS VARCHAR) AS "player_jerseyNumber",
           CAST(l_quantity AS BIGINT) AS "player_userCount", l_partkey AS player_id,
           'EUR' AS "player_marketValueCurrency",
           CAST(epoch(l_shipdate) AS BIGINT) AS "player_dateOfBirthTimestamp",
           CASE WHEN l_returnflag <> 'N' THEN 'ar ' || l_partkey END
             AS "player_fieldTranslations_nameTranslation_ar",
           CASE WHEN l_returnflag <> 'N' THEN 'a ' || l_partkey END
             AS "player_fieldTranslations_shortNameTranslation_ar",
           CASE l_linestatus WHEN 'F' THEN 'home' ELSE 'away' END AS team,
           match_id, {_OK_STATUS}, ds
    FROM l
    UNION ALL
    SELECT {", ".join(["NULL"] * 14)}, match_id, error_status, ds
    FROM m WHERE {_ERROR} OR (n > 0 AND away = 0)
    """,
    "keyed_lookup": f"""
    WITH {_football()}, s AS ({_shotmap()})
    SELECT s.* FROM s JOIN f ON s.match_id = CAST(f.o_orderkey AS VARCHAR)
    """,
    "keyed_lookup_bucketed": f"""
    WITH {_football()}, s AS ({_shotmap()})
    SELECT s.* FROM s JOIN f ON s.match_id = CAST(f.o_orderkey AS VARCHAR)
    """,
    "status_filter": f"SELECT * FROM ({_shotmap()}) WHERE status_code = 404",
    "null_fill": f"""
    SELECT id, xg, player_id, coalesce(player_flag, 'null') AS player_flag, match_id,
           status_code, ds
    FROM ({_shotmap()})
    """,
    "week_starts": f"""
    SELECT o_orderkey, {_DAY} AS ds,
           strftime(date_trunc('week', date_trunc('day', o_orderdate) + INTERVAL 7 HOUR)
                    - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS week_start
    FROM orders
    """,
    "json_props": """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    """,
    "project_like_table": f"""
    SELECT o_orderpriority, o_totalprice, o_orderkey, {_MONTH} AS ds FROM orders
    """,
    "append_ds": """
    SELECT o_orderkey, o_totalprice, o_orderpriority, '2001-08-02' AS ds FROM orders
    UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderpriority, '2001-08-02' FROM orders
    """,
    "replace_ds": f"""
    SELECT o_orderkey, CASE ds WHEN '1997-03-01' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
           o_orderpriority, ds
    FROM (SELECT *, {_MONTH} AS ds FROM orders)
    WHERE ds <> '1997-04-01' AND (ds NOT LIKE '1998%' OR o_orderpriority = '1-URGENT')
    """,
    "column_list": """
    SELECT unnest(['id', 'incidentType', 'isLive', 'player_id', 'player_team_code', 'reason',
                   'time', 'match_id', 'status_code', 'ds']) AS column_name
    """,
    "retention": f"""
    SELECT o_orderkey, o_totalprice, o_orderpriority, {_MONTH} AS ds FROM orders
    WHERE date_diff('day', CAST({_MONTH} AS DATE), DATE '2001-08-02') <= 1000
    """,
    "retention_report": f"""
    SELECT DISTINCT {_MONTH} AS ds FROM orders
    WHERE date_diff('day', CAST({_MONTH} AS DATE), DATE '2001-08-02') > 1000
    """,
    "file_read": _shotmap(_WEEK),
    "incremental": _shotmap(),
}


_CONTENT = {
    "shotmap": ("shotmap", "player_id"),
    "match_incident": ("match_incident", "time"),
    "match_lineups": ("match_lineups", '"shirtNumber"'),
    "match_manager": ("match_manager", '"awayManager_id"'),
    "match_statistics": ("match_statistics_lenient", '"renderType"'),
    "match_summary": ("match_summary", '"player_userCount"'),
}


def _contents(listed: str, day: str) -> str:
    """Rows, ids and content per table and day of the matches that ``listed`` lets through."""
    per_match = "".join(
        f"""
      UNION ALL
      SELECT '{name}', k.match_ds, count(*), sum(CAST(r.match_id AS BIGINT)),
             sum(CAST(r.{value} AS BIGINT))
      FROM ({ORACLES[query]}) AS r JOIN k ON r.match_id = CAST(k.o_orderkey AS VARCHAR)
      GROUP BY k.match_ds"""
        for name, (query, value) in _CONTENT.items()
    )
    return f"""
    k AS (
      SELECT *, {day} AS match_ds FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE c_mktsegment = 'BUILDING' AND {listed}
    ),
    asked AS (
      SELECT DISTINCT o_custkey AS custom, match_ds, c_acctbal >= 0 AND c_acctbal < 9000 AS found
      FROM k
    ),
    content (table_name, ds, n, ids, total) AS (
      SELECT 'matchday', match_ds, count(*), sum(o_orderkey),
             sum(CAST(epoch(o_orderdate) AS BIGINT))
      FROM k GROUP BY match_ds
      UNION ALL
      SELECT 'match_event', match_ds, count(*), sum(custom),
             sum(CASE WHEN found THEN o_orderkey END)
      FROM asked LEFT JOIN orders ON found AND o_custkey = custom AND {day} = match_ds
      GROUP BY match_ds{per_match}
    )"""


ORACLES |= {
    "run_day": f"""
    WITH {_contents("TRUE", "'2001-08-02'")}
    SELECT table_name, n AS rows, CAST(ids AS BIGINT) AS ids, CAST(total AS BIGINT) AS total
    FROM content
    """,
    "backfill": f"""
    WITH {_contents(f"{_DAY} NOT IN {_NO_LIST}", _DAY)},
    days AS (
      SELECT strftime(unnest(generate_series(
               (SELECT date_trunc('day', min(o_orderdate)) FROM orders),
               (SELECT date_trunc('day', max(o_orderdate)) FROM orders), INTERVAL 1 DAY)), '%Y-%m-%d') AS ds
    ),
    reasons AS (
      SELECT ds, CASE WHEN ds NOT IN (SELECT {_DAY} FROM orders) THEN 'no reply'
                      ELSE {_REASON} END AS reason
      FROM days
    ),
    names AS (SELECT unnest([{", ".join(f"'{n}'" for n in ("matchday", "match_event", *_CONTENT))}]) AS table_name)
    SELECT table_name, ds, coalesce(n, 0) AS rows, coalesce(n, 0) AS held,
           CAST(ids AS BIGINT) AS ids, CAST(total AS BIGINT) AS total,
           CASE WHEN table_name = 'matchday' THEN reason
                WHEN reason IS NOT NULL THEN 'no match list' END AS reason
    FROM names CROSS JOIN reasons LEFT JOIN content USING (table_name, ds)
    """,
}

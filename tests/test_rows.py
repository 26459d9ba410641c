"""What each kind of reply turns into, endpoint by endpoint."""

import json
import random

import pytest

from kickflow.operators import endpoints
from kickflow.schemas import INT, LONG, REAL, TEXT, struct_of

SHOT = struct_of(id=INT, xg=REAL, player=struct_of(id=LONG, flag=TEXT))

ARRAYS = {
    "shotmap": ("shotmap", "match_id"),
    "match_incident": ("incidents", "match_id"),
    "match_event": ("events", "match_id"),
}


def run(name, frame, **more):
    rows = getattr(endpoints, name)(frame, SHOT, **more).collect()
    return [row.asDict() for row in rows]


def good(name):
    return json.dumps({ARRAYS[name][0]: [{"id": 1, "player": {"id": 7, "flag": "x"}}, {"id": 2}]})


@pytest.mark.parametrize("name", ARRAYS)
def test_records(replies, name):
    rows = run(name, replies(("k", 200, good(name))))
    assert [(r["id"], r["xg"], r["player_id"], r["player_flag"]) for r in rows] == [
        (1, None, 7, "x"),
        (2, None, None, None),
    ]
    assert {(r["status_code"], r["ds"]) for r in rows} == {(200, "2023-08-02")}


@pytest.mark.parametrize("name", ARRAYS)
def test_empty_array_gives_no_row(replies, name):
    assert run(name, replies(("k", 200, json.dumps({ARRAYS[name][0]: []})))) == []


FAILURES = [
    (200, "{}", None),
    (200, '{"MEMBER": null}', None),
    (200, '{"MEMBER": 5}', None),
    (200, '{"MEMBER": {"id": 1}}', None),
    (200, "{bad", None),
    (200, '{"MEMBER": [{"id": 1}', None),
    (200, '{"MEMBER": [{"id": 1}]} trailing', None),
    (200, '[{"MEMBER": [{"id": 1}]}]', None),
    (200, "{'MEMBER': [{'id': 1}]}", None),
    (200, "", None),
    (200, "null", None),
    (200, None, None),
    (404, '{"MEMBER": [{"id": 1}]}', 404),
    (500, None, 500),
    (None, None, None),
]


@pytest.mark.parametrize("name", ARRAYS)
def test_failures_give_one_error_row(replies, name):
    member, key = ARRAYS[name]
    frame = replies(
        *[
            (str(n), status, body and body.replace("MEMBER", member))
            for n, (status, body, _) in enumerate(FAILURES)
        ]
    )
    rows = run(name, frame)
    assert len(rows) == len(FAILURES)
    for row in rows:
        filled = {column: value for column, value in row.items() if value is not None}
        wanted = {key: row[key], "ds": "2023-08-02", "status_code": FAILURES[int(row[key])][2]}
        assert filled == {column: value for column, value in wanted.items() if value is not None}


@pytest.mark.parametrize("name", ARRAYS)
def test_bad_element_cuts_the_reply(replies, name):
    bads = ["null", "5", '"x"', "[1]", "true"]
    frame = replies(
        *[
            (bad, 200, f'{{"{ARRAYS[name][0]}": [{{"id": 1}}, {{"id": 2}}, {bad}, {{"id": 4}}]}}')
            for bad in bads
        ]
    )
    rows = run(name, frame)
    assert [(r["id"], r["status_code"]) for r in rows] == [(1, 200), (2, 200), (None, None)] * 5
    rows = run(name, frame, on_bad="skip")
    assert [r["id"] for r in rows] == [1, 2, 4] * 5


def test_unknown_policy(replies):
    with pytest.raises(ValueError):
        run("shotmap", replies(("k", 200, "{}")), on_bad="ignore")


def test_event_ids(replies):
    rows = run("match_event", replies(("c1", 200, good("match_event")), ("c2", 404, None)))
    assert [(r["customId"], r["match_id"], r["status_code"]) for r in rows] == [
        ("c1", None, 200),
        ("c1", None, 200),
        (None, "c2", 404),
    ]


def test_carried_columns_win_over_record_fields(replies):
    shape = struct_of(id=INT, status_code=INT, match_id=LONG)
    body = '{"shotmap": [{"id": 1, "status_code": 5, "match_id": 9}]}'
    row = endpoints.shotmap(replies(("k", 200, body)), shape).first()
    assert (row.id, row.status_code, row.match_id) == (1, 200, "k")


def test_odd_scalar_is_null_and_keeps_the_rest(replies):
    body = '{"shotmap": [{"id": "abc", "xg": 0.5, "player": 3}, {"id": 2}]}'
    rows = run("shotmap", replies(("k", 200, body)))
    assert [(r["id"], r["xg"], r["player_id"]) for r in rows] == [(None, 0.5, None), (2, None, None)]


def test_random_replies(spark, replies):
    """Many random replies in one job, against a plain model of the rules."""
    dice = random.Random(7)

    def element():
        return dice.choice(
            [{"id": dice.randint(1, 9)}, {"id": None}, {}, {"id": 3, "xg": 0.25}, None, 4, "t", []]
            + [{"id": dice.randint(1, 99), "player": {"id": 5}}] * 12
        )

    cases, wanted = [], {}
    for n in range(400):
        status = dice.choice([200, 200, 200, 404, 500, None])
        elements = [element() for _ in range(dice.randint(0, 12))]
        body = json.dumps({"other": 1, "shotmap": elements})
        broken = dice.random() < 0.1
        cases.append((str(n), status, body[:-1] if broken else body))
        if status != 200:
            wanted[str(n)] = [(None, status)]
        elif broken:
            wanted[str(n)] = [(None, None)]
        else:
            rows = []
            for e in elements:
                if not isinstance(e, dict):
                    rows.append((None, None))
                    break
                rows.append((e.get("id"), 200))
            wanted[str(n)] = rows
    got = {key: [] for key in wanted}
    for row in endpoints.shotmap(replies(*cases), SHOT).collect():
        got[row.match_id].append((row.id, row.status_code))
    assert got == wanted


def test_matchday(replies):
    def match(number, sport):
        category = {"sport": {"name": sport}} if sport else None
        return {"id": number, "customId": f"c{number}", "tournament": {"category": category}}

    shape = struct_of(
        id=LONG,
        customId=TEXT,
        tournament=struct_of(category=struct_of(sport=struct_of(name=TEXT))),
    )
    events = [match(1, "Football"), None, match(2, "Tennis"), match(3, None), match(4, "Football")]
    frame = replies(
        ("d1", 200, json.dumps({"events": events})),
        ("d2", 404, json.dumps({"events": events})),
        ("d3", 200, "{bad"),
        ("d4", 200, "{}"),
        ("d5", None, None),
    )
    rows = endpoints.matchday(frame, shape)
    assert [(r.match_id, r.customId) for r in rows.collect()] == [("1", "c1"), ("4", "c4")]
    assert dict(rows.dtypes)["match_id"] == "string"
    assert [r.match_id for r in endpoints.matchday(frame, shape, "Tennis").collect()] == ["2"]
    assert endpoints.matchday(frame, struct_of(id=LONG)).count() == 0
    reasons = [row.reason for row in endpoints.matchday_audit(frame).collect()]
    assert reasons == [None, "status 404", "unreadable body", "unreadable body", "request failed"]


def test_manager(replies):
    shape = struct_of(homeManager=struct_of(id=LONG, name=TEXT), awayManager=struct_of(id=LONG))
    rows = endpoints.match_manager(
        replies(
            ("a", 200, '{"homeManager": {"id": 1, "name": "n"}, "awayManager": null}'),
            ("b", 200, "{}"),
            ("c", 200, "{bad"),
            ("d", 200, "[1]"),
            ("e", 404, '{"homeManager": {"id": 1}}'),
            ("f", None, None),
        ),
        shape,
    )
    assert rows.columns == [
        "homeManager_id",
        "homeManager_name",
        "awayManager_id",
        "match_id",
        "status_code",
        "ds",
    ]
    assert [(r.match_id, r.homeManager_id, r.status_code) for r in rows.collect()] == [
        ("a", 1, 200),
        ("b", None, 200),
        ("c", None, None),
        ("d", None, None),
        ("e", None, 404),
        ("f", None, None),
    ]


def best(*labels):
    return [{"label": label, "player": {"id": 1}} if label else None for label in labels]


@pytest.mark.parametrize(
    "body, wanted",
    [
        (
            {"bestHomeTeamPlayers": best("a", "b"), "bestAwayTeamPlayers": best("c")},
            [("a", "home"), ("b", "home"), ("c", "away")],
        ),
        ({"bestHomeTeamPlayers": [], "bestAwayTeamPlayers": []}, []),
        ({"bestHomeTeamPlayers": best("a")}, [("a", "home"), (None, None)]),
        ({"bestHomeTeamPlayers": best("a"), "bestAwayTeamPlayers": None}, [("a", "home"), (None, None)]),
        ({"bestAwayTeamPlayers": best("c")}, [(None, None)]),
        (
            {"bestHomeTeamPlayers": best("a", None, "b"), "bestAwayTeamPlayers": best("c")},
            [("a", "home"), (None, None)],
        ),
        (
            {"bestHomeTeamPlayers": best("a"), "bestAwayTeamPlayers": [7] + best("c")},
            [("a", "home"), (None, None)],
        ),
    ],
)
def test_summary(replies, body, wanted):
    rows = endpoints.match_summary(replies(("k", 200, json.dumps(body))))
    assert len(rows.columns) == 17
    assert [(r.label, r.team) for r in rows.collect()] == wanted
    assert [r.status_code for r in rows.collect()] == [200 if w[0] else None for w in wanted]


PLAYER = struct_of(id=LONG, rating=REAL, position=TEXT, home=struct_of(x=LONG), extra=TEXT)
STATISTICS = struct_of(rating=REAL, minutes=LONG, home=struct_of(x=LONG, y=LONG))


def entry(player=None, statistics=None, **more):
    whole = {
        "player": {"id": 1, "rating": 1.0, "position": "G"} | (player or {}),
        "statistics": {} if statistics is None else statistics,
        "shirtNumber": 9,
        "jerseyNumber": "9",
        "position": "D",
        "substitute": False,
    } | more
    return {name: value for name, value in whole.items() if value != "absent"}


def lineups(replies, *players, **more):
    body = json.dumps({"home": {"players": list(players)}, "away": {"players": [entry()]}})
    return endpoints.match_lineups(
        replies(("k", 200, body)), PLAYER, STATISTICS, **more
    ).collect()


def test_lineups_merge(replies):
    rows = lineups(
        replies,
        entry(),
        entry(statistics={"rating": 2.0, "minutes": 90}),
        entry(statistics={"rating": None}),
        entry(player={"home": {"x": 1}}, statistics={"home": {"y": 2}}),
        entry(position=None),
    )
    assert [r.rating for r in rows] == [1.0, 2.0, None, 1.0, 1.0]
    assert [r.minutes for r in rows] == [None, 90, None, None, None]
    assert [r.position for r in rows] == ["D", "D", "D", "D", None]
    assert (rows[3].home_x, rows[3].home_y) == (None, 2)
    assert {r.status_code for r in rows} == {200}


BAD_ENTRIES = [
    None,
    5,
    entry(statistics="absent"),
    entry(statistics=[]),
    entry() | {"player": None},
    entry() | {"statistics": None},
    entry(shirtNumber="absent"),
    entry(jerseyNumber="absent"),
    entry(position="absent"),
    entry(substitute="absent"),
]


def test_lineups_bad_entry(replies):
    frame = replies(
        *[
            (str(n), 200, json.dumps({"home": {"players": [entry(), bad, entry()]}}))
            for n, bad in enumerate(BAD_ENTRIES)
        ]
    )
    rows = endpoints.match_lineups(frame, PLAYER, STATISTICS).collect()
    wanted = [(str(n), *row) for n in range(len(BAD_ENTRIES)) for row in [(1, 200), (None, None)]]
    assert [(r.match_id, r.id, r.status_code) for r in rows] == wanted
    rows = endpoints.match_lineups(frame, PLAYER, STATISTICS, on_bad="skip").collect()
    assert [(r.id, r.status_code) for r in rows] == [(1, 200)] * 2 * len(BAD_ENTRIES)


def test_random_lineups(replies):
    """Merging in one job, against plain dictionaries."""
    dice = random.Random(11)
    names = ["rating", "minutes", "home", "position", "extra"]
    values = {
        "rating": [None, 1.5, 2.5], "minutes": [None, 90], "position": [None, "G"],
        "extra": [None, "e"], "home": [None, {}, {"x": 1}, {"y": 2}, {"x": 3, "y": None}],
    }

    def some(allowed):
        return {n: dice.choice(values[n]) for n in allowed if dice.random() < 0.6}

    cases, wanted = [], {}
    for n in range(300):
        players = []
        for _ in range(dice.randint(0, 4)):
            player = some(["rating", "position", "extra"]) | {"id": dice.choice([None, 3])}
            if dice.random() < 0.5:
                player["home"] = dice.choice([None, {}, {"x": 8}])
            players.append(entry() | {"player": player, "statistics": some(names[:3])})
        cases.append((str(n), 200, json.dumps({"home": {"players": players}})))
        wanted[str(n)] = []
        for e in players:
            merged = e["player"] | e["statistics"] | {k: e[k] for k in ("shirtNumber", "position")}
            home = merged.get("home") or {}
            wanted[str(n)].append(
                (merged["id"], merged.get("rating"), merged.get("minutes"), home.get("x"),
                 home.get("y"), merged["position"], merged.get("extra"), merged["shirtNumber"])
            )
    got = {key: [] for key in wanted}
    for r in endpoints.match_lineups(replies(*cases), PLAYER, STATISTICS).collect():
        got[r.match_id].append(
            (r.id, r.rating, r.minutes, r.home_x, r.home_y, r.position, r.extra, r.shirtNumber)
        )
    assert got == wanted


def test_lineups_sides(replies):
    rows = lineups(replies, entry(), entry(), sides=("home", "away"))
    assert [r.team for r in rows] == ["home", "home", "away"]


def item(**more):
    whole = {
        "name": "n", "home": "1", "away": 2, "compareCode": 1, "statisticsType": "t",
        "valueType": "v", "homeValue": 1, "awayValue": 2.5, "renderType": 1, "key": None,
    } | more
    return {name: value for name, value in whole.items() if value != "absent"}


def statistics(*items, **more):
    group = {"groupName": "g", "statisticsItems": list(items)} | more
    return {"statistics": [{"period": "ALL", "groups": [group]}]}


def test_statistics(replies):
    body = {
        "statistics": [
            {"period": p, "groups": [{"groupName": g, "statisticsItems": [item(), item(name=None)]} for g in "xy"]}
            for p in ("ALL", "1ST")
        ]
    }
    frame = replies(
        ("a", 200, json.dumps(body)),
        ("b", 404, None),
        ("c", 200, "{bad"),
        ("d", 200, '{"statistics": []}'),
        ("e", 200, '{"statistics": [{"groups": []}]}'),
    )
    df = endpoints.match_statistics(frame)
    assert len(df.columns) == 15
    rows = df.collect()
    assert [(r.period, r.groupName, r.name) for r in rows[:8]] == [
        (p, g, n) for p in ("ALL", "1ST") for g in "xy" for n in ("n", None)
    ]
    assert (rows[0].home, rows[0].away, rows[0].homeValue, rows[0].awayValue) == ("1", "2", 1.0, 2.5)
    assert [(r.match_id, r.status_code) for r in rows[8:]] == [("b", 404), ("c", None)]


@pytest.mark.parametrize(
    "body, before",
    [
        ({}, 0),
        ({"statistics": None}, 0),
        (statistics(item(), item(key="absent"), item()), 1),
        (statistics(item(), None), 1),
        ({"statistics": [{"period": "ALL"}]}, 0),
        ({"statistics": [None]}, 0),
        ({"statistics": [{"groups": [{"groupName": "g", "statisticsItems": [item()]}]}]}, 0),
        ({"statistics": statistics(item())["statistics"] + [{"period": "1ST", "groups": [{"groupName": "g"}]}]}, 1),
    ],
)
def test_statistics_missing_member(replies, body, before):
    frame = replies(("k", 200, json.dumps(body)))
    rows = endpoints.match_statistics(frame, strict=False).collect()
    assert [r.status_code for r in rows] == [200] * before + [None]
    with pytest.raises(Exception, match="statistics of match k lack a member"):
        endpoints.match_statistics(frame).collect()


def test_shapes_are_inferred(replies):
    frame = replies(
        ("a", 200, '{"shotmap": [{"id": 1, "a.b": 2, "p": {"x": 1.5}}, 7]}'),
        ("b", 200, '{"shotmap": [{"id": 2, "p": {"y": "t", "deep": {"z": true}}, "l": [1, 2]}]}'),
        ("c", 404, '{"shotmap": [{"never": 2}]}'),
        ("d", 200, '{"shotmap": [{"id": "odd", "nil": null}]}'),
    )
    df = endpoints.shotmap(frame)
    assert dict(df.dtypes) == {
        "id": "string",
        "a_b": "bigint",
        "p_x": "double",
        "p_y": "string",
        "p_deep_z": "boolean",
        "l": "array<bigint>",
        "nil": "string",
        "match_id": "string",
        "status_code": "int",
        "ds": "string",
    }
    rows = {(r.match_id, r.id): r for r in df.collect()}
    assert rows["a", "1"].a_b == 2 and rows["a", "1"].p_x == 1.5
    assert rows["b", "2"].l == [1, 2] and rows["b", "2"].p_deep_z is True
    assert rows["d", "odd"].status_code == 200
    assert rows["a", None].status_code is None


@pytest.mark.parametrize("reply", [(404, "{}"), (None, None), (200, "{"), (200, "[]"), (200, "{}")])
@pytest.mark.parametrize("name", ["shotmap", "match_event", "match_incident", "match_lineups", "match_manager", "match_statistics", "match_summary"])
def test_nothing_to_infer(replies, name, reply):
    """Failures alone give error rows of key, status and day."""
    more = {"strict": False} if name == "match_statistics" else {}
    df = getattr(endpoints, name)(replies(("k", *reply)), **more)
    row = df.first().asDict()
    whole = name == "match_manager" and reply == (200, "{}")
    assert row["match_id"] == "k" and row["ds"] == "2023-08-02"
    assert row["status_code"] == (reply[0] if reply[0] != 200 or whole else None)
    assert df.count() == 1


@pytest.mark.parametrize("body", ['{"events": []}', "{", '{"events": [1]}', '{"events": [{"x": 1}]}'])
def test_match_list_without_ids(replies, body):
    df = endpoints.matchday(replies(("2023-08-02", 200, body)))
    assert df.count() == 0
    assert {"match_id", "customId", "ds"} <= set(df.columns)


def test_empty_arrays_give_no_rows(replies):
    assert endpoints.shotmap(replies(("k", 200, '{"shotmap": []}'))).count() == 0


def test_inferred_lineups_and_managers(replies):
    body = json.dumps({"home": {"players": [entry(statistics={"goals": 1})]}})
    row = endpoints.match_lineups(replies(("k", 200, body))).first()
    assert (row.id, row.goals, row.position) == (1, 1, "D")
    row = endpoints.match_manager(replies(("k", 200, '{"m": {"id": 4, "b": true}}'))).first()
    assert (row.m_id, row.m_b, row.match_id) == (4, True, "k")

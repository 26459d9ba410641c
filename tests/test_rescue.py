"""Values that a given shape has no place for."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kickflow.operators import endpoints
from kickflow.schemas import FLAG, INT, LONG, REAL, TEXT, struct_of

INNER = struct_of(id=LONG, name=TEXT, deep=struct_of(on=FLAG))
SHAPE = struct_of(id=INT, xg=REAL, player=INNER, marks=T.ArrayType(LONG))
GOOD = {"id": 1, "xg": 0.5, "player": {"id": 7, "name": "n", "deep": {"on": True}}, "marks": [1, 2]}


def found(replies, *shots, shape=SHAPE, **more):
    body = json.dumps({"shotmap": list(shots)})
    rows = endpoints.shotmap(replies(("k", 200, body)), shape, rescue="lost", **more)
    return [(r.id, r.lost) for r in rows.collect()]


@pytest.mark.parametrize(
    "change,lost",
    [
        ({}, None),
        ({"id": "1"}, {"id": '"1"'}),
        ({"id": 1.5}, {"id": "1.5"}),
        ({"id": 3_000_000_000}, {"id": "3000000000"}),
        ({"id": [1]}, {"id": "[1]"}),
        ({"xg": "high"}, {"xg": '"high"'}),
        ({"xg": None}, None),
        ({"player": None}, None),
        ({"player": "someone"}, {"player": '"someone"'}),
        ({"player": [GOOD["player"]]}, {"player": '[{"deep":{"on":true},"id":7,"name":"n"}]'}),
        ({"player": {"id": "7", "deep": {"on": "yes"}}}, {"player.id": '"7"', "player.deep.on": '"yes"'}),
        ({"player": {"deep": False}}, {"player.deep": "false"}),
        ({"marks": [1, "two", 3]}, {"marks": '[1,"two",3]'}),
        ({"marks": [1, None]}, None),
        ({"marks": {"a": 1}}, {"marks": '{"a":1}'}),
        ({"new": 5}, None),
    ],
)
def test_each_kind_of_drift(replies, change, lost):
    shot = {**GOOD, **change}
    assert [x[1] for x in found(replies, GOOD, shot, GOOD)] == [None, lost, None]


def test_missing_members_are_not_lost(replies):
    assert found(replies, {}, {"id": 2}) == [(None, None), (2, None)]


def test_values_are_kept_as_they_were(replies):
    shot = {"id": 1, "xg": {"a": [1, {"b": 'q"uote'}]}, "player": GOOD["player"], "marks": []}
    ((_, lost),) = found(replies, shot)
    assert json.loads(lost["xg"]) == shot["xg"]


def test_bad_elements_beside_drift(replies):
    shots = [GOOD, {**GOOD, "id": "x"}, "no shot", {**GOOD, "xg": "y"}]
    assert found(replies, *shots) == [(1, None), (None, {"id": '"x"'}), (None, None)]
    kept = found(replies, *shots, on_bad="skip")
    assert kept == [(1, None), (None, {"id": '"x"'}), (1, {"xg": '"y"'})]


def test_failures_and_empty_replies(replies):
    frame = replies(("a", 404, "{}"), ("b", 200, "{"), ("c", 200, '{"shotmap": []}'), ("d", None, None))
    rows = endpoints.shotmap(frame, SHAPE, rescue="lost").collect()
    assert sorted((r.match_id, r.lost) for r in rows) == [("a", None), ("b", None), ("d", None)]


def test_other_endpoints(replies):
    event = {"id": "e", "startTimestamp": 1}
    shape = struct_of(id=LONG, startTimestamp=LONG)
    got = endpoints.match_event(replies(("c", 200, json.dumps({"events": [event]}))), shape, rescue="lost").first()
    assert (got.id, got.startTimestamp, got.lost, got.customId) == (None, 1, {"id": '"e"'}, "c")
    got = endpoints.match_incident(replies(("c", 200, json.dumps({"incidents": [event]}))), shape, rescue="lost").first()
    assert got.lost == {"id": '"e"'}
    managers = struct_of(homeManager=struct_of(id=LONG))
    frame = replies(("1", 200, '{"homeManager": {"id": "x"}}'), ("2", 200, '{"homeManager": {"id": 2}}'), ("3", 404, "{}"))
    rows = endpoints.match_manager(frame, managers, rescue="lost").orderBy("match_id").collect()
    assert [(r.homeManager_id, r.lost) for r in rows] == [(None, {"homeManager.id": '"x"'}), (2, None), (None, None)]
    day = {"events": [{"id": 1, "customId": 5.5, "tournament": {"category": {"sport": {"name": "Football"}}}}]}
    shape = struct_of(id=LONG, customId=LONG, tournament=struct_of(category=struct_of(sport=struct_of(name=TEXT))))
    got = endpoints.matchday(replies(("d", 200, json.dumps(day))), shape, rescue="lost").first()
    assert (got.match_id, got.customId, got.lost) == ("1", None, {"customId": "5.5"})


def test_without_rescue_nothing_changes(replies):
    frame = replies(("k", 200, json.dumps({"shotmap": [{**GOOD, "id": "x"}]})))
    plain = endpoints.shotmap(frame, SHAPE)
    assert plain.collect() == endpoints.shotmap(frame, SHAPE, rescue="lost").drop("lost").collect()
    assert "is_variant_null" not in plain._jdf.queryExecution().executedPlan().toString()


def test_any_nested_values(replies):
    """Every scalar of a reply is either in its column or kept, whatever its type."""
    values = [None, True, 0, -1, 2.5, 1e30, "", "7", [], [1], {}, {"id": 1}]
    shape = struct_of(id=LONG, xg=REAL, player=struct_of(id=LONG))
    shots = [{"id": v, "xg": w, "player": {"id": u}} for v in values for w in values[:6] for u in values[5:]]
    body = json.dumps({"shotmap": shots})
    rows = endpoints.shotmap(replies(("k", 200, body)), shape, rescue="lost").select("id", "xg", "player_id", "lost").collect()
    assert len(rows) == len(shots)
    for row, shot in zip(rows, shots, strict=True):
        lost = row.lost or {}
        for path, column, value in (("id", row.id, shot["id"]), ("xg", row.xg, shot["xg"]), ("player.id", row.player_id, shot["player"]["id"])):
            if value is None:
                assert column is None and path not in lost
            elif column is None:
                assert json.loads(lost[path]) == value, (path, value, row)
            else:
                assert column == value and path not in lost

"""Bodies that are cut between the elements of their array."""

import json
import random

import pytest
from compare import difference
from pyspark.sql import functions as F

from kickflow.operators import endpoints, large
from kickflow.oracles import ORACLES
from kickflow.queries import SHOT
from kickflow.schemas import INT, LONG, TEXT, struct_of
from kickflow.sources import derived

SHAPE = struct_of(id=LONG, name=TEXT, inner=struct_of(x=TEXT))


def parts(body, most, name="shotmap"):
    found = large.pieces(body.encode(), name, most)
    return found and [body.encode()[a:b].decode() for a, b in found]


def any_value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 5)
    if kind < 2:
        return "".join(rng.choice('ab"\\[]{},: é\n') for _ in range(rng.randint(0, 12)))
    if kind < 5:
        return rng.choice([None, True, 1, -2.5, 10**12])
    if kind == 5:
        return [any_value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["id", "name", "inner", "shotmap", 'a"b']): any_value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


@pytest.mark.parametrize("step", [3, 7, 64, 1 << 20])
def test_cuts_are_between_elements(monkeypatch, step):
    monkeypatch.setattr(large, "STEP", step)
    rng = random.Random(step)
    for _ in range(200):
        elements = [any_value(rng) for _ in range(rng.randint(1, 12))]
        members = {"first": any_value(rng), "shotmap": elements, "last": any_value(rng)}
        body = json.dumps(members, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        most = rng.choice([1, 10, 40, 10_000])
        array, *found = parts(body, most)
        assert json.loads(array + "]") == elements
        read = [json.loads(f"[{part}]") for part in found]
        assert [x for part in read for x in part] == elements
        # Each part is as large as it should be, and its last element is what exceeds it.
        assert all(len(part.encode()) >= most for part in found[:-1])
        assert all(len(json.dumps(r)) < 3 * most + 2000 for r in read)


@pytest.mark.parametrize(
    "body",
    [
        "", "{", "[1,2]", "{}", '{"shotmap":5}', '{"shotmap":[]}', '{"shotmap":[ ]}', '{"shotmap":[1,2}',
        '{"shotmap":[1,2]', '{"shotmap":["a]}', '{"other":[1,2]}', '{"a":{"shotmap":[1,2]}}', '}{"shotmap":[1]}',
        '{"shotmap":[1,2],"shotmap":[3]}', '{"shotmap":[1,2],"shotmap":null}', '{"shotmap":x[1,2]}',
        '{"shotmap":[1,2, ]}',
    ],
)
def test_what_is_not_cut(body):
    assert parts(body, 1) is None


BODIES = [
    '{"shotmap":[{"id":1},{"id":2},{"id":3},{"id":4}]}',
    '{"x":[1,2],"shotmap":[{"id":1,"name":"a]"},{"id":2,"inner":{"x":"},{"}},{"id":3}],"y":{"z":[3]}}',
    '{"shotmap":[{"id":1},{"id":2},5,{"id":4},{"id":5}]}',
    '{"shotmap":[{"id":1},{"id":2},{"id":3},7,8]}',
    '{"shotmap":[{"id":1},{"id":2},{"id":tru},{"id":4}]}',
    '{"shotmap":[{"id":1},{"id":2},{"id":3}],"y":}',
    '{"shotmap":[{"id":1},{"id":2},{"id":3}]} after',
    '{"shotmap":[{"id":1},{"id":2},{"id":3}',
    '{"shotmap":[{"id":1},{"id":2},,{"id":3}]}',
    '{"shotmap":[null,{"id":2},null]}',
    '{"shotmap":[{"id":"x"},{"id":2},{"id":3}]}',
    '{"shotmap":[]}', '{"shotmap":null}', "{}", "", "[1]",
]


@pytest.mark.parametrize("on_bad", ["truncate", "skip"])
@pytest.mark.parametrize("split", [1, 16, 30, 100_000])
def test_same_rows_as_unsplit(replies, on_bad, split):
    frame = replies(
        *[(str(i), 200, body) for i, body in enumerate(BODIES)],
        ("same", 200, BODIES[0]), ("same", 200, BODIES[0]), ("bad", 200, BODIES[4]),
        ("gone", 404, BODIES[0]), ("none", None, None), (None, 200, BODIES[0]),
    )
    wanted = endpoints.shotmap(frame, SHAPE, on_bad=on_bad, rescue="lost")
    found = endpoints.shotmap(frame, SHAPE, on_bad=on_bad, rescue="lost", split=split)
    assert found.columns == wanted.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_one_unpaged_body(spark, replies):
    """60,000 records in one reply; no piece and no task has more than its share."""
    shots = [{"id": n, "name": "n" * (n % 50)} for n in range(60_000)]
    frame = replies(("hot", 200, json.dumps({"shotmap": shots})))
    shape = struct_of(id=INT, name=TEXT)
    found = endpoints.shotmap(frame, shape, split=50_000)
    assert found.agg(F.count("id"), F.sum("id"), F.max("id")).first() == (60_000, 60_000 * 59_999 // 2, 59_999)
    cut = large.cut(frame, "shotmap", 50_000)
    sizes = [r.n for r in cut.select(F.octet_length("body").alias("n")).collect()]
    assert len(sizes) > 50 and max(sizes) < 51_000
    pieces = cut.repartition(8, "source", "piece").groupBy(F.spark_partition_id()).count().collect()
    assert len(pieces) == 8 and max(r["count"] for r in pieces) < len(sizes) / 3


def test_match_events(replies):
    body = json.dumps({"events": [{"id": n} for n in range(50)]})
    got = endpoints.match_event(replies(("c", 200, body)), struct_of(id=LONG), split=20).collect()
    assert sorted(r.id for r in got) == list(range(50)) and {r.customId for r in got} == {"c"}


def test_hot_order_unpaged(spark, tmp_path, monkeypatch):
    """All lines of one order in one body, against the query's SQL."""
    import duckdb

    small = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{small}/orders.parquet'")
    hot = con.execute("SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000").fetchone()[0]
    con.execute(f"COPY (SELECT * FROM orders) TO '{tmp_path}/orders.parquet'")
    con.execute(f"""
        COPY (SELECT * FROM '{small}/lineitem.parquet' UNION ALL
              SELECT {hot}, i % 50, i % 7, 1 + i % 6, i % 40, i, 0.5, 0.1, 'A', 'F', TIMESTAMP '1997-05-05'
              FROM range(20000) t(i)) TO '{tmp_path}/lineitem.parquet'
    """)
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    monkeypatch.setattr(derived, "PAGE_RECORDS", 1_000_000)
    replies = derived.line_replies(spark, str(tmp_path), ["shotmap"])
    assert replies.agg(F.max(F.octet_length("body"))).first()[0] > 500_000
    assert difference(endpoints.shotmap(replies, SHOT, split=10_000), ORACLES["shotmap"], con) is None


def test_short_bodies_are_scanned_alike():
    rng = random.Random(5)
    for _ in range(3000):
        text = json.dumps({"shotmap": [any_value(rng) for _ in range(4)], "x": any_value(rng)}).encode()
        at = rng.randrange(len(text))
        for body in (text, text[:at], text[at:], text[:at] + rng.choice([b'"', b"\\", b"]", b"{", b'\\"']) + text[at:]):
            wanted, found = large._marks(body), large._small_marks(body)
            assert (wanted is None) == (found is None)
            assert wanted is None or all((a == b).all() for a, b in zip(wanted, found, strict=True))


def test_pieces_of_many_bodies_are_handed_on_together(replies):
    """A record batch for each body took most of the time."""
    import pyarrow as pa

    frame = replies(*[(str(i), 200, json.dumps({"shotmap": [{"id": i}, {"id": i + 1}]})) for i in range(500)])
    seen = large.cut(frame.coalesce(1), "shotmap", 1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)])], ["n"])

    found = [r.n for r in seen.mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 1500 and max(found) > 500


def test_faultless_pieces_meet_no_verdict(replies, monkeypatch):
    stored, kept = large.stored, []
    monkeypatch.setattr(large, "stored", lambda df, purpose: kept.append(stored(df, purpose)) or kept[-1])
    frame = replies(*[(str(i), 200, body) for i, body in enumerate(BODIES[:4])])
    found = endpoints.shotmap(frame, SHAPE, split=1)
    assert sorted(map(str, found.collect())) == sorted(map(str, endpoints.shotmap(frame, SHAPE).collect()))

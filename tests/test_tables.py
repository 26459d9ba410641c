"""Sinks, retention, jobs, whole runs and incremental loading."""

import json

import pytest
from pyspark.sql import functions as F

from kickflow.operators import endpoints
from kickflow.plans.daily import TABLES, crawl_days, run_day, run_days
from kickflow.plans.job import DONE, SKIPPED, EmptyInput, JobConfig, run_job, table_export
from kickflow.plans.retention import expire, expired_days
from kickflow.schemas import INT, LANDED, LONG, REPLIES, TEXT, struct_of
from kickflow.session import checkpointed, setting, shared_folder
from kickflow.sinks import jdbc
from kickflow.sinks.store import Store
from kickflow.sinks.tables import (
    append,
    create_database,
    partition_days,
    replace_day,
    replace_days,
    replace_range,
    table_name,
)
from kickflow.sources.database import DRIVERS, TABLES_SQL, catalog_tables, jdbc_options
from kickflow.sources.fetch import fetch_replies
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
from kickflow.streaming.incremental import fold, latest, take_in


@pytest.fixture
def target(database):
    return table_name(database, "Target")


def days(spark, **counts):
    rows = [(n, f"v{n}", ds.replace("_", "-")[1:]) for ds, count in counts.items() for n in range(count)]
    return spark.createDataFrame(rows, "a INT, b STRING, ds STRING")


def counted(spark, table):
    return {row.ds: row["count"] for row in spark.table(table).groupBy("ds").count().collect()}


D1, D2, D3 = "2023-08-01", "2023-08-02", "2023-08-03"


def test_append_adds_and_reruns_duplicate(spark, target):
    df = days(spark, d2023_08_01=3).drop("ds")
    assert append(df, target, ds=D1).columns == ["a", "b", "ds"]
    append(df.select("b", "a"), target, ds=D2, num_out=2)
    append(df, target, ds=D2)
    assert counted(spark, target) == {D1: 3, D2: 6}
    assert spark.table(target).where("b <> concat('v', a)").count() == 0
    append(df.drop("b"), target, ds=D3)
    assert spark.table(target).where((F.col("ds") == D3) & F.col("b").isNull()).count() == 3


def test_replace_day(spark, target):
    df = days(spark, d2023_08_01=3, d2023_08_02=4, d2023_08_03=5)
    append(df, target)
    for _ in range(2):
        replace_day(df.where("a = 0").drop("ds").select("b", "a"), target, D2, num_out=3)
        replace_day(days(spark, d2023_08_03=9), target, D3)
    assert counted(spark, target) == {D1: 3, D2: 3, D3: 9}
    replace_day(df.where("false"), target, D3)
    assert counted(spark, target) == {D1: 3, D2: 3}
    replace_day(df.where("a = 1"), target, D1, drop_sql=f"ALTER TABLE {target} DROP PARTITION (ds = '{D2}')")
    assert counted(spark, target) == {D1: 6}


def test_replace_day_creates_the_table(spark, target):
    replace_day(days(spark, d2023_08_01=3), target, D2)
    assert counted(spark, target) == {D2: 3}


def test_replace_days(spark, target):
    append(days(spark, d2023_08_01=3, d2023_08_02=4, d2023_08_03=5), target)
    for _ in range(2):
        replace_days(days(spark, d2023_08_02=1), target, [D2, D3])
    assert counted(spark, target) == {D1: 3, D2: 1}
    replace_range(days(spark, d2023_08_01=7), target, D1, D2)
    assert counted(spark, target) == {D1: 7}
    replace_range(days(spark, d2023_08_01=0, d2023_08_03=2).where("ds > '2023-08-02'"), target, D2, D3)
    assert counted(spark, target) == {D1: 7, D3: 2}


def test_retention(spark, target):
    append(days(spark, d2023_07_01=1, d2023_07_02=1, d2023_07_31=1), target)
    old = expired_days(spark, target, as_of="2023-08-01")
    assert [row.ds for row in old.collect()] == ["2023-07-01"]
    assert expire(spark, target, "2023-08-01", enable_delete=False) == ["2023-07-01"]
    assert partition_days(spark, target).count() == 3
    assert expire(spark, target, "2023-08-01", max_age=2) == ["2023-07-01", "2023-07-02"]
    assert counted(spark, target) == {"2023-07-31": 1}


def test_catalog_tables(spark, database, target):
    append(days(spark, d2023_07_01=1), target)
    assert [tuple(row) for row in catalog_tables(spark, database).collect()] == [(database, "target")]


class FakeDatabase:
    """Records statements; a real one would need a server."""

    def __init__(self):
        self.done = []

    def __call__(self):
        return self

    cursor = __call__

    def execute(self, sql):
        self.done.append(sql)

    def commit(self):
        self.done.append("commit")

    def close(self):
        pass


def test_jdbc_slice(spark, monkeypatch):
    written = {}

    def write(writer, url, table, *_, **__):
        written.update(url=url, table=table)

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", write)
    df = spark.createDataFrame([(None, None, [1])], "s STRING, i INT, l ARRAY<INT>")
    for filled in (False, True):
        monkeypatch.setattr(jdbc, "table_has_rows", lambda *_, filled=filled: filled)
        fake = FakeDatabase()
        jdbc.replace_slice(df, "jdbc:u", "src.t", D2, "crate", fake)
        wanted = [jdbc.DROP_SLICE_SQL.format(table="src.t", ds=D2), "commit"] if filled else []
        assert fake.done == wanted
        fake = FakeDatabase()
        jdbc.replace_slice(df, "jdbc:u", "src.t", D2, "crate", fake, drop_sql="DELETE")
        assert fake.done == (["DELETE", "commit"] if filled else [])
    assert written == {"url": "jdbc:u", "table": "src.t"}
    ready = jdbc.prepared(df)
    assert ready.rdd.getNumPartitions() == 10
    assert tuple(ready.first()) == ("null", None, "[1]")
    assert "date_trunc('week', '+07:00', date_format('%Y-%m-%d', '+07:00', '2023-08-02'))" in (
        jdbc.DROP_SLICE_SQL.format(table="t", ds=D2)
    )


def test_jdbc_options():
    assert jdbc_options("u", TABLES_SQL, "postgres") == {
        "url": "u",
        "driver": DRIVERS["postgres"],
        "query": "SELECT table_schema, table_name FROM information_schema.tables",
    }
    split = jdbc_options("u", "SELECT 1", "my.Driver", ("id", "0", "9", 4), {"fetchsize": "10"})
    assert split["dbtable"] == "(SELECT 1) t" and "query" not in split
    assert (split["driver"], split["numPartitions"], split["fetchsize"]) == ("my.Driver", "4", "10")


def test_job_steps_and_empty_input(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([("shotmap", "1", 200, '{"shotmap": [{"id": 5}]}', D1)], REPLIES).write.json(folder)
    steps = []
    config = JobConfig("Src", "Shots", D1, {"in_path": folder})
    assert (config.num_in_partition, config.num_out_partition, config.skip_empty) == (10, None, False)

    def read():
        steps.append("read")
        return read_files(spark, config, REPLIES, repartition=True)

    def run(read, config=config, **more):
        return run_job(
            config,
            read,
            lambda df: endpoints.shotmap(df, struct_of(id=INT)),
            lambda df: steps.append([row.id for row in df.collect()]),
            before_read=lambda: steps.append("before_read"),
            before_export=lambda df: steps.append(df.columns),
            **more,
        )

    assert run(read) == DONE
    assert steps == ["before_read", "read", ["id", "match_id", "status_code", "ds"], [5]]
    assert read().rdd.getNumPartitions() == 10
    parts = []
    three = JobConfig("Src", "Shots", D1, {"in_path": folder}, num_out_partition=3)
    run_job(three, read, lambda df: df, lambda df: parts.append(df.rdd.getNumPartitions()))
    assert parts == [3]
    create_database(spark, "src", shared_folder(spark, "src"))
    run_job(three, read, lambda df: spark.range(90).select("id", F.lit(D1).alias("ds")), table_export(three))
    assert spark.table("src.shots").select("_metadata.file_path").distinct().count() == 3
    with pytest.raises(EmptyInput):
        run(lambda: None)
    skipping = JobConfig("Src", "Shots", D1, {"skip_empty": True})
    assert run(lambda: None, skipping) == SKIPPED
    assert run(lambda: read().where("false"), skipping, no_rows_is_empty=True) == SKIPPED
    assert run(lambda: read().where("false"), skipping) == DONE


def shot(*ids):
    return json.dumps({"shotmap": [{"id": n} for n in ids]})


def test_lookup(spark, replies):
    frame = replies(("1", 200, shot(1, 2)), ("2", 404, None), ("2", 200, shot(3)), ("9", 200, shot(9)))
    keys = spark.createDataFrame(
        [("1", D2), ("1", D2), ("2", D2), ("3", D2), ("9", D3), (None, D2)], "key STRING, ds STRING"
    )
    for bound in ("-1", "10m"):
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", bound):
            check_lookup(endpoints.shotmap(for_keys(frame, keys), struct_of(id=INT)).collect())


def check_lookup(rows):
    got = sorted(((r.match_id, r.ds, r.id, r.status_code) for r in rows), key=repr)
    assert got == sorted(
        [("1", D2, 1, 200), ("1", D2, 2, 200)] * 2
        + [("2", D2, None, 404), ("2", D2, 3, 200)]
        + [("3", D2, None, None), ("9", D3, None, None), (None, D2, None, None)],
        key=repr,
    )


def bucketed(spark, database, rows, keys, most=1000, buckets=4):
    raw, wanted = table_name(database, "raw"), table_name(database, "wanted")
    for part in rows:
        part = part.withColumn("endpoint", F.lit("shotmap")).select(REPLIES.names)
        land_bucketed(part, raw, buckets, hot_replies(part, most))
    bucket_keys(keys, wanted, "shotmap", raw, buckets)
    return lookup(spark, wanted, raw, "shotmap")


def test_bucketed_lookup_moves_nothing(spark, database, replies):
    rows = replies(*[(str(n), 200, shot(n)) for n in range(200)])
    keys = rows.select("key", "ds").where("key < '5'")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        found = bucketed(spark, database, [rows], keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert len(scans) == 2 and all("SelectedBucketsCount" in line or "Bucketed: true" in line for line in scans)
        assert "part" in plan.split("PartitionFilters: ")[1]
        assert found.count() == keys.count()


@pytest.mark.parametrize("most", [1000, 3])
def test_bucketed_lookup(spark, database, replies, most):
    """As by ``for_keys``; with few replies to a slot, key 7 is dealt out and slots are empty."""
    first = replies(("1", 200, shot(1, 2)), ("2", 404, None), ("2", 200, shot(3)), ("9", 200, shot(9)))
    hot = replies(*[("7", 200, shot(n % 5)) for n in range(40)], *[("8", 200, shot(n)) for n in range(2)])
    keys = spark.createDataFrame(
        [("1", D2), ("1", D2), ("2", D2), ("3", D2), ("9", D3), (None, D2), ("7", D2), ("7", D3), ("8", D2)],
        "key STRING, ds STRING",
    )
    found = bucketed(spark, database, [first, hot, hot.limit(1)], keys, most)
    wanted = for_keys(first.unionByName(hot).unionByName(hot.limit(1)), keys)
    assert sorted(found.collect(), key=repr) == sorted(wanted.select(found.columns).collect(), key=repr)
    held = spark.table(table_name(database, "raw")).where("key = '7'").select("slot").distinct().count()
    assert (held > 1) == (most == 3)


def test_fetch(spark):
    def fetch(endpoint, key, headers):
        if key == "broken":
            raise TimeoutError
        return (200, json.dumps({endpoint: [{"id": 1, "agent": headers["User-Agent"]}]})) if key > "b" else (403, "no")

    keys = spark.createDataFrame([("a", D1), ("broken", D1), ("x", D2)], "key STRING, ds STRING")
    got = fetch_replies(keys, "shotmap", fetch, {"User-Agent": "ua"}, pause=0.01, connections=2)
    assert got.schema == REPLIES
    rows = endpoints.shotmap(got, struct_of(id=LONG, agent=TEXT)).collect()
    assert sorted((r.match_id, r.ds, r.status_code, r.agent) for r in rows if r.status_code) == [
        ("a", D1, 403, None),
        ("x", D2, 200, "ua"),
    ]
    assert [r.match_id for r in rows if r.status_code is None] == ["broken"]


def feed(number, ds, sport="Football", custom="c"):
    """Replies of one match for all endpoints but the match list."""
    bodies = {
        "shotmap": {"shotmap": [{"id": number}, {"id": number}]},
        "match_incident": {"incidents": [{"id": number}]},
        "match_lineups": {
            "home": {
                "players": [
                    {"player": {"id": 1}, "statistics": {}, "shirtNumber": 1, "jerseyNumber": "1",
                     "position": "G", "substitute": False}
                ]
            }
        },
        "match_manager": {"homeManager": {"id": 1}},
        "match_statistics": {"statistics": []},
        "match_summary": {"bestHomeTeamPlayers": [{"label": "x"}], "bestAwayTeamPlayers": []},
    }
    return [(name, str(number), 200, json.dumps(body), ds) for name, body in bodies.items()]


def match(number, sport="Football", custom="c"):
    category = {"sport": {"name": sport}}
    return {"id": number, "customId": custom, "tournament": {"category": category}}


@pytest.mark.parametrize("write", ["replace", "append"])
def test_run_days(spark, database, write, tmp_path):
    def listed(ds, *matches):
        return ("matchday", ds, 200, json.dumps({"events": list(matches)}), ds)

    rows = [
        listed(D1, match(1), match(2, custom="d"), match(3, "Tennis")),
        *feed(1, D1),
        *feed(3, D1),
        ("match_event", "c", 200, '{"events": [{"id": 7}]}', D1),
        ("matchday", D2, 503, None, D2),
        listed(D3, match(4)),
        *feed(4, D3),
    ]
    folder = str(tmp_path / "landing")
    land(spark.createDataFrame(rows, REPLIES), folder)
    raw = read_replies(spark, folder)
    audit = run_days(raw, database, D1, D2, write=write)
    counts = {(r.table_name, r.ds): (r.rows, r.reason) for r in audit.collect()}
    # Match 2 has no replies at all: one error row everywhere.
    rows_of = dict.fromkeys(TABLES, 2) | {"shotmap": 3, "match_statistics": 1}
    first = {(name, D1): (n, None) for name, n in rows_of.items()}
    second = {(name, D2): (0, "no match list") for name in TABLES} | {("matchday", D2): (0, "status 503")}
    assert counts == first | second
    again = run_days(raw, database, D1, D3, write=write)
    total = {(r.table_name, r.ds): r.rows for r in again.collect()}
    # What this run has written, whatever the table held before.
    assert total["shotmap", D1] == 3 and total["shotmap", D3] == 2
    factor = 2 if write == "append" else 1
    assert spark.table(f"{database}.shotmap").where(F.col("ds") == D1).count() == 3 * factor
    unseen = run_days(raw, database, "2001-01-01", "2001-01-02", write=write).collect()
    assert len(unseen) == 2 * len(TABLES)
    assert {(r.table_name == "matchday", r.rows, r.reason) for r in unseen} == {
        (True, 0, "no reply"), (False, 0, "no match list"),
    }
    assert {row.tableName for row in spark.sql(f"SHOW TABLES IN {database}").collect()} == set(TABLES)
    assert again.where("seconds > 0").count() > 0
    with pytest.raises(ValueError):
        run_days(raw, database, D1, D1, write="merge")


def test_events_are_looked_up_once(spark, database, tmp_path):
    """Matches of one custom id do not multiply its events."""
    matches = [match(n, custom="same") for n in range(30)]
    events = json.dumps({"events": [{"id": n} for n in range(20)]})
    rows = [
        ("matchday", D1, 200, json.dumps({"events": matches}), D1),
        ("match_event", "same", 200, events, D1),
    ]
    run_days(spark.createDataFrame(rows, REPLIES), database, D1, D1)
    assert spark.table(f"{database}.match_event").count() == 20


def test_failed_frame_loses_nothing(spark, target):
    """Rows are made before any day goes."""
    rows = spark.createDataFrame([(1, D1), (2, D2)], "a INT, ds STRING")
    replace_range(rows, target, D1, D2)
    broken = rows.withColumn("a", F.when(F.col("ds") == D2, F.raise_error("no")).otherwise(F.col("a")))
    for frame in (broken, rows.withColumn("new", F.lit(1))):
        with pytest.raises(Exception, match="no"):
            replace_range(frame.select(F.col("a").cast("int").alias("a"), *frame.columns[1:]), target, D1, D2)
        assert counted(spark, target) == {D1: 1, D2: 1}
    assert replace_range(rows.where(F.col("ds") == D2), target, D1, D2) == {D2: 1}
    assert counted(spark, target) == {D2: 1}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_shapes_drift(spark, target):
    first = spark.createDataFrame([(1, "x", D1)], "a INT, x STRING, ds STRING")
    append(first, target, residue="more")
    append(first.drop("x"), target, residue="more")
    append(first.withColumns({"y": F.lit(5), "z": F.lit("t")}), target, residue="more")
    found = spark.table(target).select("a", "x", F.to_json("more").alias("more")).collect()
    assert sorted(found, key=repr) == sorted(
        [(1, "x", None), (1, None, None), (1, "x", '{"y":5,"z":"t"}')], key=repr
    )


def test_new_columns_are_named(spark, target):
    first = spark.createDataFrame([(1, D1)], "a INT, ds STRING")
    append(first, target)
    with pytest.raises(ValueError, match="no column for y"):
        append(first.withColumn("y", F.lit(1)), target)
    append(first.withColumn("y", F.lit(1)), target, extra="drop")
    assert counted(spark, target) == {D1: 2}


def test_requests_are_spread(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"), F.lit(D1).alias("ds")).coalesce(1)
    for connections, tasks in ((None, spark.sparkContext.defaultParallelism), (3, 3)):
        sent = fetch_replies(keys, "shotmap", lambda *_: (200, "{}"), pause=0, connections=connections)
        assert sent.select(F.spark_partition_id()).distinct().count() == tasks


def test_crawl(spark, database, tmp_path):
    """A whole crawl from a stand-in feed, done twice."""

    lists = {ds: {"events": [match(int(ds[-2:])), match(50, "Tennis")]} for ds in (D1, D3)}
    details = {(name, str(n)): body for n in (1, 3) for name, _, _, body, _ in feed(n, "")}

    def fetch(endpoint, key, headers):
        if endpoint == "matchday":
            return (200, json.dumps(lists[key])) if key in lists else (503, "busy")
        if endpoint == "match_event":
            return 200, json.dumps({"events": [{"id": 1}, {"id": 2}]})
        if endpoint == "match_manager":
            raise TimeoutError
        return 200, details[endpoint, key]

    manager = {"match_manager": {"record": struct_of(homeManager=struct_of(id=LONG))}}
    for _ in range(2):
        audit = crawl_days(
            spark, fetch, str(tmp_path / "landing"), database, D1, D3, {"User-Agent": "ua"},
            pause=0, connections=2, options=manager,
        )
    counts = {(r.table_name, r.ds): (r.rows, r.reason) for r in audit.collect()}
    assert counts["matchday", D2] == (0, "status 503")
    for ds in (D1, D3):
        assert {name: counts[name, ds][0] for name in TABLES if (name, ds) in counts} == {
            "matchday": 1, "shotmap": 2, "match_event": 2, "match_incident": 1,
            "match_lineups": 1, "match_manager": 1, "match_statistics": 0, "match_summary": 1,
        }
    assert spark.table(f"{database}.match_manager").where("status_code IS NULL").count() == 2
    one = run_day(read_replies(spark, str(tmp_path / "landing")), database, D1, options=manager)
    assert {row.ds for row in one.collect()} == {D1}


def test_incremental(spark, tmp_path):
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    store = Store(spark, str(tmp_path / "store"))
    seen = []

    def build(df):
        seen.append({r.key for r in df.select("key").collect()})
        return endpoints.shotmap(df, struct_of(id=INT))

    def step(*rows, **more):
        land(spark.createDataFrame(list(rows), REPLIES), landing)
        take_in(spark, landing, "shotmap", build, store, "shotmap", progress, **more)

    def found(**more):
        return sorted((r.ds, r.match_id, r.id) for r in latest(store, "shotmap", **more).collect())

    step(("shotmap", "1", 200, shot(1, 2), D1), ("other", "1", 200, "{}", D1))
    assert found() == [(D1, "1", 1), (D1, "1", 2)]
    step(("shotmap", "2", 404, None, D1), ("shotmap", "3", 200, shot(5), D2), ("shotmap", "1", 200, shot(9), D2))
    first = [(D1, "1", 1), (D1, "1", 2), (D1, "2", None), (D2, "1", 9), (D2, "3", 5)]
    assert found() == first
    # Two replies of one landing count together, and an answer without rows puts out older ones.
    step(("shotmap", "1", 200, shot(3), D1), ("shotmap", "1", 200, shot(4), D1), ("shotmap", "3", 200, shot(), D2))
    after = [(D1, "1", 3), (D1, "1", 4), (D1, "2", None), (D2, "1", 9)]
    assert found() == after and found(version=2) == first
    assert found(first=D2, last=D2) == [(D2, "1", 9)]
    # A batch has the keys that landed, and no other.
    assert seen == [{"1"}, {"1", "2", "3"}, {"1", "3"}]
    take_in(spark, landing, "shotmap", build, store, "shotmap", progress)
    assert len(seen) == 3 and store.versions() == [1, 2, 3]
    fold(store, "shotmap")
    assert found() == after and len(store.state().tables["shotmap"].live()) == 1
    step(("shotmap", "2", 200, shot(7), D1))
    assert found() == [(D1, "1", 3), (D1, "1", 4), (D1, "2", 7), (D2, "1", 9)]
    # A second stream over the same files, in small batches, comes to the same rows.
    other = Store(spark, str(tmp_path / "other"))
    take_in(spark, landing, "shotmap", build, other, "shotmap", str(tmp_path / "again"), files_per_batch=1)
    assert sorted((r.ds, r.match_id, r.id) for r in latest(other, "shotmap").collect()) == found()


def test_landings_in_any_order(spark, tmp_path):
    """Files of a later landing may be taken in first, or together with those of an earlier one."""
    rows = [
        ("shotmap", "1", 200, shot(1), D1, 10),
        ("shotmap", "1", 200, shot(2), D1, 30),
        ("shotmap", "1", 200, shot(3), D1, 20),
        ("shotmap", "2", 200, shot(4), D1, None),
        ("shotmap", None, 200, shot(5), D1, 10),
    ]
    for n, order in enumerate(([0, 1, 2, 3, 4], [1, 0, 2, 4, 3], [[0, 1, 2, 3, 4]], [[1, 3], [0, 2, 4]])):
        folder = tmp_path / f"order-{n}"
        store = Store(spark, str(folder / "store"))
        for part in order:
            some = [rows[i] for i in (part if isinstance(part, list) else [part])]
            spark.createDataFrame(some, LANDED).coalesce(1).write.mode("append").parquet(str(folder / "landing"))
            take_in(
                spark, str(folder / "landing"), "shotmap", lambda df: endpoints.shotmap(df, struct_of(id=INT)),
                store, "shotmap", str(folder / "progress"),
            )
        found = {(r.match_id, r.id) for r in latest(store, "shotmap").collect()}
        assert found == {("1", 2), ("2", 4), (None, 5)}


def test_a_batch_that_is_tried_again(spark, tmp_path, monkeypatch):
    """The commit is done but the stream has not noted it: the batch is not put in twice."""
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    store = Store(spark, str(tmp_path / "store"))
    land(spark.createDataFrame([("shotmap", "1", 200, shot(1, 2), D1)], REPLIES), landing)
    commit = Store.commit

    def lost(self, *args, **more):
        commit(self, *args, **more)
        raise RuntimeError("lost")

    def again():
        take_in(
            spark, landing, "shotmap", lambda df: endpoints.shotmap(df, struct_of(id=INT)), store, "shotmap", progress
        )

    monkeypatch.setattr(Store, "commit", lost)
    with pytest.raises(Exception, match="lost"):
        again()
    monkeypatch.undo()
    again()
    assert store.versions() == [1]
    assert [r.id for r in latest(store, "shotmap").orderBy("id").collect()] == [1, 2]


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second
    df = checkpointed(spark.range(5))
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().analyzed().toString()

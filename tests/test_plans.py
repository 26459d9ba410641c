"""What the plans look like, and whether they hold up with one hot key."""

import json

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from kickflow.operators import endpoints
from kickflow.oracles import ORACLES
from kickflow.queries import QUERIES
from kickflow.schemas import INT, LONG, REAL, TEXT, struct_of
from kickflow.session import stored
from kickflow.sources import derived
from kickflow.sources.replies import for_keys, land, of_endpoint, read_replies

SF_DIR = "/root/testdata/sf0.001"
SHOT = struct_of(id=INT, xg=REAL, player=struct_of(id=LONG, flag=TEXT))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "matchday_football", "shotmap", "match_event", "match_incident", "match_lineups",
        "match_manager", "match_statistics", "match_summary", "keyed_lookup", "null_fill",
    ],
)
def test_stays_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landed") / "replies")
    land(derived.line_replies(spark, SF_DIR, ["shotmap"], derived.month()), folder)
    return read_replies(spark, folder)


def test_days_and_endpoint_prune_partitions(landed):
    df = endpoints.shotmap(of_endpoint(landed, "shotmap", "1998-01-01", "1998-03-01"), SHOT)
    scan = next(line for line in plan_of(df).splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters: ")[1]
    assert "ds" in filters and "endpoint" in filters
    assert "Exchange" not in plan_of(df)


def test_lookup_leaves_bodies_in_place(landed):
    """Few keys are sent to the replies, so no exchange has bodies or all reply keys."""
    keys, _ = stored(landed.select("key", "ds").where(F.col("ds") == "1998-01-01").distinct(), "keys")
    plan = plan_of(for_keys(of_endpoint(landed, "shotmap"), keys))
    inner, anti = plan[: plan.index("LeftAnti")], plan[plan.index("LeftAnti") :]
    assert "BroadcastHashJoin" in inner and "SortMergeJoin" not in inner.split("Union")[0]
    scans = [line for line in anti.splitlines() if "FileScan" in line]
    assert scans and not any("body" in line for line in scans)
    # What is exchanged in the anti part has met the keys.
    assert "LeftSemi, BuildRight" in anti


def test_status_filter_and_columns_reach_the_scan(landed):
    df = endpoints.matchday_audit(of_endpoint(landed, "shotmap")).select("ds", "status_code")
    scan = next(line for line in plan_of(df).splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<status_code:int>" in scan


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """The small tables with one order, one customer and one day holding most rows."""
    folder = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for name in ("customer", "nation"):
        con.execute(f"COPY (SELECT * FROM '{SF_DIR}/{name}.parquet') TO '{folder}/{name}.parquet'")
    con.execute(f"""
        COPY (SELECT * FROM '{SF_DIR}/orders.parquet' UNION ALL
              SELECT 1000000 + i, 7, 'F', 50000.0, TIMESTAMP '1997-05-05', '5-LOW'
              FROM range(12000) t(i)) TO '{folder}/orders.parquet'
    """)
    con.execute(f"""
        COPY (SELECT * FROM '{SF_DIR}/lineitem.parquet' UNION ALL
              SELECT 1000000, 5, 5, 1, 1.0, 1.0, 0.5, 0.5, 'A', 'F', TIMESTAMP '1997-05-05'
              FROM range(60000) t(i) UNION ALL
              SELECT 1000001, i % 50, i % 7, 1 + i % 6, i % 40, i, 0.5, 0.1,
                     CASE WHEN i % 5 = 0 THEN 'R' ELSE 'A' END,
                     CASE WHEN i % 3 = 0 THEN 'O' ELSE 'F' END, TIMESTAMP '1997-05-05'
              FROM range(13000) t(i)) TO '{folder}/lineitem.parquet'
    """)
    return str(folder)


def test_pages_bound_the_reply_of_a_hot_key(spark, hot_dir):
    replies = derived.line_replies(spark, hot_dir, ["shotmap"]).where("key = '1000000'")
    sizes = [row.n for row in replies.select(F.expr("json_array_length(get_json_object(body, '$.shotmap'))").alias("n")).collect()]
    assert sum(sizes) == 60000 and len(sizes) == 12
    assert max(sizes) < 1.2 * derived.PAGE_RECORDS
    days = derived.matchday_replies(spark, hot_dir).where("ds = '1997-05-05'")
    assert days.count() >= 3
    events = derived.event_replies(spark, hot_dir).where("key = '7'")
    assert events.count() >= 3


def test_hot_key_is_split_before_grouping(spark, hot_dir):
    """No task gets all lines of the hot order, and its pages stay spread."""
    replies = derived.line_replies(spark, hot_dir, ["shotmap"])
    plan = plan_of(replies)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(o_orderkey" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = replies.where("key = '1000000'").groupBy(F.spark_partition_id().alias("task"))
        assert tasks.count().count() == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("name", ["shotmap", "match_event", "matchday_football", "match_incident", "match_statistics", "match_summary", "match_lineups", "match_lineups_both", "match_lineups_bad", "match_lineups_skip"])
def test_hot_results_are_whole(spark, hot_dir, name):
    """Several replies of one order give the rows of one."""
    con = duckdb.connect()
    for table in ("orders", "lineitem", "customer", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{hot_dir}/{table}.parquet'")
    assert difference(QUERIES[name](spark, hot_dir), ORACLES[name], con) is None


def test_one_pass_over_the_lines(spark):
    """All endpoints of the line items are made of one grouping."""
    plan = plan_of(derived.line_replies(spark, SF_DIR, list(derived.SHAPES)))
    lines = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(lines) == 1


def test_long_reply_is_read_whole(spark, replies):
    body = json.dumps({"shotmap": [{"id": n} for n in range(100_000)] + [None]})
    rows = endpoints.shotmap(replies(("k", 200, body)), struct_of(id=INT))
    assert rows.agg(F.count("id"), F.count("*"), F.max("id")).first() == (100_000, 100_001, 99_999)

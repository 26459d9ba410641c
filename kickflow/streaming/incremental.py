"""Taking in new reply files as they land, key by key.

A batch is written as it is: the rows of its replies, and the keys it has replies of. Nothing
that is there already is read or written again. Who reads the table leaves out the rows of
a key that a later landing has answered anew, and ``fold`` writes that down now and then.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kickflow.schemas import LANDED
from kickflow.sinks.store import Store


def keys_of(table: str) -> str:
    """The table that holds which keys were answered, and when the answer landed."""
    return f"{table}_keys"


def take_in(
    spark: SparkSession,
    landing: str,
    endpoint: str,
    build: Callable[[DataFrame], DataFrame],
    store: Store,
    table: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Process the reply files that are new since the last call, then stop.

    A batch is one commit to the store, of rows and keys together, and is put in once however
    often it is tried. All replies of a key that landed together count together, even if they
    come in several batches; of several landings the latest counts, in whichever order they
    are taken in, and also if it gives no rows.
    """
    stream = spark.readStream.schema(LANDED)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    new = stream.parquet(landing).where(F.col("endpoint") == endpoint)

    def put_in(batch: DataFrame, batch_id: int) -> None:
        # Of this stream; another checkpoint begins another one.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if store.state().batches.get(query, -1) >= batch_id:
            return
        replies = batch.withColumn("landed", F.coalesce("landed", F.lit(0)))
        span = replies.agg(F.min("landed").alias("first"), F.max("landed").alias("last")).first()
        if span["last"] is None:
            return
        keys = replies.groupBy("key", "ds").agg(F.max("landed").alias("landed"))
        if span["first"] != span["last"]:
            old = _outdated(replies.select("key", "ds", "landed").distinct())
            replies = replies.join(old.drop("newest"), ["key", "ds", "landed"], "left_anti")
        rows = build(replies.select("key", "ds", "status_code", "body"))
        run = f"{query}-{batch_id}"
        staged = [
            store.stage(table, rows, extra="add", run=run),
            store.stage(keys_of(table), keys, key="key", run=run),
        ]
        store.commit(staged, append=True, batch=(query, batch_id))

    (
        new.writeStream.foreachBatch(put_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _outdated(keys: DataFrame) -> DataFrame:
    each = Window.partitionBy("key", "ds")
    return keys.withColumn("newest", F.max("landed").over(each)).where("landed < newest")


def latest(
    store: Store,
    table: str,
    key: str | Column = "match_id",
    first: str | None = None,
    last: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """The rows of each key's latest landing; ``key`` tells a row's key.

    Only what is outdated meets the rows. Rows without a key are never outdated.
    """
    version = store.state().version if version is None else version
    key = F.col(key) if isinstance(key, str) else key
    old = _outdated(store.read(keys_of(table), first, last, version, runs=True))
    old = old.select(F.col("key").alias("_key"), F.col("ds").alias("_ds"), F.col("run").alias("_run"))
    rows = store.read(table, first, last, version, runs=True)
    outdated = (key == F.col("_key")) & (F.col("ds") == F.col("_ds")) & (F.col("run") == F.col("_run"))
    return rows.join(old, outdated, "left_anti").drop("run")


def fold(store: Store, table: str, key: str | Column = "match_id", num_out: int | None = None) -> int:
    """Write the latest rows and keys anew as one run, so that readers have nothing to leave out.

    Fails with a ``Conflict`` if a batch comes in meanwhile; nothing has changed then.
    """
    version, run = store.state().version, uuid.uuid4().hex
    rows = latest(store, table, key, version=version)
    keys = store.read(keys_of(table), version=version).groupBy("key", "ds").agg(F.max("landed").alias("landed"))
    staged = [
        store.stage(table, rows, num_out=num_out, run=run),
        store.stage(keys_of(table), keys, num_out=num_out, key="key", run=run),
    ]
    return store.commit(staged, since=version)

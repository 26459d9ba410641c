"""Live replies: one request per key, sent from the tasks that hold the keys."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from kickflow.schemas import REPLIES

Fetch = Callable[[str, str, Mapping[str, str]], tuple[int, str]]

ARROW_REPLIES = pa.schema(
    [
        ("endpoint", pa.string()),
        ("key", pa.string()),
        ("status_code", pa.int32()),
        ("body", pa.string()),
        ("ds", pa.string()),
    ]
)
ROWS_PER_BATCH = 100


def fetch_replies(
    keys: DataFrame,
    endpoint: str,
    fetch: Fetch,
    headers: Mapping[str, str] | None = None,
    pause: float = 1.0,
    connections: int | None = None,
) -> DataFrame:
    """Reply rows for ``keys`` (``key, ds``); an exception gives a NULL status.

    ``fetch(endpoint, key, headers)`` returns status and body. ``connections`` is
    the number of tasks that send requests, each waiting ``pause`` seconds after
    every request; by default as many as the cluster runs at once. Land the result
    once: reading it again sends the requests again.
    """
    sent = dict(headers or {})

    def ask(key: str, ds: str) -> dict:
        try:
            status, body = fetch(endpoint, key, sent)
        except Exception:
            status, body = None, None
        time.sleep(pause)
        return dict(endpoint=endpoint, key=key, status_code=status, body=body, ds=ds)

    def ask_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH).to_pylist()
                rows = [ask(row["key"], row["ds"]) for row in part]
                yield pa.RecordBatch.from_pylist(rows, schema=ARROW_REPLIES)

    tasks = connections or keys.sparkSession.sparkContext.defaultParallelism
    return keys.select("key", "ds").repartition(tasks).mapInArrow(ask_all, REPLIES)

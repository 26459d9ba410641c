"""Session settings, and the shared folder that written results go to."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange for the next step.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build(app_name: str = "kickflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else has built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="kickflow-")
    return f"{base.rstrip('/')}/kickflow/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder, and the path; its size is then known to Spark."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` has written, wherever the shared folder is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_lock = Lock()
_open: Counter = Counter()
_before: dict[str, str | None] = {}


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A runtime setting for as long as some thread is in the block, then what it was before."""
    with _lock:
        if not _open[name]:
            _before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)
        _open[name] += 1
    try:
        yield
    finally:
        with _lock:
            _open[name] -= 1
            if not _open[name]:
                before = _before.pop(name)
                spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that a lost executor costs no rerun."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoint"))
    return df.checkpoint()

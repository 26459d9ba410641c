"""One job: read, transform, export, with a policy for empty input."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from kickflow.sinks.tables import append, table_name

log = logging.getLogger(__name__)

DONE = "done"
SKIPPED = "skipped"


class EmptyInput(Exception):
    """The job read nothing and was not told to skip."""


@dataclass(frozen=True)
class JobConfig:
    source_id: str
    in_file: str
    ds: str
    params: Mapping[str, Any] = field(default_factory=dict)
    num_in_partition: int = 10
    num_out_partition: int | None = None

    @property
    def in_path(self) -> str | None:
        return self.params.get("in_path")

    @property
    def skip_empty(self) -> bool:
        return self.params.get("skip_empty", False)

    @property
    def identity(self) -> str:
        return f"{self.source_id}/{self.in_file} of {self.ds}"


def run_job(
    config: JobConfig,
    read: Callable[[], DataFrame | None],
    etl: Callable[[DataFrame], DataFrame],
    export: Callable[[DataFrame], None],
    before_read: Callable[[], None] | None = None,
    before_export: Callable[[DataFrame], None] | None = None,
    no_rows_is_empty: bool = False,
) -> str:
    """Run the steps in order and return ``done`` or ``skipped``.

    ``export`` gets ``num_out_partition`` partitions if the job has that number, else as
    many as there are. A sink that deals rows out by itself has to be given the number too
    (``table_export`` does).
    """
    start = time.monotonic()
    log.info("%s: reading its input", config.identity)
    if before_read:
        before_read()
    df = read()
    if df is None or (no_rows_is_empty and df.isEmpty()):
        log.info("%s: there is no input", config.identity)
        if config.skip_empty:
            return SKIPPED
        raise EmptyInput(config.identity)
    df = df.transform(etl)
    if config.num_out_partition:
        df = df.repartition(config.num_out_partition)
    log.info("%s: writing its output", config.identity)
    if before_export:
        before_export(df)
    export(df)
    log.info("%s: finished after %.3f s", config.identity, time.monotonic() - start)
    return DONE


def table_export(config: JobConfig, **more: Any) -> Callable[[DataFrame], None]:
    """The export that appends to the job's table, in as many files as the job asks for."""
    table = table_name(config.source_id, config.in_file)

    def export(df: DataFrame) -> None:
        append(df, table, num_out=config.num_out_partition, **more)

    return export

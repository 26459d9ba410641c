"""Input files of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kickflow.plans.job import JobConfig


def read_files(
    spark: SparkSession,
    config: JobConfig,
    schema: T.StructType,
    file_format: str = "json",
    repartition: bool = False,
) -> DataFrame:
    """The files below ``in_path``; splits come from file sizes unless asked otherwise."""
    df = spark.read.schema(schema).format(file_format).load(config.in_path)
    return df.repartition(config.num_in_partition) if repartition else df

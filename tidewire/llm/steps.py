"""Stored steps of an operator, and tables small enough to broadcast."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step to the shared folder and read it back: its lineage ends there."""
    return step(df, purpose)[0]


def step(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """As :func:`store`, with the path, for steps that are removed once others have replaced them.

    The driver's memory is collected twice, first the plan and then what it held, so that Spark's
    cleaner drops the shuffle files the step was made from before the next one writes its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    schema = df.schema
    df.write.parquet(path)
    del df
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    return spark.read.schema(schema).parquet(path), path


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Ask for a broadcast after counting; a larger table is left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free_name(names: list[str], wanted: str) -> str:
    """``wanted``, lengthened by underscores until no column of ``names`` has it."""
    while wanted in names:
        wanted += "_"
    return wanted

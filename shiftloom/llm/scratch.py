"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shiftloom.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage: later jobs read files every executor can see, so a lost
    executor costs no more than its own tasks.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

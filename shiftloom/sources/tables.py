"""Tables from files, the catalog, a warehouse or rows passed by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def read_table(
    spark: SparkSession, source: str, columns: Sequence[str | Column] | None = None, where: Column | str | None = None
) -> DataFrame:
    """Rows of a Parquet path or of a catalog table. Column choice and filter reach the scan.

    An error is raised, never turned into an empty result.
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*columns)


def read_warehouse(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    splits: int = 64,
    small: bool = False,
    **options: str,
) -> DataFrame:
    """A warehouse table over JDBC, read in parallel ranges of ``split_column``.

    Without a split the whole table comes through one task; that has to be asked for
    with ``small``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=str(splits)
        )
    elif not small:
        raise ValueError(f"name a split column and its bounds for {table}, or say that it is small")
    return reader.options(**options).load()


def inline(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str] | str) -> DataFrame:
    """Rows handed over by the caller; ``columns`` is a list of names or a schema text."""
    if not rows:
        raise ValueError("rows are missing")
    return spark.createDataFrame([tuple(r) for r in rows], columns if isinstance(columns, str) else list(columns))

"""Running sums over one order of all rows.

A window without a partition would bring all rows into one task. Here rows are dealt
into ranges of the order, each range sums its own rows, and every range then adds what
the ranges before it hold: one number for each range, of which there are as many as
``parts`` says, whatever the number of rows.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.session import scratch_path

# Sums are exact, so that neither the ranges nor the order of addition can be seen in them.
EXACT = "decimal(38,10)"


def running_sums(df: DataFrame, order: list[Column], value: str, running: str, total: str, parts: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` up to each row in ``order``, itself included, and of all rows.

    ``value`` is a number column; nulls, NaN and infinities count as nothing, and doubles as
    decimals of ten places. ``order`` has to be unique for a result that does not depend on
    the run: rows that are equal in it follow each other in any order, in one range. Both
    sums are decimals; where no row counts they are 0, and an empty ``df`` gives no rows.
    ``parts`` is the number of ranges, ``spark.sql.shuffle.partitions`` by default.

    The ranges are written to the scratch folder first: their bounds come from a sample,
    and offsets must belong to the ranges that the rows are in. The driver gets one sum for each range.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    amount = F.coalesce(F.col(value).try_cast(EXACT), F.lit(Decimal(0)).cast(EXACT))
    ranged = df.repartitionByRange(parts, *order).withColumns({"_part": F.spark_partition_id(), "_amount": amount})
    path = scratch_path(spark, "ranges")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)

    sums = {r["_part"]: r["_sum"] for r in ranged.groupBy("_part").agg(F.sum("_amount").alias("_sum")).collect()}
    before, offsets = Decimal(0), []
    with localcontext(prec=50):
        for part in range(max(sums, default=-1) + 1):
            offsets.append(f"{before:f}")
            before += sums.get(part, Decimal(0))
    offset = F.lit(offsets or ["0"]).cast(f"array<{EXACT}>")[F.col("_part")]
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.withColumns(
        {
            running: (offset + F.sum("_amount").over(within)).cast(EXACT),
            total: F.lit(f"{before:f}").cast(EXACT),
        }
    ).drop("_part", "_amount")

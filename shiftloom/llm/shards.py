"""Shards of near equal size: minimax contiguous partition of ordered atomic groups.

Groups (equal texts) are ordered by a hash and cut into contiguous shards so that the
largest shard is as small as it can be. The smallest feasible capacity is found by search:
a capacity is feasible if filling shards greedily, each as far as it allows, needs no more
shards than there are. Greedy filling only asks where running sizes reach a bound, so many
capacities are tried at once, each shard's bounds in one aggregate over the groups.

Running sizes and slots never use a window over all rows: groups fall into bins of
neighbouring hashes, a bin's rows are numbered by themselves, and only one row for each
bin (``BINS`` at most) is added up in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftloom.llm.scratch import stored

BINS = 4096  # of neighbouring hashes
PARTS = 64  # of each bin's rows, by id, so that a hot group is not one task's
TRIES = 48  # capacities tried at once


def shards(docs: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1; a null text counts as empty. Documents with
    equal texts share a shard. law is 'bytes'; slot numbers the rows of a shard from 0 in
    the order of the groups; grown_shard is null, as the law is not 'key'. Null and
    repeated ids are kept. Other columns are left out. An empty table has no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("group"),
    )
    rows = stored(rows.withColumns({"bin": _bin(F.col("group")), "part": _part(F.col("id"))}), "rows")
    # a hot group's rows are added up before they meet
    groups = rows.groupBy("bin", "group").agg(F.sum("size").alias("size"))
    ends = stored(running(groups), "groups")
    cuts = smallest(ends, n)
    # a shard holds the groups that end after the cut before it, up to its own
    shard = sum((F.when(F.col("stop") > cut, 1).otherwise(0) for cut in cuts[:-1]), F.lit(0))
    # every group of a bin goes to one shard, unless a cut is inside the bin: few rows differ
    placed = rows.join(ends.select("group", shard.alias("shard")), "group")
    return numbered(placed).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _bin(group: Column) -> Column:
    return F.conv(F.substring(group, 1, 3), 16, 10).cast("int")


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def running(groups: DataFrame) -> DataFrame:
    """group and stop: the sizes of all groups up to this one, in the order of (bin, group)."""
    bins = groups.groupBy("bin").agg(F.sum("size").alias("total"))
    before = F.sum("total").over(W.orderBy("bin")) - F.col("total")
    bins = bins.select("bin", before.alias("before"))
    inside = F.sum("size").over(W.partitionBy("bin").orderBy("group"))
    own = groups.withColumn("inside", inside)
    return own.join(bins, "bin").select("group", (F.col("before") + F.col("inside")).alias("stop"), "size")


def smallest(ends: DataFrame, n: int) -> list[int]:
    """Where the n shards of the smallest feasible capacity stop."""
    total, largest = ends.agg(F.max("stop"), F.max("size")).first()
    if total is None:
        return [0] * n
    # no capacity below the mean, or below a group, is feasible; the mean plus a group is
    low, high = max(-(-total // n), largest), -(-total // n) + largest
    best = None
    while best is None or low < high:
        step = max(1, -(-(high - low) // TRIES))
        tries = sorted({min(low + step * k, high) for k in range(TRIES + 1)})
        found = filled(ends, tries, n)
        at = next(k for k, cuts in enumerate(found) if cuts[-1] >= total)
        best = found[at]
        low, high = (tries[at - 1] + 1 if at else tries[0]), tries[at]
    return best


def filled(ends: DataFrame, capacities: list[int], n: int) -> list[list[int]]:
    """For each capacity, where n shards stop that are filled greedily in order."""
    cuts = [[0] for _ in capacities]
    for _ in range(n):
        bounds = [own[-1] + c for own, c in zip(cuts, capacities)]
        reached = ends.agg(
            *(F.max(F.when(F.col("stop") <= b, F.col("stop"))).alias(f"c{k}") for k, b in enumerate(bounds))
        ).first()
        for own, stop in zip(cuts, reached):
            own.append(max(own[-1], stop or 0))
    return [own[1:] for own in cuts]


def numbered(placed: DataFrame) -> DataFrame:
    """The rows with slot: their number in the shard, from 0, in the order of (bin, part, group, id)."""
    piece = ["shard", "bin", "part"]
    counts = placed.groupBy(*piece).agg(F.count("*").alias("n"))
    # at most shards + BINS by PARTS rows, whatever the input
    order = W.partitionBy("shard").orderBy("bin", "part")
    counts = counts.select(*piece, (F.sum("n").over(order) - F.col("n")).alias("before"))
    own = F.row_number().over(W.partitionBy(*piece).orderBy("group", "id"))
    return placed.withColumn("own", own).join(counts, piece).withColumn("slot", F.col("before") + F.col("own") - 1)

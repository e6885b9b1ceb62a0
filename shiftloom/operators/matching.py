"""Sensors for a table of requests, by id or by free words, through an inverted index.

The rules are those of ``catalog.find_sensor``, for every request at once. No request meets
the whole catalog:

- Requests with the same words are one, and so are sensors with the same words, of which
  only the first in catalog order can win.
- A request with one known word takes the first sensor of that word, known beforehand.
- Others meet the sensors of their rarest word. That gives a score which the best sensor has
  at least. A sensor that shares ``score`` of ``k`` words shares one of the ``k - score + 1``
  rarest, so only these are looked up, and only sensors with enough words are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions.texts import word_set
from shiftloom.operators.catalog import all_sensors

SENSOR = ["var_id", "name", "device"]


def find_sensors(catalog: DataFrame, requests: DataFrame, text: str = "text") -> DataFrame:
    """The requests with ``var_id``, ``name``, ``device``, ``exact`` and ``score`` of the sensor they mean.

    An exact id wins, then most shared words, then catalog order. A request that means no
    sensor, or is null, is left out; repeated ones are each answered. The five new columns
    must not be columns of the requests.
    """
    clash = {*SENSOR, "exact", "score"} & set(requests.columns)
    if clash:
        raise ValueError(f"columns of the requests have names of the result: {sorted(clash)}")
    sensors = all_sensors(catalog).withColumns(
        {"_words": F.array_sort(word_set(F.concat_ws(" ", "name", "device"))), "_sensor": _in_order()}
    )
    asked = requests.withColumns({"_asked": F.array_sort(word_set(F.col(f"`{text}`"))), "_id": _bare_id(F.col(f"`{text}`"))})
    by_id = _by_id(asked, sensors)
    by_words = _by_words(asked.select("_asked").where(F.size("_asked") > 0).distinct(), sensors)
    met = asked.join(by_words, "_asked", "left").join(by_id, ["_id", "_asked"], "left")
    won = F.coalesce("_exact", "_best")
    return met.where(won.isNotNull()).select(
        *[F.col(f"`{c}`") for c in requests.columns],
        *[won["sensor"][c].alias(c) for c in SENSOR],
        F.col("_exact").isNotNull().alias("exact"),
        (-won["less"]).alias("score"),
    )


def _in_order() -> Column:
    """A sensor as a value that sorts in catalog order."""
    return F.struct((-F.col("is_critical")).alias("rest"), "device", "name", "var_id")


def _bare_id(text: Column) -> Column:
    return F.upper(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))


def _ranked(score: Column, sensor: Column) -> Column:
    """The best match sorts first."""
    return F.struct((-score).alias("less"), sensor.alias("sensor"))


def _by_id(asked: DataFrame, sensors: DataFrame) -> DataFrame:
    """Per id and words that are asked for, the sensor of that id."""
    wanted = asked.select("_id", "_asked").where(F.col("_id").isNotNull()).distinct()
    met = wanted.join(sensors.select(F.col("var_id").alias("_id"), "_words", "_sensor"), "_id")
    score = F.size(F.array_intersect("_asked", "_words"))
    return met.groupBy("_id", "_asked").agg(F.min(_ranked(score, F.col("_sensor"))).alias("_exact"))


def _by_words(asked: DataFrame, sensors: DataFrame) -> DataFrame:
    """Per set of words, the sensor that shares most of them."""
    kinds = sensors.groupBy("_words").agg(F.min("_sensor").alias("_sensor"))
    postings = kinds.select("_words", "_sensor", F.explode("_words").alias("_word"))
    index = postings.groupBy("_word").agg(F.count("*").alias("_n"), F.min("_sensor").alias("_sensor"))
    each = asked.select("_asked", F.explode("_asked").alias("_word")).join(index, "_word")
    rarest = F.transform(F.array_sort(F.collect_list(F.struct("_n", "_word"))), lambda w: w["_word"])
    known = each.groupBy("_asked").agg(rarest.alias("_known"), F.min("_sensor").alias("_sensor"))
    single = known.where(F.size("_known") == 1).select("_asked", _ranked(F.lit(1), F.col("_sensor")).alias("_best"))

    several = known.where(F.size("_known") > 1).drop("_sensor")
    shared = F.array_intersect("_known", "_words")
    seeds = several.withColumn("_word", F.col("_known")[0]).join(postings, "_word")
    bounds = seeds.groupBy("_asked", "_known").agg(F.max(F.size(shared)).alias("_least"))
    prefix = F.slice("_known", F.lit(1), F.size("_known") - F.col("_least") + 1)
    looked_up = bounds.withColumn("_word", F.explode(prefix)).join(postings, "_word")
    # a sensor is compared at the first word that it shares
    enough = looked_up.where(F.size("_words") >= F.col("_least")).withColumn("_shared", shared)
    enough = enough.where((F.size("_shared") >= F.col("_least")) & (F.col("_shared")[0] == F.col("_word")))
    best = enough.groupBy("_asked").agg(F.min(_ranked(F.size("_shared"), F.col("_sensor"))).alias("_best"))
    return single.unionByName(best)

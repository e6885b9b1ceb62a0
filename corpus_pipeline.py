"""From raw documents to training text: filter, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.llm import bpe, mixing, near, quality, repeats
from shiftloom.llm.queries import SIZE, domains, vocabulary
from shiftloom.llm.registry import table
from shiftloom.llm.scratch import stored

#: Shares of the tokens in the mix. Sized so that plain text is never thinned out.
TARGETS = {"plain": 0.9, "toxic": 0.1}


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 1)."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (operator 4)."""
    return near.representatives(docs, wide=5, percent=80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes, or of over 50 words, that occur again anywhere go from the texts (operator 3)."""
    return _counted(repeats.kept(docs, length=400, run=51))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says (operator 10)."""
    return mixing.drawn(docs, domains(table(spark, sf_dir, "labels")), TARGETS, SIZE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left (operator 8)."""
    return bpe.digests(docs, vocabulary("word_bpe_49k.json"))


def _counted(docs: DataFrame) -> DataFrame:
    """The documents with n_chars, where they have it, of the text they have now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality classifier", filter_quality),
    ("minhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("mixing sources to target weights", mix),
    ("bpe encoding and decoding", encode),
]

# A classifier, sketches and a tokenizer are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


#: Rows and bytes of the batches that Python workers get. Each worker holds a few batches, with
#: whole texts in several columns, so small ones bound its memory; texts longer than a batch come alone.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. Sets ``BATCHES`` for the session, as the last stage runs later."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs

"""Divergence of sources: how far each source's words are from those of its language's others.

Documents become exact sparse count vectors, over the terms of a bundle of documents: a
language keeps the terms that enough of its documents hold, with no limit on their number.
A term carries its language, so that every language has its own vocabulary. The vectors are
summed by group without making any of them dense, and pairs of groups are compared on the terms
that they hold: what neither holds adds the same for each term, and what one of them holds
adds by its count alone. Only terms that both hold are met one by one.

All arithmetic is on integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftloom.llm.scratch import stored
from shiftloom.llm.words import slices

#: What is no part of a term: all of ASCII but its letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

LARGEST = 2**31 - 1  # terms of a bundle: all that an index can number
UNIT = 1_000_000_000
CUT = "\0"  # between a term and its language; no term holds it


def audited(
    docs: DataFrame,
    least: int = 10,
    top: int = 10,
    parts: int = 1,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: two reports of each (lang, source) group.

    With p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)) of every kept term, by the group's
    counts and their sum N, and q likewise: part 'pair' has each other source of the
    language and the sum of floor((p - q)^2 / (p + q)) over all V kept terms; part 'term'
    has the ``top`` terms that the group holds more of than its language (q), by that
    value. Rank follows value, descending, then the item's bytes.

    A null text, lang or source counts as ''. Rows may repeat; each is a document. A group
    without terms is compared like any other. A language that keeps no term has pairs of
    value 0 and no terms. Texts of any length are read whole. Other columns are left out;
    an empty table has no rows.

    The terms are a table, of which neither the driver nor an executor holds all. ``parts``
    has no use any more; a vocabulary on the driver once was fitted in that many parts.
    """
    rows = docs.select(
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text")))
    )
    groups = rows.select("lang", "source").distinct()
    groups = stored(groups.withColumn("group", F.row_number().over(W.orderBy("lang", "source"))), "groups")
    counts, words = counted(rows.join(groups, ["lang", "source"]), least)
    sized = stored(sizes(groups, counts, words), "sizes")
    own = counts.join(sized, "group").withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    own = stored(own, "shares")
    return pairs(sized, own).unionByName(terms(own, words, top))


def counted(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """How often each group's documents hold each kept term (group, id, n), and the terms (lang, id, term).

    An id belongs to one term of one language. Both are stored tables.
    """
    each = rows.select("group", "lang", "text").mapInArrow(bundles, "group int, term string, n long, documents long")
    each = stored(each.groupBy("group", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")), "held")
    kept = each.groupBy("term").agg(F.sum("documents").alias("documents")).filter(F.col("documents") >= least)
    # ids are stored with their terms before anything uses them
    kept = stored(kept.select("term", F.monotonically_increasing_id().alias("id")), "kept")
    cut = F.instr("term", CUT)
    words = kept.select(F.substring("term", cut + 1, F.length("term")).alias("lang"), "id", F.substring("term", F.lit(1), cut - 1).alias("term"))
    return stored(each.join(kept, "term").select("group", "id", "n"), "counts"), stored(words, "words")


def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each text in small letters, each with its language, a bounded slice of whole texts at a time."""
    for batch in batches:
        for row, stop, _, _ in slices(batch.column("text")):
            part = batch.slice(row, stop - row)
            found = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), BETWEEN)
            term, own = pc.list_flatten(found), pc.list_parent_indices(found)
            solid = pc.greater(pc.binary_length(term), 0)
            term, own = term.filter(solid), own.filter(solid)
            term = pc.binary_join_element_wise(term, part.column("lang").take(own), CUT)
            ends = np.searchsorted(own.to_numpy(), np.arange(len(part) + 1)).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(ends), term.cast(pa.string()))
            yield pa.RecordBatch.from_arrays([part.column("group"), terms], names=["group", "terms"])


BUNDLE = 1 << 21  # terms of whole slices that are counted together


def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a group's documents of a bundle hold a term, and how many of them do."""
    group, lengths, terms = [], [], []
    for part in named(batches):
        group.append(part.column("group"))
        lengths.append(pc.list_value_length(part.column("terms")).to_numpy())
        terms.append(part.column("terms").flatten().dictionary_encode())
        if sum(map(len, terms)) >= BUNDLE:
            yield from _bundle(group, lengths, terms)
            group, lengths, terms = [], [], []
    if group:
        yield from _bundle(group, lengths, terms)


def _bundle(group: list[pa.Array], lengths: list[np.ndarray], terms: list[pa.DictionaryArray]) -> Iterator[pa.RecordBatch]:
    chunks = pa.chunked_array(terms).unify_dictionaries().chunks
    term = chunks[-1].dictionary  # that of the last chunk holds all, as far as chunks have terms
    code = np.concatenate([c.indices.to_numpy() for c in chunks]).astype(np.int64)
    if not len(code):
        return
    rows = sum(map(len, lengths))
    key, n = np.unique(np.repeat(np.arange(rows), np.concatenate(lengths)) << 31 | code, return_counts=True)
    ends = pa.array(np.searchsorted(key >> 31, np.arange(rows + 1)).astype(np.int32))
    vectors = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((key & LARGEST).astype(np.int32), n.astype(np.float64))]
    batch = pa.RecordBatch.from_arrays([pa.concat_arrays(group), *vectors], names=["group", "at", "n"])
    for part in summed(iter([batch]), documents=True):
        columns = [part.column("group"), term.take(part.column("at")), part.column("n"), part.column("documents")]
        yield pa.RecordBatch.from_arrays(columns, names=["group", "term", "n", "documents"])


ENTRIES = 1 << 19  # of vectors that are added up at once; a longer vector is taken whole


def summed(batches: Iterator[pa.RecordBatch], documents: bool = False) -> Iterator[pa.RecordBatch]:
    """Sums of the sparse vectors (group, at, n) by group and entry, a bounded slice of a batch at a time.

    With ``documents`` also the number of vectors that hold the entry."""
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(batch.column("at")), 0).to_numpy())])
        row = 0
        while row < len(batch):
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + ENTRIES, "right")) - 1)
            yield _summed(batch.slice(row, stop - row), documents)
            row = stop
        pa.default_memory_pool().release_unused()


def _summed(part: pa.RecordBatch, documents: bool) -> pa.RecordBatch:
    at, n = part.column("at"), part.column("n")
    owner = np.asarray(pc.list_parent_indices(at))
    group = part.column("group").to_numpy()[owner].astype(np.int64)
    key = group << 31 | pc.list_flatten(at).to_numpy().astype(np.int64)
    key, place = np.unique(key, return_inverse=True)
    total = np.bincount(place, pc.list_flatten(n).to_numpy(), len(key)).astype(np.int64)
    columns = [(key >> 31).astype(np.int32), (key & LARGEST).astype(np.int32), total]
    names = ["group", "at", "n"]
    if documents:
        columns.append(np.bincount(place, minlength=len(key)))
        names.append("documents")
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def sizes(groups: DataFrame, counts: DataFrame, words: DataFrame) -> DataFrame:
    """The groups with total (N), kept (V) and p0, the share of a term that the group lacks."""
    kept = words.groupBy("lang").agg(F.count("*").alias("kept"))
    total = counts.groupBy("group").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    known = (
        groups.join(total, "group", "left")
        .join(kept, "lang", "left")
        .select("group", "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"))
    )
    return known.withColumn("p0", F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept"))))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * kept)); counts of up to 18 digits stay exact."""
    wide = (n + 2).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", wide, (total + 2 * kept).cast("decimal(19,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)). Shares have ten digits at most, so that a square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def pairs(sized: DataFrame, own: DataFrame) -> DataFrame:
    """Part 'pair'. The sum over all kept terms is put together from

    - what a term adds that neither group holds, for all V terms;
    - the difference that terms make which one group holds, were they not in the other:
      it depends on the term's share only, so equal shares are counted first;
    - the difference that terms make which both hold, met once by their id. A term meets as
      many rows as its groups have pairs, which are rows of the result as well.
    """
    a, b = sized.alias("a"), sized.alias("b")
    p0, q0 = F.col("a.p0"), F.col("b.p0")
    ends = [F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("item")]
    two = (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))
    neither = a.join(b, two).select(*ends, F.coalesce(F.col("a.kept") * apart(p0, q0), F.lit(0).cast("long")).alias("value"))

    alike = own.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("m")).alias("a")
    one = alike.join(b, two).select(*ends, (F.col("a.m") * (apart(F.col("a.p"), q0) - apart(p0, q0))).alias("value"))
    one = one.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    held = own.select("lang", "source", "id", "p", "p0")
    a, b = held.alias("a"), held.alias("b")
    p, q = F.col("a.p"), F.col("b.p")
    more = apart(p, q) - apart(p, q0) - apart(p0, q) + apart(p0, q0)
    both = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.source") < F.col("b.source")))
    both = both.select(*ends, more.alias("value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def turned(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    every = neither.union(one).union(turned(one)).union(both).union(turned(both))
    return ranked(every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")


def terms(own: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """Part 'term': the terms that a group holds more of than its language, up to rank ``top``."""
    of_lang = own.groupBy("lang", "id", "kept").agg(F.sum("n").alias("n"))
    total = own.groupBy("lang").agg(F.sum("n").alias("total"))
    of_lang = of_lang.join(total, "lang").select("id", share(F.col("n"), F.col("total"), F.col("kept")).alias("q"))
    p, q = F.col("p"), F.col("q")
    found = own.join(of_lang, "id").filter(p > q).join(words.select("id", "term"), "id")
    return ranked(found.select("lang", "source", F.col("term").alias("item"), apart(p, q).alias("value")), "term", top)


def ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    out = out if top is None else out.filter(F.col("rank") <= top)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

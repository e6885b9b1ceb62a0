"""Mixing sources to target weights with soft memberships.

A labelled table teaches a classifier what domain a text belongs to; every document gets a
posterior over the domains. A rate is then fitted to each document, so that the expected
token totals of the domains, sums of rate times tokens times posterior, match the targets
with little change: projected gradient descent on the squared residuals, from rates of
one, never below zero. A step is scaled by the inverse Gram matrix of the posteriors of the
documents whose rate is not zero, so that vague posteriors need few rounds as well; where
that does not lower the residual it is shortened, and at last a plain step. A round is one
aggregate over the documents, of a few sums for each pair of domains. Only those sums leave the executors; a rate is an expression over the
document's posterior and the sums so far, so no state is kept for it.

All of it is DataFrame and SQL expressions.
"""

from __future__ import annotations

import warnings
from math import log, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.scratch import stored

BUCKETS = 1 << 15  # words are hashed to
SHORTER = (1.0, 0.5, 0.25, 0.125)  # parts of a scaled step that are tried
STALLED = 10  # rounds in which the residual has to fall by a hundredth
EVIDENCE = 4.0  # standard errors by which a word's count in a domain must differ from chance


def marked_buckets(text: Column) -> Column:
    """Distinct buckets of a text's words, after -1 less the number of words."""
    words = F.split(F.lower(F.translate(text, "\t\n\r\x0b\x0c", "     ")), " ")

    def marked(words: Column) -> Column:
        buckets = F.array_distinct(F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(BUCKETS))))
        return F.concat(F.array(-1 - F.size(words)), buckets)

    # a list of one list, so that the words are split once and used twice
    return F.transform(F.array(F.filter(words, lambda w: w != "")), marked)[0]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def labelled(labels: DataFrame, domains: list[str], sample: int, id_col: str) -> DataFrame:
    """id and domain index of at most ``sample`` labelled documents: those with the least
    hashes of their ids. Null ids and domains, others than the named, and documents with
    several are left out."""
    index = (F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1).cast("int")
    known = labels.filter(F.col(id_col).isNotNull() & F.col("domain").isin(*domains))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(index).alias("domain"), F.max(index).alias("most"))
    return known.filter("domain = most").orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "domain")


def classifier(rows: DataFrame, known: DataFrame, n: int) -> tuple[list[float], DataFrame]:
    """Log posteriors of a text without any of the words, and a table of bucket and what it
    adds for each domain, w0, w1, ...

    Naive Bayes over whether a text has the bucket's words, against how usual that is in
    all texts. What chance may explain is 0, and buckets without any other are left out.
    """
    # the sample is bounded by its parameter, so it is sent to the texts and not they to it
    held = rows.join(F.broadcast(known), "id").select("id", "domain", marked_buckets(F.col("text")).alias("buckets"))
    held = stored(held, "labelled")
    sizes = dict(held.groupBy("domain").count().collect())
    sizes = [sizes.get(d, 0) for d in range(n)]
    every = max(sum(sizes), 1)
    seen = held.select("domain", F.explode("buckets").alias("bucket")).filter("bucket >= 0").groupBy("bucket")
    seen = seen.agg(
        F.count("*").alias("total"), *(F.count(F.when(F.col("domain") == d, 1)).alias(f"n{d}") for d in range(n))
    )
    said = []
    for d, size in enumerate(sizes):
        chance = F.col("total") * (size / every)
        own, usual = (F.col(f"n{d}") + 0.5) / (size + 1.0), (F.col("total") + 0.5) / (every + 1.0)
        far = F.abs(F.col(f"n{d}") - chance) >= EVIDENCE * F.sqrt(chance + 1)
        absent = F.log((1 - own) / (1 - usual))
        said.append(F.when(far, absent).otherwise(0.0).alias(f"a{d}"))
        said.append(F.when(far, F.log(own / usual) - absent).otherwise(0.0).alias(f"w{d}"))
    told = seen.select("bucket", *said).filter(" or ".join(f"w{d} != 0" for d in range(n)))
    told = stored(told, "evidence")
    absent = told.agg(*(F.coalesce(F.sum(f"a{d}"), F.lit(0.0)) for d in range(n))).first()
    return [log((size + 1) / (every + n)) + a for size, a in zip(sizes, absent)], told


def memberships(rows: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """id, hash, rows, tokens and posteriors p0, p1, ... of the distinct (id, hash).

    Words are looked up where the text is: the table sent there has at most ``BUCKETS``
    rows. A text's evidence is added up in its own task before it is shuffled.
    """
    priors, told = classifier(rows, known, n)
    weights = [f"w{d}" for d in range(n)]
    told = told.select("bucket", *weights)
    words = rows.select("id", "hash", F.explode(marked_buckets(F.col("text"))).alias("bucket"))
    sums = words.join(F.broadcast(told), "bucket", "left").filter("bucket < 0 or w0 is not null").groupBy("id", "hash").agg(
        F.count(F.when(F.col("bucket") < 0, 1)).alias("rows"),
        F.max(-1 - F.col("bucket")).cast("long").alias("tokens"),
        *(F.coalesce(F.sum(w), F.lit(0.0)).alias(w) for w in weights),
    )
    logit = [F.col(w) / F.col("rows") + p for w, p in zip(weights, priors)]
    most = F.greatest(*logit) if n > 1 else logit[0]
    sums = sums.select("id", "hash", "rows", "tokens", *(F.exp(x - most).alias(f"e{d}") for d, x in enumerate(logit)))
    whole = sum((F.col(f"e{d}") for d in range(n)), F.lit(0.0))
    return sums.select(
        "id", "hash", "rows", "tokens", *(F.round(F.col(f"e{d}") / whole, 9).alias(f"p{d}") for d in range(n))
    )


def rated(members: DataFrame, weights: list[float], size: float, near: float = 1e-5) -> DataFrame:
    """The rows with rate: expected token totals are the weights' shares of ``size`` times all tokens.

    A domain that no document may belong to has no say. Ends when every total is within
    ``near`` of its target. Warns of the residual if it no longer falls before.
    """
    n = len(weights)
    mass = F.col("rows") * F.col("tokens")
    pairs = [(d, e) for d in range(n) for e in range(d, n)]

    def sums(rate: Column) -> tuple[np.ndarray, np.ndarray]:
        """Totals of the domains, and the Gram matrix of the rows whose rate is not zero."""
        held = members.withColumn("rate", rate)
        product = lambda d, e: F.when(F.col("rate") > 0, mass * F.col(f"p{d}") * F.col(f"p{e}"))
        found = held.agg(
            *(F.coalesce(F.sum(mass * F.col(f"p{d}") * F.col("rate")), F.lit(0.0)) for d in range(n)),
            *(F.coalesce(F.sum(product(d, e)), F.lit(0.0)) for d, e in pairs),
        ).first()
        gram = np.zeros((n, n))
        for (d, e), v in zip(pairs, found[n:]):
            gram[d, e] = gram[e, d] = v
        return np.array(found[:n], float), gram

    steps, off = fitted(sums, lambda steps: _rate(steps, n), weights, size, near)
    if off > near:
        warnings.warn(f"totals miss their targets by {off:.2%} at most; no step brings them nearer", stacklevel=2)
    return members.withColumn("rate", F.round(_rate(steps, n), 6))


def _rate(steps: list[list[float]], n: int) -> Column:
    if not steps:
        return F.lit(1.0)
    return F.aggregate(
        F.array(*(F.array(*map(F.lit, step)) for step in steps)),
        F.lit(1.0),
        lambda rate, step: F.greatest(F.lit(0.0), rate - sum((F.col(f"p{d}") * step[d] for d in range(n)), F.lit(0.0))),
    )


def fitted(sums, rate, weights: list[float], size: float, near: float) -> tuple[list[list[float]], float]:
    """Steps of the domains, and by how much of its target a total is off at most.

    ``sums`` gives the totals and the Gram matrix of what ``rate`` gives for steps.
    """
    now, gram = sums(rate([]))
    total = now.sum()
    goal = size * total * np.array(weights) / sum(weights)
    scale = np.array([1 / sqrt(c) if c > 1e-9 * total > 0 else 0.0 for c in now])
    # a bound of the largest eigenvalue of the scaled Gram matrix sets the plain step
    bound = (gram * scale * scale[:, None]).sum(axis=1).max(initial=0.0)
    aimed = (scale > 0) & (goal > 0)

    def missed(now):
        return float((np.abs(now - goal)[aimed] / goal[aimed]).max(initial=0.0))

    steps: list[list[float]] = []
    first = 0
    off = (now - goal) * scale
    fallen = [float(off @ off)]
    while bound and (missed(now) > near or (off[~aimed] ** 2).sum() > near**2 * total):
        values, vectors = np.linalg.eigh(gram * scale * scale[:, None])
        fine = values > 1e-12 * bound
        scaled = vectors[:, fine] @ ((vectors[:, fine].T @ off) / values[fine])
        parts = SHORTER[first:] if fine.any() else ()
        for k, step in enumerate((*(scaled * part for part in parts), off / bound)):
            tried = [*steps, (step * scale).tolist()]
            then, there = sums(rate(tried))
            left = (then - goal) * scale
            if left @ left < fallen[-1]:
                break
        else:
            break
        # where a long step failed, the next one begins a little longer than the one that did not
        first = max(0, first + k - 1)
        steps, now, gram, off = tried, then, there, left
        fallen.append(float(off @ off))
        if len(fallen) > STALLED and fallen[-1] > 0.98 * fallen[-1 - STALLED]:
            break
    return steps, missed(now)


def mixed(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    size: float = 1.0,
    sample: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_tokens, a posterior p_<domain> for each, and rate.

    ``labels`` has the id and a ``domain``; ``targets`` the weight of each domain, and
    ``size`` how many tokens the mix has for each one there is. Tokens are words between
    white space. A null text counts as empty: it has no tokens, the
    priors as posterior, and the rate that follows. Null and repeated ids are kept; rows
    with equal id and text have one rate. Other columns are left out.
    """
    domains = list(targets)
    members = _members(docs, labels, targets, size, sample, id_col, text_col)
    each = members.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(
        F.col("id").alias(id_col),
        F.col("tokens").alias("n_tokens"),
        *(F.col(f"p{d}").alias(f"p_{name}") for d, name in enumerate(domains)),
        "rate",
    )


def _members(docs, labels, targets, size, sample, id_col, text_col) -> DataFrame:
    domains = list(targets)
    rows = keyed(docs, id_col, text_col)
    known = labelled(labels, domains, sample, id_col)
    members = stored(memberships(rows, known, len(domains)), "memberships")
    return rated(members, [targets[d] for d in domains], size)


def drawn(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    size: float = 1.0,
    sample: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents as often as their rate says, with all their columns.

    A rate of 1.3 gives one copy, and a second one for three documents in ten: those whose
    hash of id and text says so, the same in every run.
    """
    rates = _members(docs, labels, targets, size, sample, id_col, text_col)
    chance = F.pmod(F.xxhash64("id", "hash", F.lit("copies")), F.lit(1_000_000)) / 1_000_000
    rates = rates.select("id", "hash", F.floor(F.col("rate") + chance).cast("int").alias("copies")).filter("copies > 0")
    own = [f"own_{k}" for k in range(len(docs.columns))]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(text).alias("hash"),
        *(F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)),
    ).alias("d")
    same = F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.hash") == F.col("r.hash"))
    out = rows.join(rates.alias("r"), same).select(*own, F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    return out.select(*(F.col(o).alias(c) for c, o in zip(docs.columns, own)))

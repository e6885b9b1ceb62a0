import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from shiftloom.llm import near
from shiftloom.llm.components import components


def word_sets(texts, wide):
    out = []
    for text in texts:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x20\x09-\x0d]+", lower)
        if not words:
            out.append(set())
        elif len(words) < wide:
            out.append({tuple(words)})
        else:
            out.append({tuple(words[i : i + wide]) for i in range(len(words) - wide + 1)})
    return out


def brute(texts, wide, percent=80):
    """Sets of all pairs, by value."""
    sets = word_sets(texts, wide)
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [(len(s), root(k)) for k, s in enumerate(sets)]


def corpus(seed, n=12):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "x\x85y", "A"]
    texts = []
    for _ in range(n):
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 5, 30, 90, 200]))]
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 30))):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append((" ", "\t", " \n ")[r.randrange(3)].join(copy).replace("w", r.choice("wW")))
    texts += ["", None, "  \t", texts[0], texts[0].upper()]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,wide", [(1, 4), (2, 5)])
def test_matches_all_pairs(spark, seed, wide):
    texts = corpus(seed)
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, node string")
    got = {r.doc_id: r for r in near.near(docs, wide=wide).collect()}
    assert [(got[k].n_shingles, got[k].component_id) for k in range(len(texts))] == brute(texts, wide)
    assert all(r.kept == (r.component_id == k) for k, r in got.items())


def test_null_and_repeated_ids(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(3, a), (3, b), (5, a), (7, b), (None, a), (9, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in near.near(docs).collect())
    assert got == [(0, None, True), (3, 3, True), (3, 3, True), (5, 3, False), (7, 3, False), (9, 9, True)]


def test_empty_table(spark):
    assert near.near(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketches_estimate_similarity(spark):
    random = np.random.default_rng(1)
    n = near.BANDS * near.ROWS
    a = random.integers(0, 2**63, (50, n)).astype(np.uint64)
    b = a.copy()
    b[:, : n // 5] += np.uint64(1)
    x, y = (near.sketches(s).tolist() for s in (a, b))
    df = spark.createDataFrame(list(zip(x, y)), "x array<long>, y array<long>")
    got = [r[0] for r in df.select(near.estimate(df.x, df.y)).collect()]
    assert abs(np.mean(got) - 0.8) < 0.02 and np.std(got) < 0.03


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)]
    edges += [(k, k + 1) for k in range(400, 460)] + [(500, 500)] + [(600, k) for k in range(601, 640)]
    label = {x: x for e in edges for x in e}
    for _ in range(len(label)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long"))
    alone = {x for x in label if sum(x in e for e in edges if e[0] != e[1]) == 0}
    assert {x.node: x.component for x in got.collect()} == {k: v for k, v in label.items() if k not in alone}


def test_representatives_of_equal_ids_with_unlike_texts(spark):
    a, c = " ".join(f"a{k}" for k in range(60)), " ".join(f"c{k}" for k in range(60))
    rows = [(3, a), (5, a + " x"), (3, c), (7, ""), (7, None), (8, "")]
    got = near.representatives(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((x.doc_id, x.text or "") for x in got.collect()) == [(3, a), (3, c), (7, ""), (8, "")]


def test_bits_apart_are_counted_in_a_loop(spark):
    random = np.random.default_rng(3)
    x, y = random.integers(-(2**63), 2**63, (2, 20, near.WORDS))
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x array<long>, y array<long>").select(near.apart(F.col("x"), F.col("y")))
    assert [r[0] for r in df.collect()] == np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1).tolist()
    # written out, the method of a join on pairs is too long for the JVM to compile
    assert df._jdf.queryExecution().optimizedPlan().toString().count("bit_count") < near.WORDS

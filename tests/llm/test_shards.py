import random
import zlib
from collections import defaultdict

import pytest

from shiftloom.llm import shards


def best(sizes, n):
    """Least largest shard of ordered sizes, by trying every capacity that a run of them has."""
    runs = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    for capacity in runs:
        used, left = 0, 0
        for s in sizes:
            if s > capacity:
                used = n + 1
            if s > left:
                used, left = used + 1, capacity
            left -= s
        if used <= n:
            return capacity
    return 0


@pytest.mark.parametrize("seed,n,tries", [(1, 8, 48), (2, 3, 2), (3, 8, 5)])
def test_smallest_feasible_capacity(spark, monkeypatch, seed, n, tries):
    monkeypatch.setattr(shards, "TRIES", tries)
    r = random.Random(seed)
    texts = ["é" * r.choice([0, 1, 3, 40, 300]) + str(r.randrange(30)) for _ in range(60)] + [None, "", "hot"] + ["hot"] * 30
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, size string")
    got = shards.shards(docs, n=n).collect()
    assert len(got) == len(texts)
    at, slots, load, groups = {}, defaultdict(list), defaultdict(int), defaultdict(set)
    for x in got:
        text = texts[x.doc_id] or ""
        assert x.size == len(text.encode()) + 1 and x.text_crc32 == zlib.crc32(text.encode())
        assert x.law == "bytes" and x.grown_shard is None and 0 <= x.shard < n
        groups[text].add(x.shard)
        slots[x.shard].append(x.slot)
        load[x.shard] += x.size
        at[text] = at.get(text, 0) + x.size
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = sorted(at, key=lambda t: __import__("hashlib").sha256(t.encode()).hexdigest())
    assert max(load.values()) == best([at[t] for t in order], n)


def test_few_groups_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id long, text string")
    got = shards.shards(docs).collect()
    assert sorted((x.size, x.slot) for x in got) == sorted([(1, 0), (2, 0), (2, 1)])
    assert shards.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0

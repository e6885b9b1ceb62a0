import math
import random
from collections import Counter

import numpy as np
import pytest

from shiftloom.llm import mixing


def corpus(seed=1, n=240):
    r = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        kind = r.choice(["a", "a", "a", "b"])
        words = [r.choice([f"{kind}{j}" for j in range(8)] + [f"w{j}" for j in range(40)]) for _ in range(r.randint(5, 60))]
        docs.append((k, r.choice([" ", "\n", "  "]).join(words), "x"))
        if k % 2:
            labels.append((k, kind))
    return docs, labels


def test_totals_match_the_targets(spark):
    rows, known = corpus()
    rows += [(1000, None, "x"), (1001, "", "y"), (None, "a1 a2", "z"), rows[0], (0, "b1 b2 b3 b4", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate string")
    labels = spark.createDataFrame(known + [(None, "a"), (3, None), (5, "c")], "doc_id long, domain string")
    got = mixing.mixed(docs, labels, {"a": 0.4, "b": 0.6}, size=1.2).collect()
    assert len(got) == len(rows)
    total = sum(x.n_tokens for x in got)
    assert total == sum(len((t or "").split()) for _, t, _ in rows)
    for name, share in (("p_a", 0.4), ("p_b", 0.6)):
        assert sum(x[name] * x.rate * x.n_tokens for x in got) == pytest.approx(1.2 * share * total, rel=1e-3)
    assert all(x.rate >= 0 and x.p_a + x.p_b == pytest.approx(1) for x in got)
    truth = {k: "a" if "a" in Counter(t) and t.count("a") > t.count("b") else "b" for k, t, _ in corpus()[0]}
    right = [("a" if x.p_a > 0.5 else "b") == truth[x.doc_id] for x in got if x.doc_id in truth and x.n_tokens > 30]
    assert sum(right) / len(right) > 0.95


def test_posteriors_are_those_of_naive_bayes(spark, monkeypatch):
    monkeypatch.setattr(mixing, "EVIDENCE", 0.0)
    docs = [(1, "x y"), (2, "x"), (3, "z z"), (4, "y z"), (5, "q")]
    kinds = {1: "a", 2: "a", 3: "b", 4: "b"}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(list(kinds.items()), "doc_id long, domain string")
    got = {x.doc_id: x for x in mixing.mixed(df, labels, {"a": 1, "b": 1}).collect()}
    for k, text in docs:
        logit = []
        for d in "ab":
            own = [set(t.split()) for i, t in docs if kinds.get(i) == d]
            every = [set(t.split()) for i, t in docs if i in kinds]
            s = math.log((len(own) + 1) / (len(every) + 2))
            for w in "xyz":
                p = (sum(w in o for o in own) + 0.5) / (len(own) + 1)
                q = (sum(w in o for o in every) + 0.5) / (len(every) + 1)
                s += math.log(p / q) if w in text.split() else math.log((1 - p) / (1 - q))
            logit.append(s)
        assert got[k].p_a == pytest.approx(1 / (1 + math.exp(logit[1] - logit[0])), abs=1e-6)


def test_drawn_keeps_columns_and_follows_rates(spark):
    rows, known = corpus(2)
    docs = spark.createDataFrame([*rows, (None, None, "n")], "doc_id long, text string, copies string")
    labels = spark.createDataFrame(known, "doc_id long, domain string")
    targets = {"a": 0.5, "b": 0.5}
    rate = {x.doc_id: x.rate for x in mixing.mixed(docs, labels, targets, 2.0).collect()}
    out = mixing.drawn(docs, labels, targets, 2.0)
    assert out.schema == docs.schema
    copies = Counter(x.doc_id for x in out.collect())
    assert all(math.floor(r) <= copies[k] <= math.ceil(r) for k, r in rate.items())


def test_no_rows_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, domain string")
    assert mixing.mixed(docs.limit(0), labels, {"a": 1, "b": 1}).count() == 0
    got = mixing.mixed(docs, labels, {"a": 1, "b": 1}).collect()
    assert {x.p_a for x in got} == {0.5} and {x.rate for x in got} == {1.0}


@pytest.mark.parametrize(
    "spread,weights", [(3, [0.9, 0.1]), (1, [0.9, 0.1]), (0.3, [0.8, 0.2]), (0.3, [0.5, 0.3, 0.2]), (0.05, [0.63, 0.37])]
)
def test_vague_posteriors_match_the_targets(spark, spread, weights):
    r = np.random.default_rng(1)
    odds = np.exp(r.normal(size=(4_000, len(weights))) * spread + ([0.4] + [0.0] * (len(weights) - 1)))
    rows = (odds / odds.sum(axis=1, keepdims=True)).round(9).tolist()
    kind = ", ".join(["rows long", "tokens long", *(f"p{d} double" for d in range(len(weights)))])
    members = spark.createDataFrame([(1, k % 200 + 1, *p) for k, p in enumerate(rows)], kind)
    some = mixing.rated(members, weights, 1.5).collect()
    total = sum(x.tokens for x in some)
    assert weights[0] < max(p[0] for p in rows)
    for d, w in enumerate(weights):
        assert sum(x.rate * x.tokens * x[f"p{d}"] for x in some) == pytest.approx(1.5 * w * total, rel=1e-4)


def test_targets_out_of_reach_are_said(spark):
    members = spark.createDataFrame([(1, 10, 0.5, 0.5)] * 20, "rows long, tokens long, p0 double, p1 double")
    with pytest.warns(UserWarning, match="miss their targets"):
        assert mixing.rated(members, [0.9, 0.1], 1.0).count() == 20

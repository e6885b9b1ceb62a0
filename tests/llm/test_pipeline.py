"""The pipeline against brute force: all pairs, all windows, and the tokenizers library."""

import hashlib
import math
import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import test_near  # noqa: E402
import test_quality  # noqa: E402
import test_repeats  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from shiftloom.llm import bpe, mixing, quality  # noqa: E402
from shiftloom.llm.queries import SIZE, domains, vocabulary  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels = test_quality.corpus(n=260, seed=7)
    passage = " ".join(f"passage{k}" for k in range(60))
    docs = [(k, t + " " + passage if k % 20 == 3 else t, lang, f"src{k % 5}", len(t)) for k, t, lang, _ in docs]
    docs += [(1000 + k, docs[k][1], "en", "copy", 1) for k in range(0, 60, 4)]
    docs += [(2000 + k, docs[k][1] + " end", "en", None, 1) for k in range(1, 60, 4)]
    docs += [(3000, None, None, None, None), (3001, "", "en", "s", 0), (None, "no id here at all", "en", "s", 3)]
    labels = [(k, q, int(k % 6 == 0)) for k, q, _ in labels] + [(None, 1, 1), (7, None, None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, kinds).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, tables[-1], folder)
        assert out.columns == docs.columns
        tables.append(spark.createDataFrame(out.collect(), docs.schema))
    first, good, near, cut, mix = [[(r.doc_id, r.text) for r in t.collect()] for t in tables]

    scores = quality.scored(docs, quality.fit(docs, labels)).collect()
    assert Counter(k for k, _ in good) == Counter(x.doc_id for x in scores if x.predicted == 1)

    named = [(k, t) for k, t in good if k is not None]
    root = [c for _, c in test_near.brute([t for _, t in named], 5)]
    least = {}
    for (k, _), c in zip(named, root):
        least[c] = min(least.get(c, k), k)
    assert sorted(k for k, _ in near if k is not None) == sorted(least.values())
    assert sum(k is None for k, _ in near) == sum(k is None for k, _ in good)

    want = test_repeats.brute([t for _, t in near], 400)
    left = {k: t for k, t in cut}
    for (k, t), (_, _, _, digest) in zip(near, want):
        assert hashlib.sha256((left[k] or "").encode()).hexdigest() == digest
        assert (left[k] is None) == (t is None)

    rates = mixing.mixed(tables[3], domains(labels), corpus_pipeline.TARGETS, SIZE).collect()
    copies = Counter(k for k, _ in mix)
    for x in rates:
        assert math.floor(x.rate) <= copies[x.doc_id] <= math.ceil(x.rate)
    assert {(k, t) for k, t in mix} <= set(cut)

    codec = bpe.Codec(vocabulary("word_bpe_49k.json"))
    got = corpus_pipeline.STAGES[-1][1](spark, tables[-1], folder).collect()
    whole = []
    for k, text in mix:
        ids = codec.tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = codec.tokenizer.decode(ids, skip_special_tokens=False)
        whole.append((k, len(ids), bpe.sha(" ".join(map(str, ids))), bpe.sha(decoded)))
    assert Counter(map(tuple, got)) == Counter(whole)


def test_shared_passages_of_over_50_words_go_from_the_texts(spark):
    passage = " ".join(f"p{k}" for k in range(51))
    assert len(passage) < 400
    texts = [" ".join(f"own{d}x{k}" for k in range(40)) for d in range(6)]
    docs = [(d, f"{t} {passage} end{d}", "en", "s", 1) for d, t in enumerate(texts[:4])]
    docs += [(9, f"{texts[4]} {passage[:-4]} end9", "en", "s", 1), (10, texts[5], "en", "s", 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = {x.doc_id: (x.text, x.n_chars) for x in dict(corpus_pipeline.STAGES)["suffix-array dedup"](spark, table, "").collect()}
    want = {d: f"{t}  end{d}" for d, t in enumerate(texts[:4])} | {9: docs[4][1], 10: texts[5]}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_run_is_the_stages_in_order(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "minhash near-dedup", "suffix-array dedup", "mixing sources to target weights",
        "bpe encoding and decoding",
    ]
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_registered_queries():
    names = [k for k in queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))

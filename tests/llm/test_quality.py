import random
import zlib

import pandas as pd
import pytest

from shiftloom.llm import quality


def corpus(n=700, seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(3000)]
    docs, labels = [], []
    for k in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(8, 200))]
        bad = r.random() < 0.25
        if bad:
            kind = r.randrange(3)
            if kind == 0:
                words = [w.upper() + "!!" for w in words]
            elif kind == 1:
                words = [w + r.choice(["###", "%%%"]) for w in words]
            else:
                words = [w for w in words[:10] for _ in range(12)]
        docs.append((k, " ".join(words), "en", r.random()))
        if r.random() < 0.6:
            labels.append((k, int(not bad), 0))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    docs += [(9000, None, None, 0.0), (9001, "", "en", 0.0), (None, "a b c", "en", 0.0), (0, "again a b", "en", 0.0)]
    docs += [(9002, "x" * 3_000_000, "en", 0.0)]
    labels += [(None, 1, 0), (3, None, 0), (5, 0, 0), (5, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    got = quality.scored(docs, model).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    known = got.dropna(subset=["doc_id"])
    assert [zlib.crc32(str(int(k)).encode()) % 5 == 0 for k in known.doc_id] == known.held_out.tolist()
    figures = quality.accuracy(got, pd.DataFrame(corpus()[1], columns=["doc_id", "quality", "toxic"]))
    assert figures["auc"] > 0.97 and figures["kept_of_1"] > 0.97 and figures["kept_of_0"] < 0.2
    kept = quality.accepted(docs, model)
    assert kept.schema == docs.schema and kept.count() == got.predicted.sum()


def test_held_out_labels_teach_nothing(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) quality", "toxic")
    a, b = (quality.fit(docs, x, sample=200) for x in (labels, flipped))
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)


def test_one_class_no_labels_no_rows(spark):
    docs = spark.createDataFrame([(k, "some words") for k in range(9)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id long, quality int")
    assert {x.score for x in quality.scored(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert all(x.score > 0.5 for x in quality.scored(docs, quality.fit(docs, ones)).collect())
    assert quality.scored(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0

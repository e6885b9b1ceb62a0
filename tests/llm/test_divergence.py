"""Divergence of sources against plain counting."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shiftloom.llm import divergence

COLUMNS = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def plain(rows, least=10, top=10):
    groups, held = {}, {}
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(found)
        held.setdefault(lang, Counter()).update(set(found))

    def p_of(count, kept):
        n = sum(count[t] for t in kept)
        return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

    out = []
    for lang, own in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        p = {s: p_of(c, kept) for s, c in own.items()}
        q = p_of(sum(own.values(), Counter()), kept)
        for s in own:
            values = [
                (sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in own if o != s
            ]
            more = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", values), ("term", more)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def found(spark, rows, **more):
    docs = spark.createDataFrame(rows, COLUMNS)
    return sorted(tuple(r) for r in divergence.audited(docs, **more).collect())


ROWS = [
    (1, "Red red blue. GRÜN grün!", "en", "a"),
    (2, "red_blue-blue 7up", "en", "b"),
    (3, None, "en", "c"),
    (4, "red blue grün Ünder", "en", None),
    (5, "red", None, "a"),
    (6, "", None, None),
    (7, "red red", "", "b"),
    (8, "blue " * 30_000 + "red", "en", "b"),
    (8, "blue " * 30_000 + "red", "en", "b"),
    (9, "alone", "x\0y$1\\", "$1"),
    (10, "alone \U0001d4d0\U0001d4d1", "x\0y$1\\", "b"),
    (None, "alone", "one source", "a"),
]


@pytest.mark.parametrize("least", [1, 2, 99])
def test_edge_rows(spark, least):
    assert found(spark, ROWS, least=least) == plain(ROWS, least)


def test_parts_of_the_vocabulary_give_the_same(spark):
    assert found(spark, ROWS, least=1, parts=3) == plain(ROWS, 1)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame(ROWS, COLUMNS).selectExpr("*", "1 AS n", "2 AS term", "3 AS id", "4 AS value", "5 AS `rank`", "6 AS p")
    assert sorted(tuple(r) for r in divergence.audited(docs, least=2).collect()) == plain(ROWS, 2)


def test_ties_follow_the_bytes_of_the_item(spark):
    rows = [(k, f"w{c}{c}", "en", s) for k, (c, s) in enumerate((c, s) for c in "ab" for s in ("s", "é", "z"))]
    rows += [(9, "é zz", "en", "t"), (10, "zz é", "en", "t")]
    assert found(spark, rows, least=1) == plain(rows, 1)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.text("aBcé 1", max_size=12), st.sampled_from([None, "en", "de"]), st.sampled_from("pqr")), max_size=12))
def test_any_rows(spark, rows):
    assert found(spark, rows, least=2, top=2) == plain(rows, 2, 2)


def test_slices_of_a_batch_add_up_to_it(monkeypatch):
    import pyarrow as pa

    lists = [[0, 2], [], [1, 2, 5], [2], None, [0], [5, 6, 7, 8]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 1, 2, 2, 2, 1, 3], pa.int32()), pa.array(lists, pa.list_(pa.int32())),
         pa.array([None if v is None else [float(x + 1) for x in v] for v in lists], pa.list_(pa.float64()))],
        names=["group", "at", "n"],
    )
    want = Counter()
    for g, v in zip([1, 1, 2, 2, 2, 1, 3], lists):
        want.update({(g, x): x + 1 for x in v or []})
    for entries in (1, 3, 100):
        monkeypatch.setattr(divergence, "ENTRIES", entries)
        got = Counter()
        for part in divergence.summed(iter([batch])):
            got.update({(g, a): n for g, a, n in zip(*(c.to_pylist() for c in part.columns))})
        assert got == want


def test_slices_of_texts(monkeypatch):
    import pyarrow as pa

    from shiftloom.llm import words

    texts = ["Red RED é1", "", "7", "x " * 50, "last É"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5), pa.int32()), pa.array(["en", "de", "", "en", "fr"]), pa.array(texts)], names=["group", "lang", "text"]
    )
    monkeypatch.setattr(words, "SLICE", 8)
    got = [r for part in divergence.named(iter([batch])) for r in part.to_pylist()]
    assert [r["group"] for r in got] == list(range(5))
    assert [r["terms"] for r in got] == [
        ["red\0en", "red\0en", "é\0en"], [], [], ["x\0en"] * 50, ["last\0fr", "É\0fr"],
    ]


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_bundles_count_terms_and_documents(monkeypatch, size):
    import pyarrow as pa

    from shiftloom.llm import words

    texts = ["a b a", "a c", "", "a a a a a", "b", "d d", "a", "", ""]
    group = [1, 1, 2, 2, 2, 1, 3, 3, 3]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(group, pa.int32()), pa.array(["en"] * 9), pa.array(texts)], names=["group", "lang", "text"]
    )
    monkeypatch.setattr(divergence, "BUNDLE", size)
    monkeypatch.setattr(words, "ROWS", 2)
    counts, documents, rows = Counter(), Counter(), 0
    for part in divergence.bundles(iter([batch])):
        for r in part.to_pylist():
            rows += 1
            counts[r["group"], r["term"]] += r["n"]
            documents[r["group"], r["term"]] += r["documents"]
    split = [(g, t + "\0en", text.split()) for g, text in zip(group, texts) for t in text.split()]
    assert counts == Counter((g, t) for g, t, _ in split)
    assert documents == Counter((g, t + "\0en") for g, text in zip(group, texts) for t in set(text.split()))
    assert size < 1000 or rows == len(counts)  # a term once for each group


def test_no_vocabulary_on_the_driver(spark):
    seen = []
    real = spark.sparkContext.broadcast
    try:
        spark.sparkContext.broadcast = lambda x: seen.append(x) or real(x)
        assert found(spark, ROWS, least=1) == plain(ROWS, 1)
    finally:
        del spark.sparkContext.broadcast
    assert not seen and not hasattr(divergence, "CountVectorizer")

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from shiftloom.llm import repeats, rolling


def brute(texts, length):
    """Every window of every text, by value."""
    data = [(t or "").encode() for t in texts]
    count = {}
    for d in data:
        for p in range(len(d) - length + 1):
            count[d[p : p + length]] = count.get(d[p : p + length], 0) + 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if count[d[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)

    def words(n):
        return " ".join(r.choice(["ab", "é", "tion", "the", "ing", "q"]) + str(r.randint(0, 9)) for _ in range(n))

    passage, line = words(160), words(90)
    texts = [words(r.randint(0, 300)) for _ in range(12)]
    texts += [words(30) + passage + words(r.randint(0, 60)) for _ in range(5)]
    texts += [passage[k * 7 :] + line for k in range(6)]
    texts += [passage[: len(passage) - 11 * k] for k in range(6)]
    texts += [line + words(20) + line, "x" * 2000, "x" * 399, "x" * 400, "", None, texts[0], texts[0], texts[13]]
    near = words(250)
    for k in range(8):
        at = r.randint(0, len(near) - 5)
        texts.append(near[:at] + "#" + near[at + 1 :])
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removed_matches_every_window(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = {r.doc_id: tuple(r)[1:] for r in repeats.removed(docs).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, 400)


def test_null_and_repeated_ids_are_documents_of_their_own(spark):
    a, b = "abcdefghij" * 3 + "".join(map(str, range(300))), "z" + "".join(map(str, range(900, 1300)))
    rows = [(1, a), (1, a), (1, b), (None, b), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.removed(docs).collect())
    na, nb = len(a), len(b)
    assert got == sorted([(1, na, na), (1, na, na), (1, nb, nb), (0, nb, nb), (0, 0, 0)])


def test_kept_holds_the_rest_and_all_columns(spark):
    texts = corpus(4)
    docs = spark.createDataFrame([(k, t, k * 2) for k, t in enumerate(texts)], "doc_id long, text string, hash long")
    got = {r.doc_id: (r.text, r.hash) for r in repeats.kept(docs).collect()}
    want = brute(texts, 400)
    for k, t in enumerate(texts):
        assert got[k][1] == 2 * k
        if t is None:
            assert got[k][0] is None
        elif t.isascii():
            assert hashlib.sha256(got[k][0].encode()).hexdigest() == want[k][3]


def brute_words(texts, length, run):
    """What is left without the repeated windows of ``length`` bytes and of ``run`` words."""
    data = [(t or "").encode() for t in texts]
    found = [list(re.finditer(rb"[^\x20\x09-\x0D]+", d)) for d in data]
    spans = []
    for k, (d, w) in enumerate(zip(data, found)):
        spans += [(d[p : p + length], k, p, p + length) for p in range(len(d) - length + 1)]
        for j in range(len(w) - run + 1):
            own = w[j : j + run]
            spans.append((tuple(m.group() for m in own), k, own[0].start(), own[-1].end()))
    count = Counter(x[0] for x in spans)
    gone = [[False] * len(d) for d in data]
    for what, k, start, stop in spans:
        if count[what] > 1:
            gone[k][start:stop] = [True] * (stop - start)
    return [bytes(b for b, g in zip(d, x) if not g).decode("utf-8", "ignore") for d, x in zip(data, gone)]


@pytest.mark.parametrize(("seed", "run"), [(5, 51), (6, 51), (7, 8), (8, 1)])
def test_runs_of_words(spark, seed, run):
    r = random.Random(seed)

    def words(n):
        return [r.choice(["a", "é", "to", "日本", "the", "of"]) + str(r.randint(0, 99)) for _ in range(n)]

    def text(w):
        return "".join(x + r.choice([" ", " ", " ", "\n", "\t", "  ", "\r\n"]) for x in w)

    passage, most = words(60), words(50)
    texts = [text(words(r.randint(0, 200))) for _ in range(8)]
    texts += [text(words(20) + passage[k : k + 51 + k % 3] + words(r.randint(0, 30))) for k in range(8)]
    texts += [text(words(9) + most + words(9)) for _ in range(3)]  # a word less than 51
    texts += [" ".join(passage), "\n".join(passage), text(words(5) + 2 * passage[:55]), "b " * 300, "c " * 51, "", None, " "]
    texts += ["c " * 50 + "d", " ".join(most + ["x" * 500]), " ".join(most + ["x" * 499 + "y"])]
    texts += corpus(seed)[:20]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.text for x in repeats.kept(docs, run=run).collect()}
    want = brute_words(texts, 400, run)
    assert [got[k] or "" for k in range(len(texts))] == want
    assert [got[k] is None for k in range(len(texts))] == [t is None for t in texts]


def test_widths_that_a_place_cannot_hold():
    assert repeats.word_windows(51).spread < 51 and repeats.byte_windows(400).spread == 300
    for bad in (lambda: repeats.word_windows(0), lambda: repeats.word_windows(800), lambda: repeats.byte_windows(99)):
        with pytest.raises(ValueError):
            bad()


def test_words_of_texts_longer_than_a_stride(monkeypatch):
    monkeypatch.setattr(rolling, "STRIDE", 3000)
    monkeypatch.setattr(repeats, "STRIDE", 3000)
    monkeypatch.setattr(rolling, "LONGEST", 1200)
    monkeypatch.setattr(rolling, "_families", {})
    r = random.Random(3)
    data = np.frombuffer(" ".join("".join(r.choices("abc", k=r.randint(1, 4))) for _ in range(9_000)).encode(), np.uint8)
    own = rolling_words(data)
    found = repeats.anchors(own, 51, 17)
    assert found[1][0] == 0 and found[2][-1] == len(own) - 51 and (found[1][1:] == found[2][:-1] + 1).all()
    monkeypatch.setattr(rolling, "STRIDE", 1 << 20)
    monkeypatch.setattr(repeats, "STRIDE", 1 << 20)
    monkeypatch.setattr(rolling, "_families", {})
    assert (own == rolling_words(data)).all()
    assert all((a == b).all() for a, b in zip(found, repeats.anchors(own, 51, 17)))


def rolling_words(data):
    return repeats.fingerprints(data, *repeats._words(data), 1)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.removed(docs).count() == 0


def test_texts_longer_than_a_stride(monkeypatch):
    monkeypatch.setattr(rolling, "STRIDE", 3000)
    monkeypatch.setattr(repeats, "STRIDE", 3000)
    monkeypatch.setattr(rolling, "LONGEST", 1200)
    monkeypatch.setattr(rolling, "_families", {})
    data = np.random.default_rng(1).integers(0, 4, 20_000).astype(np.uint8)
    at, first, last = repeats.anchors(data, 400)
    assert first[0] == 0 and last[-1] == len(data) - 400
    assert (first[1:] == last[:-1] + 1).all() and (np.diff(at) > 0).all()
    assert ((at >= last) & (at + repeats.SEED <= first + 400)).all()
    starts = np.arange(len(data) - 700)
    cut = rolling.substrings(data, starts, starts + 700, 2)
    monkeypatch.setattr(rolling, "STRIDE", 1 << 20)
    monkeypatch.setattr(repeats, "STRIDE", 1 << 20)
    monkeypatch.setattr(rolling, "_families", {})
    assert (cut == rolling.substrings(data, starts, starts + 700, 2)).all()
    assert all((a == b).all() for a, b in zip((at, first, last), repeats.anchors(data, 400)))

import random
import re

import numpy as np
import pytest

from shiftloom.llm import pieces
from shiftloom.llm.queries import vocabulary


def greedy(word, known):
    """Longest match first, over (bytes, whether at the end); an unknown word is one piece."""
    n, at = 0, 0
    while at < len(word):
        stop = next((s for s in range(len(word), at, -1) if (word[at:s], s == len(word)) in known), 0)
        if not stop:
            return 1
        n, at = n + 1, stop
    return n


def side_by_side(own, words):
    data = np.frombuffer(b"".join(words), np.uint8)
    stops = np.cumsum([len(w) for w in words])
    return own.counts(data, stops - [len(w) for w in words], stops).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_counts_match_greedy_search(seed, monkeypatch):
    monkeypatch.setattr(pieces, "LONG", 20)
    r = random.Random(seed)
    known = {(bytes(r.choices(b"abc", k=r.randint(1, 5))), r.random() < 0.5) for _ in range(r.choice([0, 3, 15, 40]))}
    if seed % 2:
        known |= {(bytes([c]), e) for c in b"abc" for e in (True, False)}
    own = pieces.Automaton(sorted(known))
    words = [bytes(r.choices(b"abcd" if seed == 5 else b"abc", k=r.randint(1, 30))) for _ in range(400)]
    want = [greedy(w, known) for w in words]
    assert [own.count(w) for w in words] == want
    assert side_by_side(own, words) == want


def test_query_with_a_public_vocabulary(spark):
    path = vocabulary("word_bpe_49k.json")
    known = set(pieces.vocabulary(path))
    rows = [(1, "The quick brown-fox ÉTÉ\t日本語 !!! " + "x" * 700, "a"), (1, None, "b"), (None, "", "c"), (2, " \n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    want = []
    for k, text, _ in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        split = re.findall("[^\x20\x09-\x0d]+", lower)
        want.append((k or 0, len(split), sum(greedy(w.encode(), known) for w in split)))
    got = [(x.doc_id or 0, x.n_words, x.n_tokens) for x in pieces.counted(docs, path).collect()]
    assert sorted(got) == sorted(want)
    assert pieces.counted(docs.limit(0), path).count() == 0

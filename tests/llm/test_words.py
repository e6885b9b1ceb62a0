import random

import numpy as np
import pyarrow as pa

from shiftloom.llm import rolling, words


def split(text):
    out, word = [], b""
    for byte in (text or "").encode() + b" ":
        if byte == 0x20 or 0x09 <= byte <= 0x0D:
            out += [word] if word else []
            word = b""
        else:
            word += bytes([byte])
    return out


def test_words_and_slices(monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice(["a", "é", " ", "\n", "\t", "日", "\x85"]) for _ in range(r.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " ", "x" * 500]
    monkeypatch.setattr(words, "SLICE", 200)
    column = pa.array(["skipped", *texts]).slice(1)
    got, rows = [], []
    for row, stop, offsets, data in words.slices(column):
        text, starts, stops = words.words(offsets, data)
        own = [[] for _ in range(stop - row)]
        for t, a, b in zip(text, starts, stops):
            own[t].append(data[a:b].tobytes())
        got += own
        rows += range(row, stop)
    assert rows == list(range(len(texts)))
    assert got == [split(t) for t in texts]


def test_fingerprints_do_not_depend_on_the_place_or_the_length_of_the_text(monkeypatch):
    data = np.random.default_rng(0).integers(97, 123, 5000).astype(np.uint8)
    starts = np.arange(0, 4900, 7)
    stops = starts + 1 + starts % 90
    whole = words.fingerprints(data, starts, stops, 9)
    moved = words.fingerprints(np.concatenate([data[:13], data]), starts + 13, stops + 13, 9)
    assert (whole == moved).all() and len(set(whole.tolist())) == len(set(data[a:b].tobytes() for a, b in zip(starts, stops)))
    monkeypatch.setattr(rolling, "STRIDE", 300)
    monkeypatch.setattr(rolling, "LONGEST", 50)
    monkeypatch.setattr(rolling, "_families", {})
    assert (whole == words.fingerprints(data, starts, stops, 9)).all()

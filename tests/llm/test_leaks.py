"""Secret scans: known forms against a search by hand, the models on strings they never saw."""

import hashlib
import random
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftloom.llm import leaks

WORD = set(string.ascii_letters + string.digits + "+/_.=-")
HEX = set("0123456789abcdef")
CAPITAL = set(string.ascii_uppercase + string.digits)
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def run_of(text, at, chars):
    stop = at
    while stop < len(text) and text[stop] in chars:
        stop += 1
    return stop


def assigned(text, at):
    """Where an assignment that begins here stops, and the length of its value."""
    low = text.translate(LOWER)
    for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
        if not low.startswith(name, at):
            continue
        i = at + len(name)
        i += text[i : i + 1] in ('"', "'") and i < len(text)
        i = run_of(text, i, " ")
        if text[i : i + 1] not in (":", "=") or i >= len(text):
            continue
        i = run_of(text, i + 1, " ")
        i += text[i : i + 1] in ('"', "'") and i < len(text)
        stop = run_of(text, i, WORD)
        if stop > i:
            return stop, stop - i
    return None


def by_hand(text):
    out, at = [], 0
    while at < len(text):
        found = assigned(text, at)
        if found and found[1] >= 8:
            out.append((at, 0, found[0], "assign"))
        at = found[0] if found else at + 1
    at = 0
    while at < len(text):
        stop = run_of(text, at + 4, CAPITAL) if text.startswith("AKIA", at) else at
        if stop - at >= 16:
            out.append((at, 1, stop, "access"))
        at = stop if stop > at + 4 else at + 1
    at = 0
    while at < len(text):
        stop = run_of(text, at, HEX)
        if stop - at >= 32:
            out.append((at, 2, stop, "hex"))
        at = max(stop, at + 1)
    return [(kind, start, stop) for start, _, stop, kind in sorted(out)]


NEVER = leaks.Model(leaks.np.zeros((len(leaks.LETTERS) + 1,) * 2), 1.0)
PIECES = ["password", "PassWD", "api_key", "APIKEY", "tokentoken", "secret", "=", ":", " ", '"', "'", "==", "AKIA", "AKIAAKIA", "A1B2C3D4E5F6",
          "0123456789abcdef", "f", "é", "ſecret", "TokenK", ".", "-", "longvalue", "\t", "\n", "X", "İ"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_known_forms(text):
    assert leaks.spans(text, NEVER) == by_hand(text)


@pytest.fixture(scope="module")
def model():
    return leaks.train(leaks.ORDINARY, leaks.random_strings())


def test_strings_that_were_not_learned_from(model):
    unseen = [s for s in leaks.random_strings(300) if leaks.held_out(s)]
    assert sum(map(model.secret, unseen)) >= 0.97 * len(unseen)
    ordinary = ["findCustomerByEmailAddress", "retention_policy_enabled", "lib/python/site-packages", "release-notes-for-march",
                "ApplicationContextInitializer", "1234567812345678", "Unabhaengigkeitserklaerung", "2020-01-31T23-59-59"]
    assert not any(map(model.secret, ordinary))


def test_models_add_spans_between_known_ones(model):
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzT9qAb21"
    text = f"é {key} password=abcdefgh {key}"
    at = len(f"é {key} ")
    assert leaks.spans(text, model) == [
        ("markov", 2, 2 + len(key)),
        ("assign", at, at + 17),
        ("markov", at + 18, len(text)),
    ]


def test_a_word_list_is_left_alone(spark):
    words = [("".join(random.Random(k).choices(["er", "tion", "an", "the", "ing", "ou", "st"], k=9)),) for k in range(400)]
    docs = spark.createDataFrame(words, "text string")
    fitted = leaks.fit(docs)
    assert not any(fitted.secret(w) for (w,) in words)


def rows_of(spark, rows, fitted):
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind string, n_hex int")
    return sorted((tuple(r) for r in leaks.digests(leaks.scanned(docs, fitted)).collect()), key=repr)


def test_edge_rows(spark, model):
    secret = "token: 'abcdefgh'"
    long = "word " * 60_000 + "AKIA" + "B7" * 8
    rows = [(1, None, "x", "x", 1), (2, "", "x", "x", 1), (3, secret, None, None, None), (3, secret, None, None, None), (None, long, "", "", 0)]
    digest = hashlib.sha256(b"assign:0:16").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    access = f"access:300000:{300_000 + 20}"
    assert rows_of(spark, rows, model) == sorted(
        [
            (1, 0, 0, 0, empty, "", 0),
            (2, 0, 0, 0, empty, "", 0),
            (3, 1, 0, 0, digest, "assign:0:16", 0),
            (3, 1, 0, 0, digest, "assign:0:16", 0),
            (None, 0, 1, 0, hashlib.sha256(access.encode()).hexdigest(), access, 0),
        ],
        key=repr,
    )
    assert rows_of(spark, [], model) == []


def test_fit_without_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert leaks.fit(docs).secret("wJalrXUtnFEMI7K7MDENG2bPxRfiCYzT9q")

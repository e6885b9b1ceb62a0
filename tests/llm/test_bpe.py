import random

import pytest

from shiftloom.llm import bpe
from shiftloom.llm.queries import vocabulary

ALPHABET = ["a", "b", "the", "'", "s", "'re", "'ll", "é", "é", "́", " ", "\x85", "\x1c", " ", "\n",
            "1", "22", "!!", "<|endoftext|>", "<|endof", "text|>", "ß", "İ", "日本", "語", "😀", "‍", "Σ", "ς",
            "ﬁ", "각", "가", "__", "''s"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(vocabulary("word_bpe_49k.json"))


def whole(codec, text):
    got = codec.tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = codec.tokenizer.decode(got, skip_special_tokens=False)
    return got, (len(got), bpe.sha(" ".join(map(str, got))), bpe.sha(decoded))


def texts(n, seed):
    r = random.Random(seed)
    for _ in range(n):
        some = r.sample(ALPHABET, r.randint(1, len(ALPHABET)))
        yield "".join(r.choice(some) for _ in range(r.choice([0, 5, 40, 300, 900])))


def test_tree_and_remembered_pieces_match_the_library(codec):
    for k, text in enumerate(texts(600, 3)):
        ids, digest = whole(codec, text)
        assert [t[0] for t in codec.joined(text, leaf=(3, 20, 64, 200)[k % 4])] == ids, repr(text)
        assert codec.digests([text]) == [digest], repr(text)


def test_leaves_cover_the_text():
    for n in (0, 1, 2, 7, 1000):
        cuts = bpe.leaves(n, 3)
        assert cuts[0][0] == 0 and cuts[-1][1] == n
        assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))


def test_digests_of_long_null_and_repeated_rows(spark, codec):
    r = random.Random(1)
    long = "".join(r.choice("abcdefgh é'1\n") for _ in range(3 * bpe.LEAF))
    unsplit = "ab" * bpe.LEAF + "x"
    rows = [(1, long, "x"), (1, long, "y"), (1, "other", None), (None, None, None), (2, "", "z"), (None, unsplit, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.digests(docs, vocabulary("word_bpe_49k.json"))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted((i or 0, *whole(codec, t)[1]) for i, t, _ in rows)
    assert sorted((x[0] or 0, *x[1:]) for x in map(tuple, got.collect())) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(docs, vocabulary("word_bpe_49k.json")).count() == 0


def test_words_are_split_as_the_library_does(codec):
    """Words of ASCII and Latin-1 are split here; odd characters, special tokens and long words stay with the library."""
    assert codec.splits
    r = random.Random(5)
    latin = [chr(c) for c in range(1, 256)]
    some = ["'s", "'RE", "'ll", "Don't", "it's", "É", "ß", "ÿ", "ÀB", " ", "\n", "x" * 150, "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b",
            "—", "…", "Ω", "ı", "é", " ", "\x85", " ", "12", "½", "²", "ª", "×"]
    texts = ["".join(r.choice(latin if r.random() < 0.3 else some[: r.randint(1, len(some))]) for _ in range(60)) for _ in range(400)]
    texts += ["".join(r.choice(latin[31:126] + [" "] * 20) for _ in range(200)) for _ in range(400)] + ["", " ", "\x85", "\x85 a"]
    want = [whole(codec, text)[1] for text in texts]
    assert codec.digests(texts) == want
    assert [codec.digests([text])[0] for text in texts] == want


def test_plain_words_are_remembered_whatever_stands_around_them():
    """Case and marks around a word make no new pieces, so that few of them are encoded."""
    codec = bpe.Codec(vocabulary("word_bpe_49k.json"))
    codec.digests(["word WORD, (word) Word. «word» \"word's\""])
    assert "word" in codec.known and "WORD," not in codec.known and len(codec.known) < 10

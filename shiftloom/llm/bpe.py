"""BPE encoding and decoding by tree concatenation.

A long text is cut in halves again and again, at any character, down to leaves. Spark
deals the leaves out and encodes them in parallel. Then neighbours are joined, level by
level: a window around the join is encoded anew, and grows until one of its tokens is
also a token of the left side and a later one is also a token of the right side, at the
same place. Such a token has the same neighbours in a valid encoding on either side of
it, and a sequence of which every two neighbours are a valid encoding is the encoding of
the whole, so the joined tokens are exactly those of the whole text.

Text that fits one leaf is encoded where it is read, without a shuffle. There, what
stands between ASCII white space is encoded once for each worker and remembered: white
space always ends a piece, and no special token holds any. Where the vocabulary file
splits text by ``SPLIT`` and a piece holds only characters of which normalizing and
splitting are known (ASCII and the letters of Latin-1), its words are remembered instead
and given to the model alone; there are fewer of them, and the library's normalizing and
splitting take most of its time.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 32_768  # characters of a leaf at most
WINDOW = 64  # characters on either side of a join at first
REMEMBERED = 150_000  # pieces that a worker remembers, and as many of before
PIECE = 100  # characters of a remembered piece at most

SPACE = "\t\n\r\x0b\x0c"  # and the space itself

# What a vocabulary file says on normalizing and splitting, if its words may be split here.
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = [
    {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
ODD = re.compile("[^ -~À-ÖØ-öø-ÿ]")  # a character that is left to the library
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@[-`{-~]+")  # of lower-cased text without odd ones


def _byte_level() -> dict[int, str]:
    """Letters of Latin-1 to the characters that stand for their bytes."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0)]
    rest = [b for b in range(256) if b not in own]
    names = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


BYTES = _byte_level()


class Codec:
    """One vocabulary file: encodes text, decodes ids, remembers short pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # (ids, decoded) of pieces: those of late, and those of before
        self.known: dict[str, tuple[str, str]] = {}
        self.before: dict[str, tuple[str, str]] = {}
        # without a decoder, decoding joins the tokens by spaces
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.words = None if self.tokenizer.decoder else [self.tokenizer.id_to_token(i) for i in range(size)]
        self.names = [str(i) for i in range(size)]
        said = json.loads(self.tokenizer.to_str())
        self.marks = [t["content"] for t in said["added_tokens"]]
        self.splits = (
            (said["normalizer"] or {}).get("normalizers") == NORMAL
            and (said["pre_tokenizer"] or {}).get("pretokenizers") == SPLIT
            and not said["post_processor"]
            and not any(t["normalized"] or t["single_word"] for t in said["added_tokens"])
            and all(len(WORD.findall(m.lower())) > 1 for m in self.marks)  # no word is a mark
        )

    def tokens(self, text: str, at: int = 0) -> list[tuple[int, int, int]]:
        """(id, start, stop) of each token, counted in characters from ``at``."""
        got = self.tokenizer.encode(text, add_special_tokens=False)
        return [(i, a + at, b + at) for i, (a, b) in zip(got.ids, got.offsets)]

    def decode(self, ids: list[int]) -> str:
        if self.words:
            return " ".join([self.words[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def entry(self, ids: list[int]) -> tuple[str, str]:
        return " ".join([self.names[i] for i in ids]), self.decode(ids)

    def odd(self, text: str) -> bool:
        """Whether the library has to split the text."""
        return not self.splits or ODD.search(text) is not None or any([m in text for m in self.marks])

    def pieces(self, text: str) -> list[str]:
        """What is encoded by itself, in order: words, and odd strings between spaces."""
        if not self.odd(text):
            return WORD.findall(text.lower())
        out = []
        for piece in text.split(" "):
            if not piece:
                continue
            if self.odd(piece):
                out.append(piece)
            else:
                out += WORD.findall(piece.lower())
        return out

    def word(self, word: str) -> tuple[str, str]:
        """Entry of a word that is not odd: the model alone, on the characters for its bytes."""
        bytewise = word if word.isascii() else word.translate(BYTES)
        return self.entry([t.id for t in self.model.tokenize(bytewise)])

    def long(self, piece: str) -> tuple[str, str]:
        """Entry of a piece that is too long to be remembered."""
        return self.entry([t[0] for t in self.joined(piece)]) if self.odd(piece) else self.word(piece)

    def learn(self, pieces: set[str]) -> tuple[dict[str, str], dict[str, str]]:
        """Ids and decoded text of the pieces that are short; from now on they are known."""
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        ids, decoded, odd = {}, {}, []
        for piece in pieces:
            got = self.known.get(piece)
            if got is None:
                if len(piece) > PIECE:
                    continue
                got = self.before.get(piece)
                if got is None:
                    if self.odd(piece):
                        odd.append(piece)
                        continue
                    got = self.word(piece)
                self.known[piece] = got
            ids[piece], decoded[piece] = got
        for piece, code in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            got = self.known[piece] = self.entry(code.ids)
            ids[piece], decoded[piece] = got
        return ids, decoded

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(tokens, sha256 of the ids, sha256 of the decoded text) of each text."""
        for space in SPACE:
            texts = [text.replace(space, " ") for text in texts]
        split = [self.pieces(text) for text in texts]
        pieces = set().union(*split)
        ids, decoded = self.learn(pieces)
        rare = len(ids) < len(pieces) or "" in ids.values()  # a piece is long, or has no token
        return [(self._rare if rare else self._digest)(of, ids, decoded) for of in split]

    def _digest(self, pieces: list[str], ids: dict[str, str], decoded: dict[str, str]) -> tuple[int, str, str]:
        all_ids = " ".join(map(ids.__getitem__, pieces))
        return (
            all_ids.count(" ") + 1 if all_ids else 0,
            sha(all_ids),
            sha(" ".join(map(decoded.__getitem__, pieces))),
        )

    def _rare(self, pieces: list[str], ids: dict[str, str], decoded: dict[str, str]) -> tuple[int, str, str]:
        """The same where long pieces are not among the known ones and some have no token."""
        own = {p: self.long(p) for p in set(pieces) if p not in ids}
        ids, decoded = ({p: own[p][k] if p in own else known[p] for p in pieces} for k, known in enumerate((ids, decoded)))
        return self._digest([p for p in pieces if ids[p]], ids, decoded)

    def joined(self, text: str, leaf: int = LEAF) -> list[tuple[int, int, int]]:
        """Tokens of a text of any length, by halves."""
        cuts = leaves(len(text), leaf)
        return self.tree(text, [(a, b, self.tokens(text[a:b], a)) for a, b in cuts])

    def tree(self, text: str, parts: list[tuple[int, int, list]]) -> list[tuple[int, int, int]]:
        """Join neighbouring parts (start, stop, tokens), level by level."""
        while len(parts) > 1:
            pairs = zip(parts[::2], parts[1::2])
            parts = [(a[0], b[1], self.join(text, a, b)) for a, b in pairs] + parts[len(parts) // 2 * 2 :]
        return parts[0][2] if parts else []

    def join(self, text: str, left: tuple, right: tuple) -> list[tuple[int, int, int]]:
        """Tokens of two neighbouring parts, from the smallest window that agrees with both."""
        begin, cut, a = left
        _, end, b = right
        reach = WINDOW
        while True:
            k = _after(a, cut - reach) - 1
            lo, hi = a[k][1] if k >= 0 else begin, min(end, cut + reach)
            window = self.tokens(text[lo:hi], lo)
            before = (0, 0) if lo == begin else _seam(a, window, 1)
            after = (len(b), len(window)) if hi == end else _seam(b, window, before[1] if before else 1)
            if before and after:
                return a[: before[0]] + window[before[1] : after[1]] + b[after[0] :]
            reach *= 2


def _after(tokens: list, place: int) -> int:
    """Index of the first token that begins after a place."""
    return bisect_right(tokens, place, key=lambda t: t[1])


def _seam(side: list, window: list, least: int) -> tuple[int, int] | None:
    """Where ``side`` and ``window`` hold the same two tokens: the first one's index in each.

    The token begins with a character of its own, and neither token is one at the ends,
    which the cuts made.
    """
    if not window:
        return None
    places = {}
    for k in range(max(1, _after(side, window[0][1])), len(side) - 2):
        if side[k][1] > window[-1][1]:
            break
        if side[k - 1][2] <= side[k][1]:
            places[side[k], side[k + 1]] = k
    for j in range(max(1, least), len(window) - 2):
        if window[j - 1][2] <= window[j][1] and (k := places.get((window[j], window[j + 1]))) is not None:
            return k, j
    return None


def leaves(n: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Halves of halves of a text of n characters, until each fits a leaf."""
    cuts = [(0, n)]
    while cuts and cuts[0][1] - cuts[0][0] > leaf:
        cuts = [c for a, b in cuts for c in ((a, (a + b) // 2), ((a + b) // 2, b))]
    return cuts


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file; loaded once in each worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256.

    A null text counts as empty: no tokens, the digests of the empty string. A null or
    repeated id is kept; each row is encoded by itself. Other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= LEAF)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                got = own.digests(part["text"].tolist())
                out = pd.DataFrame(got, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                out.insert(0, "id", part["id"].array)
                yield out

    done = short.mapInPandas(whole, f"id {kind}, {DIGEST}")
    joined = encoded(rows.filter(F.length("text") > LEAF), path).select(
        "id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
    return done.union(joined).withColumnRenamed("id", id_col)


def encoded(rows: DataFrame, path: str) -> DataFrame:
    """id, ids and decoded text of (id, text) rows, each text by its leaves.

    Leaves are dealt out by (text, place), so those of one long text meet many tasks;
    only its tokens meet again in one, as they do in its row.
    """
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("hash", F.sha2("text", 256))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, text, h in zip(batch["id"], batch["text"], batch["hash"]):
                at = leaves(len(text))
                yield pd.DataFrame(
                    {"id": i, "hash": h, "begin": [a for a, _ in at], "piece": [text[a:b] for a, b in at]}
                )

    def leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        for batch in batches:
            for k in range(len(batch)):  # one leaf at a time: its tokens take ten times its room
                one = batch.iloc[k : k + 1]
                got = own.tokens(one["piece"].iloc[0], int(one["begin"].iloc[0]))
                yield one.assign(tokens=[[x for t in got for x in t]])

    def tree(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("begin")
        parts = [
            (int(a), int(a) + len(p), list(zip(*(iter(t.tolist()),) * 3)))
            for a, p, t in zip(group["begin"], group["piece"], group["tokens"])
        ]
        own = codec(path)
        ids = [t[0] for t in own.tree("".join(group["piece"]), parts)]
        return pd.DataFrame({"id": [key[0]], "hash": [key[1]], "ids": [ids], "decoded": [own.decode(ids)]})

    place = f"id {kind}, hash string, begin long, piece string"
    pieces = rows.dropDuplicates(["id", "hash"]).mapInPandas(cut, place).repartition("id", "hash", "begin")
    tokens = pieces.mapInPandas(leaf, place + ", tokens array<long>")
    trees = tokens.groupBy("id", "hash").applyInPandas(tree, f"id {kind}, hash string, ids array<long>, decoded string")
    same = F.col("r.id").eqNullSafe(F.col("t.id")) & (F.col("r.hash") == F.col("t.hash"))
    return rows.drop("text").alias("r").join(trees.alias("t"), same).select("r.id", "t.ids", "t.decoded")

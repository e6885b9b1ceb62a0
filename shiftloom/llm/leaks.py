"""Secrets in texts: known forms, and strings that look random rather than named.

Two character Markov models, one of random strings and one of ordinary identifiers, are
trained on labelled samples. A string that stands alone is a secret where the ratio of its
likelihoods is above a threshold, which labelled strings that neither model learned from
set. The known forms are found by their patterns and need no model.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.scratch import stored

# Known forms, in the order in which spans that begin together are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LEAST = 8  # characters of group 2
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex")
MODELLED = "markov"

SHORTEST = 16  # characters of a string that the models judge; no known form without a name is shorter
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STRING = re.compile(rf"[{re.escape(LETTERS)}]{{{SHORTEST},}}")
WHOLE = re.compile(rf"[{re.escape(LETTERS)}]+")

CODES = np.zeros(256, np.int64)  # 0 is the edge of a string
CODES[[ord(c) for c in LETTERS]] = np.arange(1, len(LETTERS) + 1)
SORTS = np.array([0] + [1 if c.isupper() else 2 if c.islower() else 3 if c.isdigit() else 4 for c in LETTERS])

#: Labelled ordinary identifiers: names, paths, file names, numbers, dates, rulers.
ORDINARY = """
getUserAccountById setConnectionTimeout HttpServletRequestWrapper maximumPartitionBytes AbstractQueryExecution
customer_order_history_id updated_at_timestamp number_of_active_sessions default_retention_period is_primary_contact
MAX_CONNECTION_POOL_SIZE DEFAULT_BUFFER_LENGTH ENVIRONMENT_VARIABLE_NAME HTTP_STATUS_NOT_FOUND
content-security-policy access-control-allow-origin main-navigation-container read-only-file-system state-of-the-art-systems
/usr/local/share/applications /var/log/system/messages src/main/resources/templates docs/getting-started/installation
https://www/products/category/electronics index/page/archive/2019/november user/profile/settings/notifications
2019-11-04T10-15-30 2021/03/17/report-final-version 20200131235959000 4000038985693383 1234567890123456 +49-30-1234567890
0000000000000000 1000000000000000 9999999999999999 2147483647/4294967295 192-168-000-001-255
================ ---------------- ________________ ++++++++++++++++ =-=-=-=-=-=-=-=-
aaaaaaaaaaaaaaaa hahahahahahahahaha noooooooooooooooo xxxxxxxxxxxxxxxx AAAAAAAAAAAAAAAA
internationalization Donaudampfschifffahrt Geschwindigkeitsbegrenzung anticonstitutionnellement responsabilidades
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 01234567890123456789 ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789
invoice_2021_march_final version-2-release-candidate-1 chapter10section4figure2 windows-server-2019-datacenter
""".split()

#: Alphabets of keys. Labelled random strings are spelt in them by rule, from digests of counters.
ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-",
)


@dataclass
class Model:
    """Log-likelihood ratio of each step from one character to the next, and the threshold."""

    steps: np.ndarray
    threshold: float

    def ratio(self, text: str) -> float:
        """Log-likelihood of the string as a random one, less that as an ordinary one."""
        codes = CODES[np.frombuffer(text.encode("latin-1"), np.uint8)]
        edge = np.zeros(1, np.int64)
        return float(self.steps[np.concatenate([edge, codes]), np.concatenate([codes, edge])].sum())

    def secret(self, text: str) -> bool:
        return self.ratio(text) > self.threshold


def random_strings(each: int = 1_000) -> list[str]:
    """Labelled random strings: ``each`` of every alphabet, of 16 to 64 characters."""
    out = []
    for letters in ALPHABETS:
        for k in range(each):
            digest = hashlib.sha512(f"{letters}{k}".encode()).digest()
            number, size = int.from_bytes(digest, "big"), SHORTEST + digest[0] % 49
            spelt = []
            for _ in range(size):
                number, at = divmod(number, len(letters))
                spelt.append(letters[at])
            out.append("".join(spelt))
    return out


def samples(docs: DataFrame, sample: int = 20_000, text_col: str = "text") -> DataFrame:
    """string and random: labelled strings of the documents, at most ``sample`` of each label.

    Ordinary are strings of letters only or of digits only; random are values of the known
    forms that hold letters and digits. Each string counts once, however often it occurs.
    A sample holds the least hashes, so it is the same in every run.
    """

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {pair for t in batch.column("text") for pair in labels(t.as_py() or "")}
            columns = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32()))], names=["string", "random"])

    rows = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(labelled, "string string, random int").distinct()
    rows = stored(rows, "strings")
    sides = [rows.filter(F.col("random") == k).orderBy(F.xxhash64("string"), "string").limit(sample) for k in (0, 1)]
    return sides[0].unionByName(sides[1])


def labels(text: str) -> Iterator[tuple[str, int]]:
    """Labelled strings of a text."""
    known = [m.group(2) if kind == "assign" else m.group() for kind, m in forms(text, runs(text))]
    for value in known:
        if len(value) >= SHORTEST and WHOLE.fullmatch(value) and not value.isalpha() and not value.isdigit():
            yield value, 1
    for _, _, value in runs(text):
        if value.isalpha() or value.isdigit():
            yield value, 0


def fit(docs: DataFrame, sample: int = 20_000, spare: float = 0.001, text_col: str = "text") -> Model:
    """Both models from labelled strings: those of ``samples``, and the tables of this module.

    Every fifth string by its hash is kept from the models and sets the threshold: at most
    ``spare`` of the ordinary ones among them are above it, and none of a ratio below 1000
    to 1. The strings that reach the driver are bounded by ``sample``.
    """
    rows = samples(docs, sample, text_col).collect()
    ordinary = sorted({r.string for r in rows if not r.random} - {r.string for r in rows if r.random}) + ORDINARY
    random = sorted({r.string for r in rows if r.random}) + random_strings()
    return train(ordinary, random, spare)


def held_out(text: str) -> bool:
    return hashlib.md5(text.encode()).digest()[0] % 5 == 0


def train(ordinary: list[str], random: list[str], spare: float = 0.001) -> Model:
    taught = [[s for s in side if not held_out(s)] for side in (ordinary, random)]
    # the module's table is small and must weigh against many strings of letters only
    as_ordinary = chain(taught[0]) + chain(ORDINARY) * max(1, len(taught[0]) // len(ORDINARY))
    model = Model(logs(chain(taught[1])) - logs(as_ordinary), float(np.log(1000)))
    apart = sorted(model.ratio(s) for s in ordinary if held_out(s))
    if apart:
        model.threshold = max(model.threshold, apart[int(np.ceil((1 - spare) * (len(apart) - 1)))])
    return model


def chain(strings: list[str]) -> np.ndarray:
    """How often each character follows each other one; 0 is the edge."""
    counts = np.zeros((len(LETTERS) + 1,) * 2)
    for text in strings:
        codes = CODES[np.frombuffer(text[:4096].encode("latin-1"), np.uint8)]
        np.add.at(counts, (np.concatenate([[0], codes]), np.concatenate([codes, [0]])), 1)
    return counts


def logs(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of the steps.

    A step is mixed with that of the sort of its two characters (capital, small,
    digit, sign), and that with how common the end is.
    """
    common = (counts.sum(0) + 1) / (counts.sum() + len(counts))
    of_sort = np.zeros((5, len(counts)))
    np.add.at(of_sort, SORTS, counts)
    of_sort = 0.9 * of_sort / np.maximum(of_sort.sum(1, keepdims=True), 1) + 0.1 * common
    return np.log(0.7 * counts / np.maximum(counts.sum(1, keepdims=True), 1) + 0.3 * of_sort[SORTS])


def runs(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, string) of the strings that stand alone, ``SHORTEST`` characters at least."""
    return [(m.start(), m.end(), m.group()) for m in STRING.finditer(text)]


def forms(text: str, strings: list[tuple[int, int, str]]) -> Iterator[tuple[str, re.Match]]:
    """(kind, match) of the known forms. What needs no name is part of a long string."""
    low = text.lower()  # capitals of ASCII become small ones, whatever else changes
    if any(name in low for name in NAMES):
        for match in ASSIGN.finditer(text):
            if len(match.group(2)) >= ASSIGN_LEAST:
                yield "assign", match
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for start, stop, _ in strings:
            for match in pattern.finditer(text, start, stop):
                yield kind, match


def spans(text: str, model: Model) -> list[tuple[str, int, int]]:
    """(kind, start, stop) in code points: known forms, and between them what the models call random.

    Sorted by start, then by kind as the forms are listed.
    """
    strings = runs(text)
    known = sorted((m.start(), KINDS.index(kind), m.end(), kind) for kind, m in forms(text, strings))
    more, at, free = [], 0, 0
    for start, stop, _ in strings:
        while at < len(known) and known[at][0] < stop:
            more += _random(text, max(start, free), known[at][0], model)
            free = max(free, known[at][2])
            at += 1
        more += _random(text, max(start, free), stop, model)
    return [(kind, start, stop) for start, _, stop, kind in sorted(known + more)]


def _random(text: str, start: int, stop: int, model: Model) -> list[tuple[int, int, int, str]]:
    if stop - start < SHORTEST or not model.secret(text[start:stop]):
        return []
    return [(start, len(KINDS), stop, MODELLED)]


def scanned(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and spans, an array of (kind, start, stop).

    Spans of a known form do not overlap each other; those of two forms may. Spans of the
    models ('markov') overlap none. Whole texts are read, of any length. A null text counts
    as empty and has no spans. Null and repeated ids are kept, each row on its own. Other
    columns are left out; an empty table has no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "stop"), s)) for s in spans(t.as_py() or "", model)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(span))], names=["id", "spans"])

    out = rows.mapInArrow(scan, f"id {kind}, spans array<struct<kind:string,start:bigint,stop:bigint>>")
    return out.withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of each kind, the digest of the known spans, and all spans as text, of ``scanned`` rows."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def text(spans: Column) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
        return F.array_join(each, ",")

    base = F.filter("spans", lambda s: s["kind"] != MODELLED)
    return found.select(
        F.col(f"`{id_col}`").alias(id_col),
        *(count(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        count(MODELLED).alias(f"n_{MODELLED}"),
    )

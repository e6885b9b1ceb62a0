"""Quality classifier: Naive Bayes support vectors.

N-grams of a text become indicators, each scaled by the log ratio of its counts in the
two classes; a linear hinge-loss model over them is fitted by dual coordinate descent.

N-grams are of one and two words, and of one and two word shapes. A shape keeps the kinds
of characters without runs ('Thon.' is 'Xx.', 'ERTH!!' is 'X!') and whether the word
repeats the one before. A shape n-gram has an indicator for each share of the text that
it reaches (any, 1/32, 1/8, 1/2), so that one odd word does not count as a text of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.rolling import mixed
from shiftloom.llm.words import fingerprints, slices, words

BITS = 18  # indicators are hashed to 2**BITS
SHARES = (1 / 32, 1 / 8, 1 / 2)

KINDS = np.arange(256, dtype=np.uint8)
KINDS[ord("A") : ord("Z") + 1] = ord("X")
KINDS[ord("a") : ord("z") + 1] = ord("x")
KINDS[ord("0") : ord("9") + 1] = ord("9")
KINDS[0x80:] = ord("x")


@dataclass
class Model:
    """Weights of the indicators, and the line from a margin to a score."""

    weights: np.ndarray
    scale: np.ndarray  # log-count ratios
    bias: float
    slope: float
    shift: float

    def scores(self, text: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Scores of n texts from the (text, feature) pairs of their indicators."""
        margin = np.bincount(text, (self.weights * self.scale)[feature], n)
        norm = np.sqrt(np.bincount(text, self.scale[feature] ** 2, n))
        margin = margin / np.maximum(norm, 1e-12) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def indicators(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs of a slice of texts."""
    text, starts, stops = words(offsets, data)
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = fingerprints(data, starts, stops, 4)
    kinds = KINDS[data]
    new = np.ones(len(data), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[starts] = True
    place = np.concatenate([[0], np.cumsum(new)])
    shape = fingerprints(kinds[new], place[starts], place[stops], 5)
    after = np.zeros(len(text), bool)
    after[1:] = text[1:] == text[:-1]
    same = np.zeros(len(text), bool)
    same[1:] = after[1:] & (word[1:] == word[:-1])
    shape = mixed(shape + same.astype(np.uint64))
    pair = np.flatnonzero(after)

    def two(x):
        return mixed(x[pair] * np.uint64(3) + x[pair - 1])

    low = np.uint64((1 << BITS) - 1)
    size = np.bincount(text, minlength=len(offsets) - 1)
    out = []
    for kind, at, grams in ((1, text, word), (2, text[pair], two(word)), (3, text, shape), (4, text[pair], two(shape))):
        key = at.astype(np.uint64) << np.uint64(44) | mixed(grams + np.uint64(kind)) & np.uint64((1 << 44) - 1)
        key, count = np.unique(key, return_counts=True)
        at = (key >> np.uint64(44)).astype(np.int64)
        out.append((at, key & low))
        if kind > 2:
            for level, share in enumerate(SHARES, 1):
                much = count >= share * size[at]
                out.append((at[much], mixed(key[much] & np.uint64((1 << 44) - 1) | np.uint64(level << 50)) & low))
    pairs = np.unique(np.concatenate([a << BITS | f.astype(np.int64) for a, f in out]))
    return pairs >> BITS, pairs & (1 << BITS) - 1


def held_out(id_col: str, folds: int = 5):
    """Whether a document is kept from training: crc32 of its id as text, modulo folds, is 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 8_000,
    folds: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Fit on at most ``sample`` labelled documents, of those that are not held out.

    The sample holds the least hashes of the ids, so it is the same in every run. Rows
    with a null id or label, or with both labels, teach nothing. Without both classes the
    model says what share of the sample has label 1.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col, folds))
    known = known.groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).alias("label"), F.max(label_col).alias("most")
    )
    known = known.filter("label = most").orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the sample is bounded by its parameter, so it is sent to the texts and not they to it
    rows = texts.join(F.broadcast(known), "id").select("id", "label", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, offsets, data in slices(batch.column("text")):
                text, feature = indicators(offsets, data)
                lists = np.split(feature.astype(np.int32), np.searchsorted(text, np.arange(1, stop - row)))
                part = batch.slice(row, stop - row)
                arrays = [part.column("label"), part.column("id").cast(pa.string()), pa.array(lists, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["label", "id", "features"])

    got = rows.mapInArrow(featured, "label int, id string, features array<int>").toArrow().sort_by("id")
    lists = got.column("features").combine_chunks()
    features = np.split(lists.flatten().to_numpy(), lists.offsets.to_numpy()[1:-1] - lists.offsets[0].as_py())
    return train(features[: len(got)], got.column("label").to_numpy())


def train(features: list[np.ndarray], labels: np.ndarray) -> Model:
    """Model of labelled indicators; one row in four only sets the line to a score."""
    size = 1 << BITS
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(size), np.ones(size), 0.0, 0.0, float(np.log(share / (1 - share))))
    turn = np.arange(len(labels)) % 4 == 3
    if len(set(labels[turn].tolist())) < 2 or len(set(labels[~turn].tolist())) < 2:
        turn[:] = False
    rows = [f for f, t in zip(features, turn) if not t]
    y = np.where(labels[~turn] == 1, 1.0, -1.0)
    counts = np.ones((2, size))
    for f, v in zip(rows, y):  # a text has an indicator once
        counts[int(v < 0), f] += 1
    scale = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    scale[counts[0] + counts[1] < 4] = 0.0  # seen in fewer than two texts
    weights, bias = descend(rows, scale, y)
    model = Model(weights, scale, bias, 1.0, 0.0)
    check = [f for f, t in zip(features, turn) if t] if turn.any() else rows
    truth = labels[turn] if turn.any() else labels
    raw = np.array([model.scores(np.zeros(len(f), np.int64), f, 1)[0] for f in check])
    model.slope, model.shift = line(np.log(raw) - np.log1p(-raw), truth)
    return model


def descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 12):
    """Weights and bias of the squared-hinge model, by dual coordinate descent.

    Rows are scaled indicators of unit length. The rarer class costs more, as much as
    makes both weigh alike.
    """
    weights, bias, dual = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    length = np.array([max(float(np.sqrt((scale[f] ** 2).sum())), 1e-12) for f in rows])
    each = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) * cost
    random = np.random.default_rng(0)
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            f = rows[i]
            v = scale[f] / length[i]
            soft = 1 / (2 * each[i])
            slope = y[i] * (weights[f] @ v + bias) - 1 + dual[i] * soft
            step = max(dual[i] - slope / (2 + soft), 0.0) - dual[i]
            if step:
                dual[i] += step
                weights[f] += step * y[i] * v
                bias += step * y[i]
    return weights, bias


def line(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities (Platt's scaling)."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -500, 500)))
        d, w = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * margin * margin).sum(), (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        step = np.linalg.solve(h + 1e-6 * np.eye(2), [(d * margin).sum(), d.sum()])
        slope, shift = slope - step[0], shift - step[1]
    return (float(slope), float(shift)) if np.isfinite([slope, shift]).all() and slope > 0 else (1.0, 0.0)


def scored(
    docs: DataFrame, model: Model, threshold: float = 0.3, folds: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Whole texts are scored. A null text counts as empty; without words the score is that
    of the bias. A null id is not held out. Other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(held_out(id_col, folds), F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                model.scores(*indicators(offsets, data), stop - row)
                for row, stop, offsets, data in slices(batch.column("text"))
            ]
            got = np.concatenate(parts) if parts else np.zeros(0)
            arrays = [
                batch.column("id"), batch.column("held_out"), pa.array(got), pa.array((got >= threshold).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "held_out", "score", "predicted"])

    out = rows.mapInArrow(score, f"id {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, offsets, data in slices(batch.column(text_col)):
                good = model.scores(*indicators(offsets, data), stop - row) >= threshold
                yield batch.slice(row, stop - row).filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def accuracy(result: pd.DataFrame, labels: pd.DataFrame) -> dict[str, float]:
    """Held-out figures: share right, and the rank statistic of the scores (AUC)."""
    both = result[result.held_out].merge(labels, on="doc_id")
    rank = both.score.rank()
    one = both.quality == 1
    n, m = int(one.sum()), int((~one).sum())
    return {
        "right": float((both.predicted == both.quality).mean()),
        "auc": float((rank[one].sum() - n * (n + 1) / 2) / max(n * m, 1)),
        "kept_of_1": float(both.predicted[one].mean()),
        "kept_of_0": float(both.predicted[~one].mean()),
    }

"""Toxicity by a character n-gram linear classifier on naive Bayes features.

A document is the set of its byte n-grams, hashed. The log-count ratio r of each n-gram, how much likelier toxic
documents hold it than others, is counted in Spark over all labelled documents. The classifier is a logistic
regression on features scaled by r, fitted on all of them: tasks sum up the gradient. N-grams whose ratio is within
chance carry none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, byte_column, free_name, from_texts, labelled, slices, stored, summed
from .linear import distinct, minimize, ngram_ids, sigmoid

ORDERS = (3, 4, 5, 6)
BITS = 20

#: N-grams kept: those whose log-count ratio is furthest beyond chance, at most so many.
FEATURES = 10_000

#: Weight of the squared weights against the mean logistic loss; few or doubtful labels call for more.
PENALTY = 1e-5


class Model(NamedTuple):
    weights: np.ndarray  # one for each n-gram id, zero where it has no feature
    bias: float
    orders: tuple[int, ...]
    bits: int


#: Bytes whose n-grams are held at once; a longer text is read in stretches that overlap.
STRETCH = 1 << 20


def _ids(text: bytes, orders: tuple[int, ...], bits: int, mark: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Distinct n-gram ids of a text, words held apart by one space."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.int64)
    line = b" " + b" ".join(words) + b" "
    cuts = range(0, len(line), stretch)
    parts = [distinct(ngram_ids(line[a : a + stretch + orders[-1] - 1], orders, bits), mark) for a in cuts]
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def _packed(docs: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """(key, text) with compressed texts, which meet their labels in a shuffle."""

    def make():
        return lambda texts: [pa.array([zlib.compress(t, 1) for t in texts], pa.binary())]

    held = free_name(docs, "packed")
    packed = from_texts(docs.select(key_col, text_col), text_col, f"`{held}` binary", make, keep_text=False)
    return packed.select(F.col(key_col).alias("key"), F.col(held).alias("text"))


def gram_counts(labelled: DataFrame, orders: tuple[int, ...], bits: int) -> DataFrame:
    """(id, pos, neg): documents of each class that hold an n-gram, of (label, compressed text) rows; id -1 counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), dtype=np.int64)
        docs = [0, 0]
        mark = np.zeros(1 << bits, dtype=np.int32)
        for part in slices(batches):
            for label, text in zip(part.column(0).to_pylist(), byte_column(part.column(1)), strict=True):
                counts[label][_ids(zlib.decompress(text), orders, bits, mark)] += 1
                docs[label] += 1
        held = np.flatnonzero(counts.any(axis=0))
        for a in range(0, len(held), 50_000):
            ids = held[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(counts[k][ids]) for k in (1, 0))], ["id", "pos", "neg"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([docs[1]]), pa.array([docs[0]])], ["id", "pos", "neg"])

    return labelled.mapInArrow(run, "id long, pos long, neg long").groupBy("id").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )


def _held(rows: DataFrame, kept: np.ndarray, orders: tuple[int, ...], bits: int) -> DataFrame:
    """Stored (label, grams): of each of the rows, the places in ``kept`` of the n-grams it holds."""
    sent = rows.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << bits, -1, dtype=np.int32)
        place[sent.value] = np.arange(len(sent.value))
        mark = np.zeros(1 << bits, dtype=np.int32)
        for part in slices(batches):
            found = [place[_ids(zlib.decompress(t), orders, bits, mark)] for t in byte_column(part.column(1))]
            rows = [np.sort(x[x >= 0]) for x in found]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "grams"])

    return stored(rows.mapInArrow(run, "label int, grams array<int>"), "grams")


def fit(docs: DataFrame, labels: DataFrame, label_col: str, key_col: str = "doc_id", text_col: str = "text",
        orders: tuple[int, ...] = ORDERS, bits: int = BITS, features: int = FEATURES, penalty: float = PENALTY, rounds: int = 100) -> Model:
    """A model of all documents that ``labels`` (key, label) marks 0 or 1.

    A NULL text holds nothing. Without rows of both classes the model scores all texts with the share of class 1 (one
    half without rows).
    """
    rows, n = labelled(_packed(docs, key_col, text_col), labels, key_col, label_col)
    # At most 2 ** bits rows and one.
    table = gram_counts(rows, orders, bits).toArrow()
    ids, pos, neg = (table[c].to_numpy() for c in ("id", "pos", "neg"))
    n_pos, n_neg = int(pos[ids == -1].sum()), int(neg[ids == -1].sum())
    pos, neg, ids = pos[ids >= 0], neg[ids >= 0], ids[ids >= 0]
    weights = np.zeros(1 << bits)
    share = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
    if not n_pos or not n_neg:
        return Model(weights, float(np.log(share / (1 - share))), orders, bits)
    rate = (pos + 1) / (n_pos + 2), (neg + 1) / (n_neg + 2)
    ratio = np.log(rate[0] / rate[1])
    chance = np.sqrt(1 / (pos + 1) + 1 / (neg + 1))
    strength = np.abs(ratio) / chance
    order = np.lexsort((ids, -strength))[:features]
    order = order[strength[order] > 3]
    kept, scale = ids[order], ratio[order]
    held = _held(rows, kept, orders, bits)
    # The classes count by their smoothed shares.
    each = (1 - share) / n_neg, share / n_pos
    size = len(kept)

    def gradient(w):
        sent = held.sparkSession.sparkContext.broadcast((w[:-1] * scale, w[-1]))

        def make(batch):
            label, grams = batch["label"].to_numpy(), batch["grams"]
            ids = grams.flatten().to_numpy()
            row = np.repeat(np.arange(len(label), dtype=np.int32), grams.value_lengths().to_numpy())
            z = np.bincount(row, sent.value[0][ids], len(label)) + sent.value[1]
            weight = np.where(label == 1, each[1], each[0])
            error = weight * (sigmoid(z) - label)
            loss = weight @ (np.logaddexp(0, z) - label * z)
            return np.concatenate([np.bincount(ids, error[row], size), [error.sum(), loss]])

        total = summed(held, size + 2, make)
        sent.destroy()
        loss = float(total[-1] + penalty * (w[:-1] @ w[:-1]))
        return loss, np.append(total[:size] * scale + 2 * penalty * w[:-1], total[-2])

    w = minimize(gradient, np.append(np.zeros(len(kept)), np.log(share / (1 - share))), rounds)
    weights[kept] = w[:-1] * scale
    return Model(weights, float(w[-1]), orders, bits)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs``, without its text unless ``keep_text``, and with ``name``: the probability of class 1, of the whole text.

    NULL, empty and blank texts hold no n-gram and get the probability that the bias gives. Each row is scored by its
    text alone; other columns pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def make():
        weights, bias, orders, bits = sent.value
        mark = np.zeros(1 << bits, dtype=np.int32)

        def compute(texts: list[bytes]) -> list[pa.Array]:
            z = np.array([weights[_ids(t, orders, bits, mark)].sum() for t in texts]) + bias
            return [pa.array(sigmoid(z))]

        return compute

    return from_texts(docs, text_col, f"{name} double", make, keep_text)

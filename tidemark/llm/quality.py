"""Document quality by Bradley-Terry ranking.

The chance that document a is preferred to b is the logistic function of the difference of their scores, and a score is
linear in features of the text. Preference pairs come from labels (a good document is preferred to a poor one); the
weights minimise the logistic loss on the pairs' feature differences. The decision threshold is the quantile of the
training scores at the share of poor documents, so the ranking alone decides what is kept. All labelled documents are
in pairs and in the quantile: they are dealt to blocks, tasks make the pairs within blocks and sum up derivatives.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, free_name, from_texts, labelled, nth_least, stored, summed
from .linear import newton, sigmoid

#: Pairs for each document of the larger class, and how many of that class make a block.
PAIRS, BLOCK = 8, 4096

#: What the threshold's score is mapped to.
KEEP_AT = 0.3

FEATURES = (
    "log_words", "upper", "digit", "space", "stop", "comma", "bang", "symbol", "non_ascii", "entropy", "word_length",
    "distinct_words", "repeated_next", "top_word", "lone_symbol_words", "symbol_end_words", "upper_words", "digit_words",
    "long_words", "distinct_lines", "line_words", "top_pair",
)

_ALNUM = np.array([chr(c).isalnum() or c >= 128 for c in range(256)])
_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_SYMBOL = np.array([c for c in range(33, 127) if not _ALNUM[c] and chr(c) not in ".,;:!?'\"()-"])
_ENDS = frozenset(_SYMBOL.tolist()) | {33}


def features(text: bytes) -> np.ndarray:
    """Shares and statistics of the whole text in the order of FEATURES; zeros for an empty or blank one."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    chars = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    share = chars / len(text)
    held = share[share > 0]
    counts = Counter(text.translate(LOWER).split())
    lowered = text.translate(LOWER).split()
    pairs = Counter(zip(lowered, lowered[1:], strict=False))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return np.array([
        np.log1p(n),
        share[_UPPER].sum(),
        share[_DIGIT].sum(),
        share[32] + share[9] + share[10] + share[13],
        share[46],
        share[44],
        share[33],
        share[_SYMBOL].sum(),
        share[128:].sum(),
        -(held * np.log2(held)).sum(),
        (len(text) - chars[[9, 10, 13, 32]].sum()) / n,
        len(counts) / n,
        sum(a == b for a, b in zip(lowered, lowered[1:], strict=False)) / n,
        max(counts.values()) / n,
        sum(not w.isalnum() and len(w) <= 3 and w[0] < 128 and not _ALNUM[w[0]] for w in words) / n,
        sum(w[-1] in _ENDS for w in words) / n,
        sum(len(w) > 1 and w.isupper() for w in words) / n,
        sum(48 <= w[0] <= 57 for w in words) / n,
        sum(len(w) > 30 for w in words) / n,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        max(pairs.values(), default=0) / n,
    ])


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float


def with_features(docs: DataFrame, text_col: str = "text", name: str = "features") -> DataFrame:
    """``docs`` without its text and with ``name``, the features of the whole text (array of double)."""

    def make():
        def compute(texts: list[bytes]) -> list[pa.Array]:
            return [pa.array([features(t) for t in texts], pa.list_(pa.float64()))]

        return compute

    return from_texts(docs, text_col, f"{name} array<double>", make, keep_text=False)


def _blocks(rows: DataFrame, n: dict[int, int], size: int) -> DataFrame:
    """(block, poor, good): the features of all ``rows`` (row, label, x) dealt to blocks that hold some of both labels.

    ``row`` is what monotonically_increasing_id gives. A label with fewer rows than there are blocks has each of its
    rows in several blocks, any other row is in one.
    """
    count = -(-max(n.values()) // size)
    part = F.shiftright("row", 33)
    held = rows.groupBy("label", part.alias("part")).agg(F.count("*").alias("n"))
    # One row a label and a file's part.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("label").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("label", "part").orderBy("row")) - 1
    ranked = rows.withColumn("part", part).withColumn("nth", nth).join(
        F.broadcast(held.select("label", "part", before.alias("before"))), ["label", "part"]
    )
    rank = F.col("nth") + F.col("before")
    of_label = F.when(F.col("label") == 1, n[1]).otherwise(n[0])
    places = F.when(of_label >= count, F.array(rank % count)).otherwise(F.sequence(rank, F.lit(count - 1).cast("long"), of_label.cast("long")))
    dealt = ranked.select("label", "x", F.explode(places).alias("block"))
    listed = [F.sort_array(F.collect_list(F.when(F.col("label") == k, F.col("x")))).alias(name) for k, name in enumerate(("poor", "good"))]
    return stored(dealt.groupBy("block").agg(*listed), "blocks")


def _scaled(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / spread, -8, 8)


def linear(x: Column, model: Model) -> Column:
    """The linear score of a column of features."""
    terms = zip(model.mean.tolist(), model.spread.tolist(), model.weights.tolist(), strict=True)
    parts = [F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (x[k] - m) / d)) * w for k, (m, d, w) in enumerate(terms)]
    return F.aggregate(F.array(*parts), F.lit(0.0), lambda a, b: a + b)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, key_col: str = "doc_id", text_col: str = "text", **options) -> Model:
    """``fit_features`` of texts. A NULL text counts as empty."""
    featured = with_features(docs.select(key_col, text_col), text_col)
    return fit_features(featured, labels, label_col, key_col, **options)


def fit_features(featured: DataFrame, labels: DataFrame, label_col: str, key_col: str = "doc_id", features_col: str = "features",
                 pairs: int = PAIRS, block: int = BLOCK, rounds: int = 50) -> Model:
    """A model of all documents that ``labels`` (key, label) marks 1 (good) or 0 (poor), of their features.

    Without rows of both classes there is no pair: all texts then get the same score, kept if there is any good row or
    no row at all.
    """
    keyed = featured.select(F.col(key_col).alias("key"), F.col(features_col).alias("x"))
    rows, n = labelled(keyed.withColumn("row", F.monotonically_increasing_id()), labels, key_col, label_col)
    width = len(FEATURES)
    if len(n) < 2:
        return Model(np.zeros(width), np.ones(width), np.zeros(width), np.inf if 0 in n else -np.inf)
    x = [F.col("x")[k] for k in range(width)]
    moments = np.array(rows.agg(*[f(c) for f in (F.avg, F.stddev_pop) for c in x]).first(), dtype=float)
    mean, spread = moments[:width], moments[width:]
    spread[spread < 1e-9] = 1
    blocks = _blocks(rows, n, block)

    def derivatives(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def make(batch):
            total = np.zeros(2 + width + width * width)
            for k in range(batch.num_rows):
                poor, good = (
                    _scaled(batch[name][k].values.flatten().to_numpy().reshape(-1, width), mean, spread) for name in ("poor", "good")
                )
                rng = np.random.default_rng(batch["block"][k].as_py())
                count = pairs * max(len(poor), len(good))
                better, worse = (
                    np.concatenate([rng.permutation(len(x)) for _ in range(-(-count // len(x)))])[:count] for x in (good, poor)
                )
                difference = good[better] - poor[worse]
                z = difference @ w
                wrong = sigmoid(-z)
                total[:2] += count, np.logaddexp(0, -z).sum()
                total[2 : 2 + width] -= difference.T @ wrong
                total[2 + width :] += ((difference * (wrong * (1 - wrong))[:, None]).T @ difference).ravel()
            return total

        total = summed(blocks, 2 + width + width * width, make)
        total[1:] /= total[0]
        hessian = total[2 + width :].reshape(width, width) + 2e-3 * np.eye(width)
        return float(total[1] + 1e-3 * (w @ w)), total[2 : 2 + width] + 2e-3 * w, hessian

    w = newton(derivatives, np.zeros(width), rounds)

    ranking = Model(mean, spread, w, 0.0)
    scores = stored(rows.select(linear(F.col("x"), ranking).alias("s")), "scores")
    below, above = (nth_least(scores, "s", k) for k in (n[0] - 1, n[0]))
    # The middle of the gap; equal scores on both sides of it are kept.
    return ranking._replace(threshold=(below + above) / 2 if above - below > 1e-9 else below - 1e-9)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score", keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` without its text and with ``name``: 0 to 1, ``keep_at`` at the model's quantile threshold.

    NULL, empty and blank texts all have zero features and are scored by them. Each row is scored by its text alone;
    other columns pass through.
    """
    held = free_name(docs, "features")
    return score_features(with_features(docs, text_col, held), model, held, name, keep_at)


def score_features(featured: DataFrame, model: Model, features_col: str = "features", name: str = "score", keep_at: float = KEEP_AT) -> DataFrame:
    """``score`` of texts whose features are known; ``features_col`` is dropped."""
    z = linear(F.col(features_col), model) - F.lit(float(model.threshold)) + float(np.log(keep_at / (1 - keep_at)))
    return featured.withColumn(name, 1 / (1 + F.exp(-z))).drop(features_col)

"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are put into quantile bins. Boosting goes through the features in
turn, each time with one shallow tree on one feature, which only adds to that
feature's lookup table; then the strongest pairs get tables over two bins in the same
way. A score is the sum of looked-up values. The fit runs on the driver over a bounded
sample of labelled rows (SAMPLE, a parameter); features and scores cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm.counts import COUNTS, counts_of, per_text
from tidemark.llm.words import SPACED, Hasher, chunks, find_words, mix, released, utf8
from tidemark.session import write_and_read

NAME = "op4_quality_gam"
SQL = None

#: the most labelled rows that the model is fitted to, taken in the order of a hash of their id
SAMPLE = 20_000
BINS = 32
ROUNDS, PAIR_ROUNDS, RATE, PAIRS = 120, 60, 0.15, 4
#: least rows in a leaf, and what is added to its weight
LEAF, RIDGE = 20, 1.0
CUTOFF = 0.3

FEATURES = (
    "log_words",
    "word_length",
    "symbols",
    "repeated_lines",
    "repeated_words",
    "capitals",
    "distinct_words",
    "digits",
    "marks",
    "line_length",
    "beyond_ascii",
)

_DIGIT, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK[list(b"!?.,;:")] = True


def text_features(texts: pa.Array, hasher: Hasher) -> np.ndarray:
    """FEATURES (columns) of every text (rows); a null text counts as empty."""
    data, offsets = utf8(texts)
    out = [np.zeros((0, len(FEATURES)))]
    for a, b in chunks(offsets):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        count = dict(zip(COUNTS, counts_of(part, bounds, hasher), strict=True))
        words = find_words(part, bounds, SPACED)
        hashes = hasher.ranges(part, words.starts, words.ends)
        with np.errstate(over="ignore"):
            keys = mix(hashes + mix(words.text.astype(np.uint64)))
        _, first = np.unique(keys, return_index=True)
        distinct = np.bincount(words.text[first], minlength=b - a)
        n, chars = np.maximum(count["n_words"], 1), np.maximum(count["word_chars"], 1)
        lines = np.maximum(count["n_lines"], 1)
        out.append(
            np.stack(
                [
                    np.log1p(count["n_words"]),
                    chars / n,
                    count["n_symbols"] / chars,
                    count["n_dup_lines"] / lines,
                    count["n_repeat_words"] / n,
                    count["n_upper"] / chars,
                    distinct / n,
                    per_text(_DIGIT[part], bounds) / chars,
                    per_text(_MARK[part], bounds) / chars,
                    np.log1p(count["n_chars_all"] / lines),
                    per_text(part >= 0xC0, bounds) / chars,
                ],
                axis=1,
            )
        )
    return np.concatenate(out)


@F.arrow_udf(ArrayType(DoubleType()))
def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    hasher = Hasher()
    for texts in released(batches):
        found = text_features(texts, hasher)
        bounds = pa.array(np.arange(0, found.size + 1, len(FEATURES)), pa.int32())
        yield pa.ListArray.from_arrays(bounds, pa.array(found.ravel()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _leaf(g, h):
    return g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def _cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """The best cut of a row of bins: gain, and bins on its left (0: none)."""
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(left_g):
        return 0.0, 0
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gain = np.where((left_n >= LEAF) & (n.sum() - left_n >= LEAF), gain, 0.0)
    best = int(gain.argmax())
    return (float(gain[best]), best + 1) if gain[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of the bins by a tree of `depth` cuts."""
    _, at = _cut(g, h, n) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    return np.concatenate([_tree(g[:at], h[:at], n[:at], depth - 1), _tree(g[at:], h[at:], n[at:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and table of the best cross cut of a table of bins into four."""
    sums = [np.cumsum(np.cumsum(x, 0), 1) for x in (g, h, n)]
    gain, leaves = 0.0, []
    for x in range(2):
        for y in range(2):
            part = []
            for s in sums:
                corner, right, below, all_ = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
                part.append(
                    [[corner, right - corner], [below - corner, all_ - right - below + corner]][x][y]
                )
            leaves.append(part)
            gain = gain + _gain(part[0], part[1])
    enough = np.min([p[2] for p in leaves], axis=0) >= LEAF
    gain = np.where(enough, gain - _gain(g.sum(), h.sum()), 0.0)
    table = np.zeros_like(g)
    if gain.size and gain.max() > 1e-9:
        i, j = np.unravel_index(gain.argmax(), gain.shape)
        for k, (rows, cols) in enumerate(
            [(slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
             (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))]
        ):
            table[rows, cols] = _leaf(leaves[k][0][i, j], leaves[k][1][i, j])
        return float(gain[i, j]), table
    return 0.0, table


@dataclass
class Model:
    """Lookup tables: one per feature, and one per chosen pair of features."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.cuts and len(x):
            b = self.bins(x)
            for k, table in enumerate(self.tables):
                total += table[b[:, k]]
            for i, j, table in self.pairs:
                total += table[b[:, i], b[:, j]]
        return _sigmoid(total)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of labels y (0, 1) by features x; with no rows it says one half, with one kind of label its share."""
    if not len(y):
        return Model()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(base=float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(x[:, k], quantiles)) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    b = model.bins(x)
    total = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            p = _sigmoid(total)
            g, h, n = (np.bincount(b[:, k], w, len(table)) for w in (y - p, p * (1 - p), None))
            step = RATE * _tree(g, h, n)
            table += step
            total += step[b[:, k]]

    def sums(i: int, j: int):
        shape = (len(model.tables[i]), len(model.tables[j]))
        at, p = b[:, i] * shape[1] + b[:, j], _sigmoid(total)
        return [np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p), None)]

    n = len(model.tables)
    ranked = sorted(((_quadrants(*sums(i, j))[0], i, j) for i in range(n) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for g, i, j in ranked[:PAIRS] if g > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            step = RATE * _quadrants(*sums(i, j))[1]
            table += step
            total += step[b[:, i], b[:, j]]
    return model


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> DataFrame:
    """Per row of `docs`: id, held_out, score, predicted.

    Learns from labelled rows whose crc32(id as text) mod 5 is not 0. Null and empty
    texts get the score of a text without words; rows without an id are not held out
    and never learned from; null labels are left out; a label that repeats counts as
    often. Other columns do not matter. Features are written to the shared folder.
    """
    rest = F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5, F.lit(1))
    rows = docs.select(F.col(id), (rest == 0).alias("held_out"), features(F.coalesce(F.col(text), F.lit(""))).alias("_x"))
    rows = write_and_read(rows, "features")
    known = labels.where(F.col(label).isNotNull()).select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_y"))
    learned = (
        rows.where(~F.col("held_out"))
        .join(known, F.col(id) == F.col("_id"))
        .select("_x", "_y", F.xxhash64("_id").alias("_order"), "_id")
        .orderBy("_order", "_id", "_y", "_x")
        .limit(sample)
        .collect()
    )
    x = np.array([r["_x"] for r in learned]).reshape(-1, len(FEATURES))
    model = fit(x, np.array([r["_y"] for r in learned], float))

    @F.pandas_udf(DoubleType())
    def score(vectors: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(vectors.tolist()).reshape(-1, len(FEATURES))))

    return rows.select(id, "held_out", score("_x").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= CUTOFF, 1).otherwise(0)
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return classify(docs, spark.read.parquet(f"{folder}/labels.parquet"))

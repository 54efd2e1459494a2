"""Quality rules with robust multivariate outliers.

Every text gets counts (`text_counts`) and a transformed statistic vector. Per
language and source, the minimum-covariance-determinant estimate of centre and
scatter is found by concentration steps over all rows: some from each of several
starts, then more from the one whose determinant is the smallest. A document whose
Mahalanobis distance is beyond the cutoff is rejected, as is one that fails the
base rules.

A concentration step is one aggregation: rows are summed (count, sum, products)
by group and logarithmic bin of their present distance, so a group of any size
shrinks to at most BINS rows per task before the shuffle; the bins up to the
wanted share of rows then give the next centre and scatter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.counts import COUNTS, counts_of
from tidemark.llm.words import Hasher, chunks, released, utf8
from tidemark.session import write_and_read

NAME = "op9_quality_rules"
SQL = None

BASE = COUNTS[:5]

#: the least rows for which a language and source has an estimate of its own
MIN_ROWS = 200
#: share of a group's rows that the estimate is made from
SHARE = 0.75
#: concentration steps from every start, then from the best one
START_STEPS, STEPS = 2, 4
#: quantile of the distance beyond which a document is rejected
QUANTILE = 1 - 1e-9
BINS = 256
#: least standard deviation of each feature, so that constant features do not reject
FLOORS = (0.35, 0.08, 0.03, 0.15, 0.15, 0.06)
#: the standard deviations that are taken for what an estimate from fewer than the least rows lacks
PRIOR = (1.5, 0.5, 0.1, 0.3, 0.3, 0.15)
P = len(FLOORS)

def count_texts(texts: pa.Array, hasher: Hasher) -> np.ndarray:
    """COUNTS (rows) of every text (columns); a null text counts as empty."""
    data, offsets = utf8(texts)
    parts = [
        counts_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], hasher) for a, b in chunks(offsets)
    ]
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(COUNTS), 0), np.int64)


@F.arrow_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def text_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    hasher = Hasher()
    for texts in released(batches):
        yield pa.StructArray.from_arrays([pa.array(row) for row in count_texts(texts, hasher)], names=list(COUNTS))


def features(counts: Column) -> list[Column]:
    """The transformed statistics, each near normal for plain prose."""
    words = F.greatest(counts["n_words"], F.lit(1))
    chars = F.greatest(counts["word_chars"], F.lit(1))
    return [
        F.log(words),
        F.log(chars / words),
        F.sqrt(counts["n_symbols"] / chars),
        F.sqrt(counts["n_dup_lines"] / F.greatest(counts["n_lines"], F.lit(1))),
        F.sqrt(counts["n_repeat_words"] / words),
        F.sqrt(counts["n_upper"] / chars),
    ]


def chi2_below(x: float, p: int) -> float:
    """P(chi-squared with an even number p of degrees <= x)."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(p // 2):
        total += term
        term *= half / (k + 1)
    return 1 - math.exp(-half) * total


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, p) < q else (low, mid)
    return high


def _bin(distance: Column) -> Column:
    """32 bins per power of ten, from 1e-4 on."""
    return F.least(F.greatest(F.floor(F.log10(F.greatest(distance, F.lit(1e-4))) * 32) + 128, F.lit(0)), F.lit(BINS - 1))


PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _distance(x: list[Column]) -> Column:
    d = [x[i] - F.col("_centre")[i] for i in range(P)]
    terms = [d[i] * d[j] * F.col("_precision")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


_ESTIMATE = "_group string, _start int, _det double, _centre array<double>, _precision array<double>"


def _symmetric(sums: np.ndarray) -> np.ndarray:
    out = np.zeros((P, P))
    for k, (i, j) in enumerate(PAIRS):
        out[i, j] = out[j, i] = sums[k]
    return out


def _estimate(group, start, centre: np.ndarray, scatter: np.ndarray) -> pd.DataFrame:
    scatter = scatter + np.diag(np.square(FLOORS))
    precision = np.linalg.inv(scatter)
    return pd.DataFrame(
        {
            "_group": [group],
            "_start": [start],
            "_det": [float(np.linalg.slogdet(scatter)[1])],
            "_centre": [centre.tolist()],
            "_precision": [[precision[i, j] for i, j in PAIRS]],
        }
    )


def _starts(rows: pd.DataFrame) -> pd.DataFrame:
    """The starts of each group, about its medians: the quartiles alone, these with the correlations of the scores'
    hyperbolic tangents, and with those of their directions."""
    found = []
    for row in rows.itertuples(index=False):
        centre, spread = np.array(row.centre), np.array(row.spread)
        shapes = [np.eye(P)]
        for sums in (row.tanh, row.sign):
            shape = _symmetric(np.array(sums)) / row.n + np.eye(P) * 1e-6
            shapes.append(shape / np.sqrt(np.outer(np.diag(shape), np.diag(shape))))
        found += [_estimate(row.group, k, centre, shape * np.outer(spread, spread)) for k, shape in enumerate(shapes)]
    return pd.concat(found)


def _concentrate(min_rows: int):
    def concentrated(bins: pd.DataFrame) -> pd.DataFrame:
        """Centre and inverse scatter of the nearest SHARE of one group, from its at most BINS sums."""
        bins = bins.sort_values("_bin")
        count = bins["_n"].to_numpy()
        total = count.sum()
        upto = int(np.searchsorted(np.cumsum(count), SHARE * total)) + 1
        sums = np.array(bins["_sums"].tolist())[:upto].sum(axis=0)
        n = count[:upto].sum()
        centre = sums[:P] / n
        scatter = _symmetric(sums[P:] / n) - np.outer(centre, centre)
        share = min(n / total, 1.0)
        if share < 1:  # makes the scatter of the central rows that of all rows, were they normal
            scatter *= share / chi2_below(chi2_quantile(share, P), P + 2)
        if total < min_rows:
            scatter = (total * scatter + (min_rows - total) * np.diag(np.square(PRIOR))) / min_rows
        return _estimate(bins["_group"].iloc[0], bins["_start"].iloc[0], centre, scatter)

    return concentrated


def estimates(vectors: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The estimate of each group of `vectors` (_group, _x array of P doubles): _group, _centre, _precision.

    Each step's estimates, a few rows per group, are written and read again: their size is
    then known to the planner, which broadcasts them while they are small.
    """
    x = [F.col("_x")[i] for i in range(P)]
    cuts = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = vectors.groupBy("_group").agg(
        *[F.percentile_approx(x[i], cuts, F.lit(1000)).alias(f"_q{i}") for i in range(P)]
    )
    spread = [F.greatest((F.col(f"_q{i}")[2] - F.col(f"_q{i}")[0]) / 1.349, F.lit(FLOORS[i])) for i in range(P)]
    scales = quartiles.select(
        F.col("_group").alias("group"),
        F.array(*[F.col(f"_q{i}")[1] for i in range(P)]).alias("centre"),
        F.array(*spread).alias("spread"),
    )
    scales = write_and_read(scales, "scales")
    z = [(x[i] - F.col("centre")[i]) / F.col("spread")[i] for i in range(P)]
    scored = vectors.join(scales, F.col("_group") == F.col("group")).select("group", "centre", "spread", F.array(*z).alias("z"))
    scored = scored.withColumn("length", F.sqrt(F.aggregate("z", F.lit(0.0), lambda a, v: a + v * v)))
    scored = scored.withColumn("u", F.transform("z", lambda v: F.when(F.col("length") > 0, v / F.col("length")).otherwise(F.lit(0.0))))
    scored = scored.withColumn("t", F.transform("z", F.tanh))
    products = {name: F.array(*[F.sum(F.col(c)[i] * F.col(c)[j]) for i, j in PAIRS]) for name, c in (("tanh", "t"), ("sign", "u"))}
    shapes = scored.groupBy("group").agg(
        F.count("*").alias("n"), F.any_value("centre").alias("centre"), F.any_value("spread").alias("spread"),
        *[v.alias(k) for k, v in products.items()],
    )
    found = shapes.groupBy("group").applyInPandas(_starts, _ESTIMATE)
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i, j in PAIRS]
    for step in range(START_STEPS + STEPS):
        binned = (
            vectors.join(write_and_read(found, "estimates"), "_group")
            .groupBy("_group", "_start", _bin(_distance(x)).alias("_bin"))
            .agg(F.count("*").alias("_n"), F.array(*sums).alias("_sums"))
        )
        found = binned.groupBy("_group", "_start").applyInPandas(_concentrate(min_rows), _ESTIMATE)
        if step == START_STEPS - 1:
            best = F.min(F.struct("_det", "_start", "_centre", "_precision")).alias("_best")
            found = found.groupBy("_group").agg(best).select("_group", "_best.*")
    return write_and_read(found.select("_group", "_centre", "_precision"), "estimates")


def group_names(rows: DataFrame, min_rows: int) -> DataFrame:
    """The group of each _lang and _source of `rows`: the two themselves; where these have
    too few rows, what is left of the language; then what is left of all; else `every`, all rows of the table."""
    sizes = write_and_read(rows.groupBy("_lang", "_source").agg(F.count("*").alias("_n")), "sizes")
    rare = F.col("_n") < min_rows
    left = F.sum(F.when(rare, F.col("_n"))).over(Window.partitionBy("_lang"))
    lang = F.coalesce(F.concat(F.lit("l"), F.col("_lang")), F.lit("n"))
    source = F.coalesce(F.concat(F.lit("s"), F.col("_source")), F.lit("n"))
    named = sizes.withColumn("_left", left)
    few = rare & (F.col("_left") < min_rows)
    rest = named.where(few).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rest"))
    group = (
        F.when(~rare, F.concat_ws("/", F.lit("one"), lang, source))
        .when(~few, F.concat_ws("/", F.lit("lang"), lang))
        .when(F.col("_rest") >= min_rows, F.lit("all"))
        .otherwise(F.lit("every"))
    )
    # `rest` is one row
    return named.join(F.broadcast(rest), F.lit(True)).select("_lang", "_source", group.alias("_group"))


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_rows: int = MIN_ROWS,
    quantile: float = QUANTILE,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The `carry` columns of `docs` (all by default) with the COUNTS, base_failed,
    distance (null: the base rules failed) and kept.

    A null or empty text has no words and fails the base rules. Null languages and
    sources are groups like others. Texts that fail the base rules take no part in
    the estimates. Groups below `min_rows` are judged with the rest of their
    language, then of all; a rest that is still smaller is judged by the estimate of
    all rows of the table. Where these are fewer than `min_rows` as well, what is
    missing counts as rows that scatter by PRIOR. Rows that repeat are judged alike; columns of `docs` named as a new one
    are replaced. The counted rows are written to the shared folder and read again,
    so texts are counted once and never shuffled.
    """
    new = {*COUNTS, "base_failed", "distance", "kept"}
    columns = [c for c in (carry or docs.columns) if c not in new]
    counts = text_counts(F.coalesce(F.col(text), F.lit("")))
    marked = docs.select(
        *columns,
        F.col(lang).cast("string").alias("_lang"),
        F.col(source).cast("string").alias("_source"),
        counts.alias("_counts"),
    )
    n, repeated = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    rows = write_and_read(marked.withColumn("_failed", (n < 50) | (100 * repeated > 50 * n)), "counts")

    sound = rows.where(~F.col("_failed")).select("_lang", "_source", F.array(*features(F.col("_counts"))).alias("_x"))
    names = write_and_read(group_names(sound, min_rows), "groups")
    at = F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s"))
    renamed = names.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), "_group")
    vectors = sound.join(renamed.where("_group <> 'every'"), at).select("_group", "_x")
    if not names.where("_group = 'every'").isEmpty():
        vectors = vectors.union(sound.select(F.lit("every"), "_x"))
    found = estimates(vectors, min_rows)
    table = write_and_read(renamed.join(found, "_group").drop("_group"), "table")
    near = F.coalesce(F.col("_distance"), F.lit(0.0)) <= chi2_quantile(quantile, P)
    return (
        rows.join(table, at, "left")
        .withColumn(
            "_distance", F.when(F.col("_centre").isNotNull() & ~F.col("_failed"), _distance(features(F.col("_counts"))))
        )
        .select(
            *columns,
            *[F.col(f"_counts.{c}").alias(c) for c in COUNTS],
            F.col("_failed").alias("base_failed"),
            F.col("_distance").alias("distance"),
            (~F.col("_failed") & near).alias("kept"),
        )
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return judge(docs, carry=["doc_id"]).select("doc_id", *BASE, "base_failed", "distance", "kept")

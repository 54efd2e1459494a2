import random

import numpy as np

from tests.llm.plain import EDGES, word_counts
from tidemark.llm import quality_gam, quality_rules


def test_counts_agree_with_plain_ones(spark, data_dir, documents):
    got = {r["doc_id"]: r for r in quality_rules.query(spark, data_dir).collect()}
    assert len(got) == len(documents)
    for doc, text, *_ in documents:
        want, row = word_counts(text), got[doc]
        assert tuple(row[c] for c in quality_rules.BASE) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_edges_and_clashing_columns(spark, edges):
    got = quality_rules.judge(edges.withColumn("kept", edges.text).withColumn("_x", edges.n))
    rows = got.collect()
    assert len(rows) == len(EDGES)
    counts = {(r["doc_id"], r["text"]): tuple(r[c] for c in quality_rules.BASE) for r in rows}
    assert all(counts[i, t] == word_counts(t) for i, t in EDGES)
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)  # few rows that differ: wide scatter
    assert quality_rules.judge(edges.where("false")).count() == 0


def test_outliers_go_and_plain_rows_stay(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioubcd") for _ in range(rng.randrange(2, 9)))
    plain = [(k, " ".join(word() for _ in range(rng.randrange(60, 200)))) for k in range(400)]
    odd = [(1000 + k, " ".join(word() + "###" for _ in range(100))) for k in range(20)]
    rows = [(i, t, "en", f"s{i % 2}") for i, t in plain + odd] + [(-1, plain[0][1], "xx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, min_rows=100).collect()}
    assert all(kept[i] == (i < 1000) for i in kept)


def test_small_groups_are_judged_together(spark):
    rows = spark.createDataFrame(
        [("en", "a")] * 5 + [("en", "b")] * 2 + [("en", None)] * 2 + [("de", "a")] + [(None, None)], "_lang string, _source string"
    )
    names = {(r[0], r[1]): r[2] for r in quality_rules.group_names(rows, 4).collect()}
    assert names["en", "a"] == "one/len/sa" and names["en", "b"] == names["en", None] == "lang/len"
    assert names["de", "a"] == names[None, None] == "every"


def test_outlier_of_a_small_table_goes(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioubcd") for _ in range(rng.randrange(2, 9)))
    plain = [(k, " ".join(word() for _ in range(rng.randrange(60, 400)))) for k in range(150)]
    rows = [(i, t, "en", "s") for i, t in [*plain, (1000, " ".join(f"w{k}####" for k in range(100)))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert all(r["kept"] == (i < 1000) and r["distance"] is not None for i, r in got.items())
    few = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs.where("doc_id < 3")).collect()}
    assert few == {0: True, 1: True, 2: True}


def _plain_determinant(x, steps=30, starts=60):
    """FAST-MCD on all rows in memory: the log determinant of the best of many random starts."""
    rng, n = np.random.default_rng(2), len(x)
    h, best = int(np.ceil(quality_rules.SHARE * n)), np.inf
    for _ in range(starts):
        part = x[rng.choice(n, 2 * x.shape[1], replace=False)]
        for _ in range(steps):
            centre, scatter = part.mean(axis=0), np.cov(part.T, bias=True) + np.eye(x.shape[1]) * 1e-9
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
            part = x[np.argsort(d)[:h]]
        best = min(best, np.linalg.slogdet(np.cov(part.T, bias=True))[1])
    return best


def test_estimate_is_near_the_least_determinant(spark):
    """A correlated group with a fifth of its rows off to one side, against many random starts in memory."""
    rng = np.random.default_rng(7)
    p = quality_rules.P
    mix = rng.normal(size=(p, p))
    x = np.vstack([rng.normal(size=(800, p)) @ mix * 3, rng.normal(size=(200, p)) * 0.5 + 40])
    rows = spark.createDataFrame([("g", r.tolist()) for r in x], "_group string, _x array<double>")
    found = quality_rules.estimates(rows).first()
    precision = quality_rules._symmetric(np.array(found["_precision"]))
    d = np.einsum("ij,jk,ik->i", x - found["_centre"], precision, x - found["_centre"])
    near = np.argsort(d)[: int(np.ceil(quality_rules.SHARE * len(x)))]
    assert near.max() < 800  # none of the rows that are off
    assert np.linalg.slogdet(np.cov(x[near].T, bias=True))[1] < _plain_determinant(x) + 0.1


def test_a_group_of_equal_rows(spark):
    """Ties: every quartile and scatter is nought, so the floors decide; the equal rows stay."""
    text = " ".join(f"wo{'abcdefghij'[k % 10]}rd{'xyz'[k // 10 % 3]}{k // 30 * 'e'}" for k in range(90))
    rows = [(k, text, "en", "s") for k in range(300)] + [(1000, text.replace(" ", " ## "), "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    assert all(got[k] == (k < 1000) for k in got)


def test_chi_squared():
    assert abs(quality_rules.chi2_quantile(0.95, 6) - 12.5916) < 1e-3


def test_classifier_after_rules(spark, data_dir):
    """Queries run in any order in one session: a used column function travels with no other."""
    quality_rules.query(spark, data_dir).count()
    assert quality_gam.query(spark, data_dir).count() > 0

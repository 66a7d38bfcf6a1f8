"""The forest and its threshold come from all labelled rows."""

import numpy as np
from pyspark.sql import functions as F

from starloom.llm import quality_rules as q


def _stats(spark, n):
    """Rows of statistics; every 50th is bad, every 1,000th good one is odd in its own way."""
    i, odd = F.col("id"), F.col("id") % 1000 == 7
    return spark.range(n).select(
        i.alias("doc_id"), F.lit(100).alias("n_words"), (400 + i * 7 % 201).alias("word_chars"),
        F.when(i % 50 == 0, 300).when(odd, i % 293).otherwise(i % 5).alias("n_symbols"),
        F.lit(0).alias("n_dup_lines"), F.lit(0).alias("n_repeat_words"),
        F.when(odd, i % 311).otherwise(i * 3 % 11).alias("n_upper"), (i % 3).alias("n_marks"),
        F.lit(5).alias("n_lines"))


def test_all_labelled_rows_are_fitted_and_calibrated(spark):
    n = 24_000  # more than a sample of 20,000
    stats = _stats(spark, n).cache()
    labels = spark.range(n).selectExpr("id AS doc_id", "int(id % 50 <> 0) AS quality")
    forest, threshold = q.fit(stats, labels)
    rows = np.array(stats.select("doc_id", *q.feature_columns()).collect(), float)
    good, x = rows[:, 0] % 50 != 0, rows[:, 1:]
    plain = q.Forest(x.min(axis=0), x.max(axis=0))
    plain.fill(plain.leaf_counts(x[good]))
    assert (plain.path == forest.path).all() and (plain.path_without == forest.path_without).all()
    scores = plain.score(x, good)
    least = np.sort(scores[good])[::-1][int(q.MAX_LOSS * good.sum())]
    beyond = np.sort(scores[~good & (scores > least)])
    assert np.isclose(threshold, (least + beyond[len(beyond) // 10]) / 2, rtol=1e-12)
    lost = (scores[good] > threshold).sum()
    assert lost <= q.MAX_LOSS * good.sum() and (scores[~good] > threshold).all()


def test_a_row_is_judged_without_itself():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.uniform(0, 1, (60, 2)), [[9.0, 9.0]]])
    whole = q.Forest(x.min(axis=0), x.max(axis=0))
    whole.fill(whole.leaf_counts(x))
    rest = q.Forest(x.min(axis=0), x.max(axis=0))
    rest.fill(whole.leaf_counts(x[:-1]))
    want = 2 ** (np.log2(rest.score(x[-1:])) * rest.norm / whole.norm)
    assert np.isclose(whole.score(x, np.ones(61, bool))[-1], want[0])


def test_value_at(spark):
    values = [0.5, 0.25, 0.25, 1e-9, 0.5000001, 0.9, 0.9, 2.0 ** -40] * 3
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for place in (0, 2, 7, 11, 23):
        assert q.value_at(df, "v", place) == sorted(values)[place]

"""Top-k lists from counter summaries are exact, proved or counted in full."""

import pytest
from pyspark.sql import functions as F

from pricelens.operators import profile
from pricelens.operators.profile import keep_top_categories, top_categories_per_column


def want(rows, k):
    out = []
    for c in range(len(rows[0])):
        counts = {}
        for r in rows:
            if r[c] is not None:
                counts[r[c]] = counts.get(r[c], 0) + 1
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]
        out += [("ab"[c], v, n, i) for i, (v, n) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("counters,candidates", [(1 << 16, 1_000), (64, 8)])
def test_skewed_flat_null_and_tied_columns(spark, monkeypatch, counters, candidates):
    monkeypatch.setattr(profile, "COUNTERS", counters)
    monkeypatch.setattr(profile, "CANDIDATES", candidates)
    rows = [(f"h{i % 3}" if i % 2 else f"r{i}", None if i % 7 == 0 else f"t{i % 500}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(5)
    for k in (1, 3, 10):
        assert sorted(map(tuple, top_categories_per_column(df, ["a", "b"], k).collect())) == want(rows, k)


def test_the_proof_fails_on_flat_counts_only(spark, monkeypatch):
    monkeypatch.setattr(profile, "COUNTERS", 128)
    monkeypatch.setattr(profile, "CANDIDATES", 16)
    full = []
    count_all = profile._top_of_all_values
    monkeypatch.setattr(profile, "_top_of_all_values", lambda df, columns, *a: full.append(list(columns)) or count_all(df, columns, *a))
    rows = [(f"h{i % 2}" if i % 4 else f"r{i}", f"t{i % 1_000}") for i in range(8_000)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert sorted(map(tuple, top_categories_per_column(df, ["a", "b"], 2).collect())) == want(rows, 2)
    assert full == [["b"]]


def test_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([(None, "x")], "a string, b string")
    assert [tuple(r) for r in top_categories_per_column(df, ["a", "b"], 3).collect()] == [("b", "x", 1, 1)]
    assert top_categories_per_column(df.limit(0), ["a", "b"], 3).count() == 0
    assert keep_top_categories(df.withColumn("n", F.lit(1)), "a").count() == 0

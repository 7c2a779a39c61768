"""Data profile: the numbers behind each summary chart, computed on executors.

Every statistic is an aggregation with map-side partial aggregation; the
driver only ever sees small statistics rows (min, max, quartiles…) that
parameterise a later pass.  Exact quartiles come from
``operators.quantiles.exact_quantiles``: a range-partitioned rank search in
which no task holds a whole group.
``exact=False`` switches to ``percentile_approx``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LABEL, PROFILE_CATEGORIES, TOP_K_CATEGORIES
from .quantiles import exact_quantiles, quantile_row

GRID_POINTS = 200


QUARTILES = [0.25, 0.5, 0.75]


def _approx_quantiles(c: str, probs) -> Column:
    return F.percentile_approx(c, F.array(*[F.lit(float(p)) for p in probs]), 100000)


def describe_numeric(df: DataFrame, columns, exact: bool = True) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max of each column, as one row per column.

    One aggregation pass computes the moments, extremes and distinct-count
    sketches of every column; the quartiles of all columns come from one
    quantile computation over the stacked ``(column_name, value)`` table.
    """
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(c).cast("bigint").alias(f"n{i}"), F.avg(c).alias(f"m{i}"),
                 F.stddev_samp(c).alias(f"s{i}"), F.min(c).cast("double").alias(f"lo{i}"),
                 F.max(c).cast("double").alias(f"hi{i}")]
        if not exact:
            aggs.append(_approx_quantiles(c, QUARTILES).alias(f"q{i}"))
    wide = df.agg(*aggs)
    if not exact:
        rows = ", ".join(f"'{c}', n{i}, m{i}, s{i}, lo{i}, q{i}[0], q{i}[1], q{i}[2], hi{i}"
                         for i, c in enumerate(columns))
        return wide.select(F.expr(
            f"stack({len(columns)}, {rows}) AS (column_name, count, mean, std, min, p25, p50, p75, max)"))
    w = wide.first()
    stats = df.sparkSession.createDataFrame(
        [(c, w[f"n{i}"], w[f"m{i}"], w[f"s{i}"], w[f"lo{i}"], w[f"hi{i}"]) for i, c in enumerate(columns)],
        "column_name string, count bigint, mean double, std double, min double, max double")
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.select(F.expr(f"stack({len(columns)}, {stack}) AS (column_name, v)"))
    q = quantile_row(exact_quantiles(long, "v", QUARTILES, by=["column_name"]), QUARTILES, ["column_name"])
    return stats.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
        F.col("q2").alias("p75"), "max")


def distribution_stats(df: DataFrame, c: str, exact: bool = True) -> dict:
    """n, min, max, stddev and quartiles of one column (small rows to the driver)."""
    return distribution_stats_of(df, [c], exact)[0]


def distribution_stats_of(df: DataFrame, columns, exact: bool = True) -> list[dict]:
    """The same of several columns, all from one aggregation and one quantile computation."""
    rows = {r["column_name"]: r for r in describe_numeric(df, columns, exact).collect()}
    names = dict(n="count", lo="min", hi="max", std="std", q1="p25", q2="p50", q3="p75")
    return [{k: rows[c][v] for k, v in names.items()} for c in columns]


def auto_bins(st: dict) -> int:
    """Bin count of the "auto" rule: the narrower of Sturges and Freedman–Diaconis widths."""
    n, lo, hi = st["n"], st["lo"], st["hi"]
    if not n or hi == lo:
        return 1
    span = hi - lo
    sturges = span / (math.log2(n) + 1.0)
    fd = 2.0 * (st["q3"] - st["q1"]) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil(span / width)))


def bin_index(c, lo: float, hi: float, k: int) -> Column:
    """Equal-width bin of ``c`` over [lo, hi] in k bins; ``hi`` falls in the last bin."""
    if hi == lo:
        return F.lit(0)
    w = (hi - lo) / k
    return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(k - 1))


def histogram(df: DataFrame, c: str = LABEL, bins: int | None = None, exact: bool = True) -> DataFrame:
    """``(bin, lo, hi, n)`` for every bin, empty bins included."""
    st = distribution_stats(df, c, exact)
    k = bins or auto_bins(st)
    lo, hi = st["lo"], st["hi"]
    w = (hi - lo) / k if hi != lo else 1.0
    counts = df.filter(F.col(c).isNotNull()).groupBy(bin_index(c, lo, hi, k).alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    spark = df.sparkSession
    edges = spark.range(k).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(counts, "bin", "left")
                 .select("bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("lo"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("hi"),
                         F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


#: Terms of the kernel series and its reach in bandwidths; see ``kde`` for the error they leave.
KDE_TERMS, KDE_REACH = 22, 9.0


def kde(df: DataFrame, c: str = LABEL, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian density on ``points`` grid points over [min, max], Scott bandwidth h.

    A fast Gauss transform: with boxes one bandwidth wide, t = (v - centre) / h
    and u = (x - centre) / h,

        exp(-(u - t)^2 / 2) = exp(-u^2 / 2) * sum over k of He_k(u) t^k / k!,

    He_k being Hermite polynomials, so a box is known by its moments, the sums of t^k.  One
    aggregation with partial sums makes them: what is shuffled is bounded by
    boxes times tasks, and boxes times reach is then a few thousand kernel
    values whatever the data.  As |t| <= 1/2 and |He_k(u)| exp(-u^2 / 4) <= 1.09 sqrt(k!),
    the terms left out are below 1e-16 of a kernel, and so are kernels further than
    ``KDE_REACH`` bandwidths away.  A column that is empty or constant has no density: no rows.
    """
    st = df.agg(F.count(c).alias("n"), F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi"),
                F.stddev_samp(c).alias("std")).first()
    n, lo, hi, std = st["n"], st["lo"], st["hi"], st["std"]
    if not std:
        return df.sparkSession.createDataFrame([], "j int, x double, density double")
    h = std * n ** (-0.2)
    step = (hi - lo) / (points - 1)
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    place = (F.col(c).cast("double") - F.lit(lo)) / F.lit(h)
    cells = df.filter(F.col(c).isNotNull()).select(F.floor(place).alias("box"), (place - F.floor(place) - F.lit(0.5)).alias("t"))
    moments = cells.groupBy("box").agg(*[F.sum(F.pow("t", F.lit(float(k))) if k else F.lit(1.0)).alias(f"m{k}") for k in range(KDE_TERMS)])
    scaled = F.array(*[F.col(f"m{k}") / F.lit(float(math.factorial(k))) for k in range(KDE_TERMS)])
    centre = F.lit(lo) + (F.col("box") + F.lit(0.5)) * F.lit(h)
    at = lambda x: F.least(F.greatest(x, F.lit(0)), F.lit(points - 1)).cast("int")
    first, last = at(F.floor((centre - F.lit(lo + KDE_REACH * h)) / F.lit(step))), at(F.ceil((centre - F.lit(lo - KDE_REACH * h)) / F.lit(step)))
    near = moments.select(centre.alias("centre"), scaled.alias("m"), F.explode(F.sequence(first, last)).alias("j"))
    x = F.lit(lo) + F.col("j") * F.lit(step)
    near = near.withColumn("u", (x - F.col("centre")) / F.lit(h))
    # He_(k+1)(u) = u He_k(u) - k He_(k-1)(u)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("before"), F.lit(1.0).alias("he"), F.lit(0.0).alias("k"))
    series = F.aggregate("m", start, lambda a, m: F.struct(
        (a["sum"] + a["he"] * m).alias("sum"), a["he"].alias("before"), (F.col("u") * a["he"] - a["k"] * a["before"]).alias("he"), (a["k"] + 1.0).alias("k")))
    kernel = F.exp(F.lit(-0.5) * F.col("u") * F.col("u")) * series["sum"]
    sums = near.groupBy("j").agg(F.sum(kernel).alias("s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("j"))
    density = F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) * F.lit(norm)
    return grid.join(F.broadcast(sums), "j", "left").select("j", x.alias("x"), density.alias("density"))  # at most ``points`` rows


def box_stats(df: DataFrame, c: str = LABEL, by: str | None = None, exact: bool = True) -> DataFrame:
    """Quartiles, whiskers at 1.5·IQR (most extreme data inside), outlier count.

    Two passes.  Without groups the quartiles are one small row and the
    fences become literals of the second pass.  With groups each row is
    equi-joined to its group's fences (one row per group; AQE broadcasts that
    table only when its measured size is under the threshold).  An empty
    column has null statistics and counts of 0.
    """
    if by is None:
        st = distribution_stats(df, c, exact)
        if not st["n"]:
            names = ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")
            none = {x: F.lit(None).cast("double").alias(x) for x in names}
            zero = {x: F.lit(0).cast("bigint").alias(x) for x in ("n", "n_outliers")}
            order = ("q1", "median", "q3", "n", "iqr", "whisker_low", "whisker_high", "n_outliers")
            return df.sparkSession.range(1).select(*[(none | zero)[x] for x in order])
        iqr = st["q3"] - st["q1"]
        f_lo, f_hi = st["q1"] - 1.5 * iqr, st["q3"] + 1.5 * iqr
        inside = F.col(c).between(F.lit(f_lo), F.lit(f_hi))
        return df.filter(F.col(c).isNotNull()).agg(
            F.lit(st["q1"]).alias("q1"), F.lit(st["q2"]).alias("median"), F.lit(st["q3"]).alias("q3"),
            F.count(F.lit(1)).cast("bigint").alias("n"), F.lit(iqr).alias("iqr"),
            F.min(F.when(inside, F.col(c))).cast("double").alias("whisker_low"),
            F.max(F.when(inside, F.col(c))).cast("double").alias("whisker_high"),
            F.count_if(~inside).cast("bigint").alias("n_outliers"))
    if exact:
        q = quantile_row(exact_quantiles(df, c, QUARTILES, by=[by]), QUARTILES, [by])
        q = q.select(by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    else:
        q = df.filter(F.col(c).isNotNull()).groupBy(by).agg(_approx_quantiles(c, QUARTILES).alias("q"))
        q = q.select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    fences = q.select(by, (F.col("q1") - 1.5 * F.col("iqr")).alias("f_lo"),
                      (F.col("q3") + 1.5 * F.col("iqr")).alias("f_hi"))
    joined = df.filter(F.col(c).isNotNull()).select(by, F.col(c).alias("v")).join(
        fences, by)
    inside = F.col("v").between(F.col("f_lo"), F.col("f_hi"))
    w = joined.groupBy(by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.min(F.when(inside, F.col("v"))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).cast("double").alias("whisker_high"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"))
    return q.join(w, by)


def category_counts(df: DataFrame, columns=PROFILE_CATEGORIES) -> DataFrame:
    """``(column_name, value, n)`` for each categorical column; nulls left out."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.select(F.expr(f"stack({len(columns)}, {stack}) AS (column_name, value)"))
    return long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


#: Counters of the summary behind a top-k list, and how many of its items are counted exactly.
COUNTERS, CANDIDATES = 1 << 16, 1_000


def top_categories(df: DataFrame, column: str, k: int = TOP_K_CATEGORIES) -> DataFrame:
    """The k most frequent values of ``column`` (ties by value)."""
    return top_categories_per_column(df, [column], k).select(F.col("value").alias(column), "n")


def top_categories_per_column(df: DataFrame, columns=PROFILE_CATEGORIES, k: int = TOP_K_CATEGORIES,
                              buckets: int = 64) -> DataFrame:
    """``(column_name, value, n, rank)``: the k most frequent values of each column, exactly.

    A first pass keeps a summary of ``COUNTERS`` counters a column, merged over
    tasks, whose counts are off by at most 3.5 / COUNTERS of the rows.  Its ``CANDIDATES`` first
    items are counted exactly in a second pass.  If the k-th best
    of them beats what any other value can have (the least estimate among the
    candidates plus twice that error), the list is proved right, and a
    vocabulary that grows with the data is never shuffled.  Where a column fails that
    proof (flat counts over a large vocabulary) all its values are counted; the result is the same.
    """
    k = int(k)
    text = {c: F.col(f"`{c}`").cast("string") for c in columns}
    items = max(CANDIDATES, 2 * k)
    summary = df.select(*[text[c].alias(f"c{i}") for i, c in enumerate(columns)]).agg(
        *[F.count(f"c{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.expr(f"approx_top_k(c{i}, {items}, {max(COUNTERS, items)})").alias(f"t{i}") for i in range(len(columns))]).first()
    spark, candidates, limits = df.sparkSession, [], {}
    for i, c in enumerate(columns):
        found = [r for r in summary[f"t{i}"] if r["item"] is not None]
        error = math.ceil(3.5 * summary[f"n{i}"] / max(COUNTERS, items))
        limits[c] = error + (min(r["count"] for r in found) + error if len(found) >= items - 1 else 0)
        candidates += [(c, r["item"]) for r in found]
    if not candidates:
        return spark.createDataFrame([], "column_name string, value string, n bigint, rank int")
    known = spark.createDataFrame(candidates, "column_name string, value string")
    exact = _cells(df, columns).join(F.broadcast(known), ["column_name", "value"], "left_semi").groupBy("column_name", "value").agg(  # bounded by CANDIDATES
        F.count(F.lit(1)).cast("bigint").alias("n"))
    rows = {}
    for r in exact.collect():
        rows.setdefault(r.column_name, []).append((r.column_name, r.value, r.n))
    proved, open_columns = [], []
    for c in columns:
        best = sorted(rows.get(c, []), key=lambda r: (-r[2], r[1].encode()))[:k]
        complete = limits[c] == 0 or (len(best) == k and best[-1][2] > limits[c])
        if complete:
            proved += [(*r, j) for j, r in enumerate(best, 1)]
        else:
            open_columns.append(c)
    out = spark.createDataFrame(proved, "column_name string, value string, n bigint, rank int")
    return out.unionByName(_top_of_all_values(df, open_columns, k, buckets)) if open_columns else out


def _cells(df: DataFrame, columns) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("c")).select("c.column_name", "c.value").where("value is not null")


def _top_of_all_values(df: DataFrame, columns, k: int, buckets: int) -> DataFrame:
    """The same from a count of every value: the k best of each (column, hash bucket), then the k best of
    the at most ``k × buckets`` survivors per column, so no task ever ranks a whole vocabulary."""
    from pyspark.sql import Window
    counts = category_counts(df, columns)
    order = [F.desc("n"), F.asc("value")]
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets))
    w1 = Window.partitionBy("column_name", bucket).orderBy(*order)
    pre = counts.withColumn("r1", F.row_number().over(w1)).filter(F.col("r1") <= k).drop("r1")
    w2 = Window.partitionBy("column_name").orderBy(*order)
    return pre.withColumn("rank", F.row_number().over(w2).cast("int")).filter(F.col("rank") <= k)


def keep_top_categories(df: DataFrame, column: str, k: int = TOP_K_CATEGORIES) -> DataFrame:
    """Rows whose ``column`` is among its k most frequent values.

    A left-semi join against the top-k table; that table has at most k rows,
    so broadcasting it is bounded whatever the data size.
    """
    top = top_categories(df, column, k).select(column)
    return df.join(F.broadcast(top), column, "left_semi")


def numeric_relation(df: DataFrame, y: str, xs) -> DataFrame:
    """``(x_column, corr, slope, intercept, n)`` of y on each x, one pass for all."""
    aggs = []
    for i, x in enumerate(xs):
        aggs += [F.corr(x, y).alias(f"c{i}"), F.regr_slope(F.col(y), F.col(x)).alias(f"b{i}"),
                 F.regr_intercept(F.col(y), F.col(x)).alias(f"a{i}"), F.regr_count(F.col(y), F.col(x)).alias(f"n{i}")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{x}', c{i}, b{i}, a{i}, n{i}" for i, x in enumerate(xs))
    return wide.select(F.expr(f"stack({len(xs)}, {rows}) AS (x_column, corr, slope, intercept, n)"))


def binned_2d(df: DataFrame, x: str, y: str = LABEL, x_bins: int | None = None, y_bins: int | None = None,
              discrete_x: bool = False) -> DataFrame:
    """Scatter as counts per (x bin, y bin); a discrete x keeps its own values."""
    sy, *others = distribution_stats_of(df, [y] if discrete_x else [y, x])
    ky = y_bins or auto_bins(sy)
    cols = [bin_index(y, sy["lo"], sy["hi"], ky).alias("y_bin")]
    if discrete_x:
        xcol = F.col(x).alias(x)
    else:
        sx = others[0]
        xcol = bin_index(x, sx["lo"], sx["hi"], x_bins or auto_bins(sx)).alias("x_bin")
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(xcol, *cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def profile(df: DataFrame, numeric=("Year", "Age", "kmDriven", LABEL), categories=PROFILE_CATEGORIES) -> dict:
    """Every summary of the exploration view as a DataFrame.

    Building the dict runs the small statistics passes (min, max, quartiles)
    that parameterise the binned summaries; the summaries themselves are lazy.
    """
    return {
        "shape": df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")),
        "describe": describe_numeric(df, list(numeric)),
        "histogram": histogram(df, LABEL),
        "kde": kde(df, LABEL),
        "box": box_stats(df, LABEL),
        "price_by_year": binned_2d(df, "Year", LABEL, discrete_x=True),
        "price_by_km": binned_2d(df, "kmDriven", LABEL),
        "relations": numeric_relation(df, LABEL, ["Year", "kmDriven"]),
        "category_counts": category_counts(df, list(categories)),
        **{f"box_by_{c}": box_stats(keep_top_categories(df, c), LABEL, by=c)
           for c in categories},
    }

"""Registered queries: the data profile (A8-A17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.profile import (binned_2d, box_stats, category_counts, describe_numeric, histogram, kde,
                                 keep_top_categories, numeric_relation, top_categories_per_column)
from ..oracles import with_listings
from ..registry import register
from ..schema import ID, LABEL, PROFILE_CATEGORIES, TOP_K_CATEGORIES
from .common import clean, materialized

NUMERIC = ["Year", "Age", "kmDriven", "AskPrice"]


def _r(c, k=4):
    return F.round(c if not isinstance(c, str) else F.col(c), k)


# --- describe ----------------------------------------------------------------

_DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 4) AS p25, round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS p50, "
    f"round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM clean"
    for c in NUMERIC)


@register("describe_numeric", with_listings(_DESCRIBE_SQL))
def q_describe_numeric(spark, sf_dir):
    """count, mean, std, min, quartiles, max of every numeric column (one pass)."""
    d = describe_numeric(materialized(spark, sf_dir, NUMERIC), NUMERIC)
    return d.select("column_name", "count", _r("mean").alias("mean"), _r("std").alias("std"), "min",
                    _r("p25").alias("p25"), _r("p50").alias("p50"), _r("p75").alias("p75"), "max")


# --- price distribution -------------------------------------------------------

def _auto_k_sql(col: str, src: str = "clean", name: str = "k2") -> str:
    return f"""
st_{name} AS (SELECT count({col}) AS n, min({col}) AS lo, max({col}) AS hi,
  quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src}),
{name} AS (SELECT n, lo, hi, CASE WHEN hi = lo THEN 1 ELSE greatest(1, CAST(ceil((hi - lo) / (CASE WHEN
   2.0*(q3-q1)*pow(n, -1.0/3.0) > 0 THEN least(2.0*(q3-q1)*pow(n, -1.0/3.0), (hi - lo)/(log2(n)+1.0))
   ELSE (hi - lo)/(log2(n)+1.0) END)) AS INTEGER)) END AS k FROM st_{name})"""


def _bin_sql(col: str, name: str) -> str:
    return (f"CASE WHEN {name}.hi = {name}.lo THEN 0 ELSE least(CAST(floor(({col} - {name}.lo) / "
            f"(({name}.hi - {name}.lo) / {name}.k)) AS INTEGER), {name}.k - 1) END")


@register("price_histogram", with_listings(f"""
WITH {_auto_k_sql('AskPrice')},
counts AS (SELECT {_bin_sql('AskPrice', 'k2')} AS bin, count(*) AS n FROM clean, k2 GROUP BY 1),
allb AS (SELECT CAST(unnest(range(k)) AS INTEGER) AS bin FROM k2)
SELECT a.bin, round(k2.lo + a.bin * ((k2.hi - k2.lo) / k2.k), 4) AS lo,
 round(k2.lo + (a.bin + 1) * ((k2.hi - k2.lo) / k2.k), 4) AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM allb a CROSS JOIN k2 LEFT JOIN counts c ON c.bin = a.bin"""))
def q_price_histogram(spark, sf_dir):
    """Price histogram with automatic equal-width bins (narrower of Sturges and Freedman–Diaconis).

    Two passes (statistics, then bins) over the pruned price column, written
    once to the checkpoint folder.
    """
    h = histogram(materialized(spark, sf_dir, [LABEL]), LABEL)
    return h.select("bin", _r("lo").alias("lo"), _r("hi").alias("hi"), "n")


@register("price_kde", with_listings("""
WITH st AS (SELECT count(*) AS n, min(AskPrice) AS lo, max(AskPrice) AS hi, stddev_samp(AskPrice) AS sd FROM clean),
p AS (SELECT n, lo, hi, sd * pow(n, -0.2) AS h, (hi - lo) / 199 AS step FROM st),
vc AS (SELECT AskPrice AS v, count(*) AS w FROM clean GROUP BY 1),
g AS (SELECT CAST(unnest(range(200)) AS INTEGER) AS j)
SELECT g.j, round(p.lo + g.j * p.step, 4) AS x,
 round(sum(vc.w * exp(-0.5 * ((p.lo + g.j * p.step - vc.v) / p.h) * ((p.lo + g.j * p.step - vc.v) / p.h)))
   * (1.0 / (p.n * p.h * sqrt(2.0 * pi()))) * 1e6, 6) AS density_e6
FROM g CROSS JOIN p CROSS JOIN vc GROUP BY g.j, p.lo, p.step, p.n, p.h"""))
def q_price_kde(spark, sf_dir):
    """Gaussian density of the price on 200 points, Scott bandwidth (density × 10⁶)."""
    d = kde(materialized(spark, sf_dir, [LABEL]), LABEL)
    return d.select("j", _r("x").alias("x"), _r(F.col("density") * 1e6, 6).alias("density_e6"))


_BOX_SQL = """
q AS (SELECT {key} quantile_cont(AskPrice, 0.25) AS q1, quantile_cont(AskPrice, 0.5) AS median,
  quantile_cont(AskPrice, 0.75) AS q3, count(*) AS n FROM {src} {group}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS f_lo, q3 + 1.5 * (q3 - q1) AS f_hi FROM q)
SELECT {fkey} round(f.q1, 4) AS q1, round(f.median, 4) AS median, round(f.q3, 4) AS q3, CAST(f.n AS BIGINT) AS n,
 round(f.iqr, 4) AS iqr,
 CAST(min(s.AskPrice) FILTER (WHERE s.AskPrice BETWEEN f.f_lo AND f.f_hi) AS DOUBLE) AS whisker_low,
 CAST(max(s.AskPrice) FILTER (WHERE s.AskPrice BETWEEN f.f_lo AND f.f_hi) AS DOUBLE) AS whisker_high,
 CAST(count(*) FILTER (WHERE NOT (s.AskPrice BETWEEN f.f_lo AND f.f_hi)) AS BIGINT) AS n_outliers
FROM {src} s JOIN f ON {on} GROUP BY {fkey} f.q1, f.median, f.q3, f.n, f.iqr"""


def _box_out(b, keys=()):
    return b.select(*keys, _r("q1").alias("q1"), _r("median").alias("median"), _r("q3").alias("q3"), "n",
                    _r("iqr").alias("iqr"), "whisker_low", "whisker_high", "n_outliers")


@register("price_box", with_listings("WITH " + _BOX_SQL.format(key="", src="clean", group="", fkey="", on="true")))
def q_price_box(spark, sf_dir):
    """Price quartiles, whiskers at 1.5·IQR and outlier count."""
    return _box_out(box_stats(materialized(spark, sf_dir, [LABEL]), LABEL))


_TOP_BRANDS_SQL = f"""
top AS (SELECT Brand FROM clean GROUP BY Brand ORDER BY count(*) DESC, Brand LIMIT {TOP_K_CATEGORIES}),
kept AS (SELECT * FROM clean WHERE Brand IN (SELECT Brand FROM top))"""


@register("price_box_by_brand", with_listings("WITH " + _TOP_BRANDS_SQL + "," + _BOX_SQL.format(
    key="Brand,", src="kept", group="GROUP BY Brand", fkey="f.Brand,", on="s.Brand = f.Brand")))
def q_price_box_by_brand(spark, sf_dir):
    """Box statistics of the price for each of the ten most frequent brands."""
    kept = keep_top_categories(materialized(spark, sf_dir, ["Brand", LABEL]), "Brand")
    return _box_out(box_stats(kept, LABEL, by="Brand"), ["Brand"])


def _box_by(column):
    """Register the box statistics of the price per value of one more category."""
    @register(f"price_box_by_{column.lower()}", with_listings("WITH " + _BOX_SQL.format(
        key=f"{column},", src="clean", group=f"GROUP BY {column}", fkey=f"f.{column},", on=f"s.{column} = f.{column}")))
    def query(spark, sf_dir):
        kept = keep_top_categories(materialized(spark, sf_dir, [column, LABEL]), column)
        return _box_out(box_stats(kept, LABEL, by=column), [column])
    query.__doc__ = f"Box statistics of the price per {column} (no more than ten values)."


for _column in PROFILE_CATEGORIES[1:]:
    _box_by(_column)


# --- relationships ----------------------------------------------------------

@register("price_by_year", with_listings(f"""
WITH {_auto_k_sql('AskPrice')}
SELECT Year, {_bin_sql('AskPrice', 'k2')} AS y_bin, CAST(count(*) AS BIGINT) AS n FROM clean, k2 GROUP BY 1, 2"""))
def q_price_by_year(spark, sf_dir):
    """Price-vs-Year scatter as counts per (Year, price bin)."""
    return binned_2d(materialized(spark, sf_dir, ["Year", LABEL]), "Year", LABEL, discrete_x=True)


@register("price_by_km", with_listings(f"""
WITH {_auto_k_sql('AskPrice')}, {_auto_k_sql('kmDriven', name='kx')}
SELECT {_bin_sql('kmDriven', 'kx')} AS x_bin, {_bin_sql('AskPrice', 'k2')} AS y_bin, CAST(count(*) AS BIGINT) AS n
FROM clean, k2, kx GROUP BY 1, 2"""))
def q_price_by_km(spark, sf_dir):
    """Price-vs-km scatter as counts per (km bin, price bin)."""
    return binned_2d(materialized(spark, sf_dir, ["kmDriven", LABEL]), "kmDriven", LABEL)


@register("price_relations", with_listings("""
SELECT 'Year' AS x_column, round(corr(AskPrice, Year), 9) AS corr, round(regr_slope(AskPrice, Year), 6) AS slope,
 round(regr_intercept(AskPrice, Year), 2) AS intercept, CAST(regr_count(AskPrice, Year) AS BIGINT) AS n FROM clean
UNION ALL
SELECT 'kmDriven', round(corr(AskPrice, kmDriven), 9), round(regr_slope(AskPrice, kmDriven), 6),
 round(regr_intercept(AskPrice, kmDriven), 2), CAST(regr_count(AskPrice, kmDriven) AS BIGINT) FROM clean"""))
def q_price_relations(spark, sf_dir):
    """Correlation and least-squares line of price on Year and on kmDriven (one pass)."""
    r = numeric_relation(clean(spark, sf_dir), LABEL, ["Year", "kmDriven"])
    return r.select("x_column", _r("corr", 9).alias("corr"), _r("slope", 6).alias("slope"),
                    _r("intercept", 2).alias("intercept"), F.col("n").cast("bigint").alias("n"))


# --- categories ----------------------------------------------------------------

_CAT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in PROFILE_CATEGORIES)


@register("category_counts", with_listings(
    f"SELECT column_name, value, CAST(n AS BIGINT) AS n FROM ({_CAT_SQL}) c"))
def q_category_counts(spark, sf_dir):
    """Value counts of Brand, FuelType, Transmission and Owner (one aggregation)."""
    return category_counts(clean(spark, sf_dir), PROFILE_CATEGORIES)


@register("top10_categories", with_listings(f"""
SELECT column_name, value, CAST(n AS BIGINT) AS n, CAST(rnk AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rnk FROM ({_CAT_SQL}) c) r
WHERE rnk <= {TOP_K_CATEGORIES}"""))
def q_top10_categories(spark, sf_dir):
    """The ten most frequent values of each profiled column (ties by value)."""
    return top_categories_per_column(materialized(spark, sf_dir, PROFILE_CATEGORIES), PROFILE_CATEGORIES, TOP_K_CATEGORIES)


_LONG_TEXTS = ["AdditionInfo", "model", "PostedDate"]
_LONG_SQL = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY {c}" for c in _LONG_TEXTS)


@register("top10_free_texts", with_listings(f"""
SELECT column_name, value, CAST(n AS BIGINT) AS n, CAST(rnk AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rnk FROM ({_LONG_SQL}) c) r
WHERE rnk <= {TOP_K_CATEGORIES}"""))
def q_top10_free_texts(spark, sf_dir):
    """The ten most frequent values of the columns whose vocabulary grows with the data."""
    return top_categories_per_column(materialized(spark, sf_dir, _LONG_TEXTS), _LONG_TEXTS, TOP_K_CATEGORIES)


@register("top10_filter", with_listings(
    "WITH " + _TOP_BRANDS_SQL + "\nSELECT listing_id, Brand, AskPrice FROM kept"))
def q_top10_filter(spark, sf_dir):
    """Listings whose brand is among the ten most frequent (broadcast left-semi join)."""
    return keep_top_categories(materialized(spark, sf_dir, [ID, "Brand", LABEL]), "Brand")

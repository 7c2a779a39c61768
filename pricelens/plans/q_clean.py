"""Registered queries: listing source and cleaning (S1, S2, P1-P9, A6, A7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import clean_numeric, derive_age, strip_currency, to_int
from ..operators.clean import clean_listings, column_kinds
from ..oracles import with_listings
from ..registry import register
from ..schema import ID, TRAIN_DEFAULTS
from ..sources.listings import raw_listings
from .common import clean


@register("clean_listings", with_listings("SELECT * FROM clean"))
def q_clean_listings(spark, sf_dir):
    """Dirty listings in, clean typed listings out (the minimum slice)."""
    return clean(spark, sf_dir)


@register("listings_raw", with_listings("SELECT * FROM listings", clean=False))
def q_listings_raw(spark, sf_dir):
    """The raw listing table, every column text, nulls and bad values kept."""
    return raw_listings(spark, sf_dir)


@register("strip_currency", with_listings("""
SELECT listing_id, regexp_replace(AskPrice,'[₹,]','','g') AS price_text
FROM listings WHERE AskPrice IS NOT NULL""", clean=False))
def q_strip_currency(spark, sf_dir):
    raw = raw_listings(spark, sf_dir)
    return raw.filter(F.col("AskPrice").isNotNull()).select(ID, strip_currency("AskPrice").alias("price_text"))


@register("clean_numeric", with_listings("""
SELECT listing_id,
 TRY_CAST(regexp_replace(kmDriven,'[^0-9.]','','g') AS DOUBLE) AS kmDriven,
 TRY_CAST(regexp_replace(regexp_replace(AskPrice,'[₹,]','','g'),'[^0-9.]','','g') AS DOUBLE) AS AskPrice
FROM listings""", clean=False))
def q_clean_numeric(spark, sf_dir):
    raw = raw_listings(spark, sf_dir)
    return raw.select(ID, clean_numeric("kmDriven").alias("kmDriven"),
                      clean_numeric(strip_currency("AskPrice")).alias("AskPrice"))


@register("cast_year_age", with_listings("""
SELECT listing_id, TRY_CAST(Year AS INTEGER) AS Year,
 CAST(2025 - TRY_CAST(Year AS INTEGER) AS INTEGER) AS Age
FROM listings""", clean=False))
def q_cast_year_age(spark, sf_dir):
    raw = raw_listings(spark, sf_dir)
    return raw.select(ID, to_int("Year").alias("Year"),
                      derive_age(F.lit(None), to_int("Year")).alias("Age"))


@register("given_age", with_listings("""
SELECT listing_id, Year, CAST(coalesce(TRY_CAST(CASE length(model) % 3 WHEN 0 THEN CAST(length(model) AS VARCHAR) WHEN 1 THEN 'unknown' END AS INTEGER), 2025 - Year)
 AS INTEGER) AS Age FROM clean"""))
def q_given_age(spark, sf_dir):
    """Cleaning of listings some of which give their age, as a number or as bad text: a usable one is kept, others follow from Year."""
    n = F.length("model")
    raw = raw_listings(spark, sf_dir).withColumn("Age", F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, F.lit("unknown")))
    return clean_listings(raw).select(ID, "Year", "Age")


@register("drop_null_critical", with_listings("""
SELECT CAST(count(*) AS BIGINT) AS n_raw,
 CAST(count(*) FILTER (WHERE Brand IS NULL) AS BIGINT) AS null_brand,
 CAST(count(*) FILTER (WHERE model IS NULL) AS BIGINT) AS null_model,
 CAST(count(*) FILTER (WHERE Year IS NULL) AS BIGINT) AS null_year,
 CAST(count(*) FILTER (WHERE kmDriven IS NULL) AS BIGINT) AS null_km,
 CAST(count(*) FILTER (WHERE AskPrice IS NULL) AS BIGINT) AS null_price,
 CAST(count(*) FILTER (WHERE Brand IS NOT NULL AND model IS NOT NULL AND Year IS NOT NULL
   AND kmDriven IS NOT NULL AND AskPrice IS NOT NULL) AS BIGINT) AS n_clean
FROM typed"""))
def q_drop_null_critical(spark, sf_dir):
    """How many rows each critical column removes, and how many survive (one pass)."""
    raw = raw_listings(spark, sf_dir)
    typed = raw.select(
        "Brand", "model", to_int("Year").alias("Year"), clean_numeric("kmDriven").alias("kmDriven"),
        clean_numeric(strip_currency("AskPrice")).alias("AskPrice"))
    nulls = lambda c: F.count_if(F.col(c).isNull()).cast("bigint")
    ok = F.lit(True)
    for c in ["Brand", "model", "Year", "kmDriven", "AskPrice"]:
        ok = ok & F.col(c).isNotNull()
    return typed.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_raw"),
        nulls("Brand").alias("null_brand"), nulls("model").alias("null_model"),
        nulls("Year").alias("null_year"), nulls("kmDriven").alias("null_km"),
        nulls("AskPrice").alias("null_price"), F.count_if(ok).cast("bigint").alias("n_clean"))


_FILL_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS filled FROM typed "
    "WHERE Brand IS NOT NULL AND model IS NOT NULL AND Year IS NOT NULL AND kmDriven IS NOT NULL AND AskPrice IS NOT NULL"
    for c in TRAIN_DEFAULTS)


@register("fill_defaults", with_listings("""
WITH pre AS (
 SELECT listing_id, Brand, model, TRY_CAST(Year AS INTEGER) AS Year,
  TRY_CAST(regexp_replace(kmDriven,'[^0-9.]','','g') AS DOUBLE) AS kmDriven,
  Transmission, Owner, FuelType, PostedDate, AdditionInfo,
  TRY_CAST(regexp_replace(regexp_replace(AskPrice,'[₹,]','','g'),'[^0-9.]','','g') AS DOUBLE) AS AskPrice
 FROM listings)
""" + _FILL_SQL.replace("FROM typed", "FROM pre")))
def q_fill_defaults(spark, sf_dir):
    """How many kept rows each default fills (nulls among the surviving rows)."""
    raw = raw_listings(spark, sf_dir)
    kept = raw.select(
        "Brand", "model", to_int("Year").alias("Year"), clean_numeric("kmDriven").alias("kmDriven"),
        clean_numeric(strip_currency("AskPrice")).alias("AskPrice"), *TRAIN_DEFAULTS.keys()
    ).dropna(subset=["Brand", "model", "Year", "kmDriven", "AskPrice"])
    counts = kept.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in TRAIN_DEFAULTS])
    stack = ", ".join(f"'{c}', `{c}`" for c in TRAIN_DEFAULTS)
    return counts.select(F.expr(f"stack({len(TRAIN_DEFAULTS)}, {stack}) AS (column_name, filled)"))


@register("column_kinds", with_listings("""
SELECT column_name, kind, CAST(count(DISTINCT v) AS BIGINT) AS n_distinct FROM (
 SELECT 'Brand' AS column_name, 'categorical' AS kind, Brand AS v FROM clean UNION ALL
 SELECT 'model', 'categorical', model FROM clean UNION ALL
 SELECT 'Year', 'numeric', CAST(Year AS VARCHAR) FROM clean UNION ALL
 SELECT 'Age', 'numeric', CAST(Age AS VARCHAR) FROM clean UNION ALL
 SELECT 'kmDriven', 'numeric', CAST(kmDriven AS VARCHAR) FROM clean UNION ALL
 SELECT 'Transmission', 'categorical', Transmission FROM clean UNION ALL
 SELECT 'Owner', 'categorical', Owner FROM clean UNION ALL
 SELECT 'FuelType', 'categorical', FuelType FROM clean UNION ALL
 SELECT 'PostedDate', 'categorical', PostedDate FROM clean UNION ALL
 SELECT 'AdditionInfo', 'categorical', AdditionInfo FROM clean) s
GROUP BY column_name, kind"""))
def q_column_kinds(spark, sf_dir):
    """Feature kind of each clean column (text → categorical) with its distinct count.

    Distinct counts go through one (column, value) aggregation with map-side
    partial aggregation instead of ten DISTINCT aggregates.
    """
    df = clean(spark, sf_dir)
    cats, nums = column_kinds(df)
    cols = [c for c in df.columns if c in set(cats) | set(nums)]
    kind = {c: ("categorical" if c in cats else "numeric") for c in cols}
    stack = ", ".join(f"'{c}', '{kind[c]}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {stack}) AS (column_name, kind, v)"))
    return (long.distinct()
                .groupBy("column_name", "kind").agg(F.count("v").cast("bigint").alias("n_distinct")))


@register("preview_head", with_listings("SELECT * FROM clean ORDER BY listing_id LIMIT 10"))
def q_preview_head(spark, sf_dir):
    """First ten clean rows in id order (top-k: each task keeps its own ten)."""
    return clean(spark, sf_dir).orderBy(ID).limit(10)


@register("raw_preview_head", with_listings("SELECT * FROM listings ORDER BY listing_id LIMIT 10", clean=False))
def q_raw_preview_head(spark, sf_dir):
    """First ten raw rows in id order, every column text."""
    return raw_listings(spark, sf_dir).orderBy(ID).limit(10)


@register("dataset_shape", with_listings(
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(12 AS INTEGER) AS n_columns FROM clean"))
def q_dataset_shape(spark, sf_dir):
    df = clean(spark, sf_dir)
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                  F.lit(len(df.columns)).cast("int").alias("n_columns"))


# --- sources and sinks ----------------------------------------------------------

@register("raw_csv_roundtrip", with_listings("SELECT * FROM clean"))
def q_raw_csv_roundtrip(spark, sf_dir):
    """Raw listings written as CSV by the executors, read back as text with a
    fixed schema (no inference pass), then cleaned."""
    from ..sources.artifacts import run_dir
    from ..sources.listings import read_raw_csv
    path = run_dir(spark, "raw_listings_csv")
    raw_listings(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return clean_listings(read_raw_csv(spark, path))


@register("csv_roundtrip", with_listings("SELECT * FROM clean"))
def q_csv_roundtrip(spark, sf_dir):
    """The clean table written as CSV from the executors and read back typed."""
    from ..sources.artifacts import run_dir
    from ..sources.listings import read_clean_csv, write_clean
    path = run_dir(spark, "clean_csv")
    write_clean(clean(spark, sf_dir), path, fmt="csv")
    return read_clean_csv(spark, path)

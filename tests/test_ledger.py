"""Unit tests of the semantics ledger: one behaviour per test, on tiny frames."""

import pytest
from pyspark.sql import functions as F

from pricelens.functions.columns import clean_numeric, format_price, split_key, strip_currency, to_int
from pricelens.operators.clean import clean_listings, column_kinds, fill_defaults
from pricelens.operators.serve import RULES, conform, serve_defaults, split_valid, validate
from pricelens.schema import CLEAN_SCHEMA, RAW_SCHEMA


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()[0]


def test_price_text_is_cleaned(spark):
    assert _one(spark, lambda c: clean_numeric(strip_currency(c)), "₹ 1,95,000") == 195000.0


def test_bad_numeric_text_becomes_null(spark):
    for bad in ["", "n/a", "Rs. 4.5", "."]:
        assert _one(spark, lambda c: clean_numeric(strip_currency(c)), bad) is None, bad


def test_digit_rule_drops_sign_of_text(spark):
    assert _one(spark, clean_numeric, "-5") == 5.0
    assert _one(spark, clean_numeric, "50,000 km") == 50000.0
    assert _one(spark, clean_numeric, "4.5 lakh") == 4.5


def test_year_cast_is_safe(spark):
    assert _one(spark, to_int, "unknown") is None
    assert _one(spark, to_int, "2018.5") is None
    assert _one(spark, to_int, "2018") == 2018


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def _row(**kw):
    base = dict(listing_id="a", Brand="B", model="M", Year="2015", Age=None, kmDriven="10,000 km",
                Transmission=None, Owner=None, FuelType=None, PostedDate=None, AdditionInfo=None,
                AskPrice="₹ 2,00,000")
    base.update(kw)
    return tuple(base[f.name] for f in RAW_SCHEMA.fields)


def test_clean_schema_and_defaults(spark):
    df = clean_listings(_raw(spark, [_row()]))
    assert df.schema.simpleString() == CLEAN_SCHEMA.simpleString()
    r = df.first()
    assert (r.Transmission, r.Owner, r.FuelType, r.PostedDate, r.AdditionInfo) == \
        ("Manual", "first", "Petrol", "Unknown", "No additional info")
    assert r.Age == 10 and r.kmDriven == 10000.0 and r.AskPrice == 200000.0


def test_given_age_wins_and_missing_age_is_derived(spark):
    df = clean_listings(_raw(spark, [_row(listing_id="a", Age="3"), _row(listing_id="b", Age="x")]))
    ages = dict(df.select("listing_id", "Age").collect())
    assert ages == {"a": 3, "b": 10}


def test_critical_nulls_are_dropped(spark):
    rows = [_row(listing_id=str(i), **{c: None}) for i, c in enumerate(["Brand", "model", "Year", "kmDriven", "AskPrice"])]
    rows.append(_row(listing_id="ok"))
    rows.append(_row(listing_id="badprice", AskPrice="Rs. 4.5"))
    assert [r.listing_id for r in clean_listings(_raw(spark, rows)).collect()] == ["ok"]


def test_fill_only_existing_text_columns(spark):
    df = spark.createDataFrame([(None, 1)], "Owner string, Year int")
    out = fill_defaults(df)
    assert out.first().Owner == "first"


def test_cleaning_is_idempotent_on_clean_input(spark):
    once = clean_listings(_raw(spark, [_row(), _row(listing_id="b", Year="2010")]))
    twice = clean_listings(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_column_kinds_exclude_label_and_id(spark):
    df = clean_listings(_raw(spark, [_row()]))
    cats, nums = column_kinds(df)
    assert "AskPrice" not in nums and "listing_id" not in cats
    assert nums == ["Year", "Age", "kmDriven"]


def test_split_key_is_stable_and_partition_free(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("listing_id"))
    a = ids.repartition(2).select("listing_id", split_key().alias("k"))
    b = ids.repartition(5).select("listing_id", split_key().alias("k"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_serving_conform_defaults_and_validation(spark):
    req = spark.createDataFrame(
        [("1", "Maruti", "Swift", "2018", "50000", "Manual", "first", "Petrol"),
         ("2", "Maruti", "Swift", "1900", "-5", "Manual", "first", "Petrol"),
         ("3", "Maruti", "Swift", "abc", "10", "Semi", "zeroth", "Steam")],
        "listing_id string, Brand string, model string, Year string, kmDriven string, Transmission string, "
        "Owner string, FuelType string")
    conformed = serve_defaults(conform(req))
    r1 = conformed.filter("listing_id = '1'").first()
    assert r1.Age == 7 and r1.PostedDate == "Current" and r1.AdditionInfo == "Maruti Swift, 2018"
    v = {r.listing_id: r.errors for r in validate(conformed).collect()}
    assert v["1"] == []
    assert set(v["2"]) == {"Year missing or outside range", "kmDriven missing or negative"}
    assert len(v["3"]) == 4
    good, bad = split_valid(conformed)
    assert good.count() == 1 and bad.count() == 2
    assert set(RULES) >= set(v["3"])


def test_format_price(spark):
    assert _one(spark, format_price, 1234567.891, "double") == "₹1,234,567.89"

"""Cleaning of raw listings: text → typed, critical nulls dropped, defaults filled.

Every function is ``DataFrame -> DataFrame`` and lazy.  Column presence is
resolved against the schema at plan time, so optional columns cost nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.columns import clean_numeric, clean_numeric_typed, derive_age, strip_currency, to_int
from ..schema import CRITICAL_COLUMNS, LABEL, REFERENCE_YEAR, TRAIN_DEFAULTS


def _type_of(df: DataFrame, name: str):
    return df.schema[name].dataType


def strip_price_currency(df: DataFrame) -> DataFrame:
    """Price text without currency sign and commas (still text)."""
    if LABEL not in df.columns:
        return df
    return df.withColumn(LABEL, strip_currency(LABEL))


def clean_numeric_column(df: DataFrame, name: str) -> DataFrame:
    """Digit-and-dot cleanup of a text column into a double; numbers pass."""
    if name not in df.columns:
        return df
    return df.withColumn(name, clean_numeric_typed(_type_of(df, name), name))


def cast_year(df: DataFrame) -> DataFrame:
    if "Year" not in df.columns:
        return df
    return df.withColumn("Year", to_int("Year"))


def add_age(df: DataFrame, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """Age from the column when usable, else ``reference_year - Year``."""
    age = F.col("Age") if "Age" in df.columns else F.lit(None)
    return df.withColumn("Age", derive_age(age, "Year", reference_year))


def drop_null_critical(df: DataFrame, columns=None) -> DataFrame:
    subset = [c for c in (columns or CRITICAL_COLUMNS) if c in df.columns]
    return df.dropna(subset=subset) if subset else df


def fill_defaults(df: DataFrame, defaults=None) -> DataFrame:
    """Fill text defaults into the text columns that exist."""
    defaults = defaults or TRAIN_DEFAULTS
    usable = {c: v for c, v in defaults.items()
              if c in df.columns and isinstance(_type_of(df, c), StringType)}
    return df.fillna(usable) if usable else df


def clean_listings(raw: DataFrame, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """Raw listings → clean, typed listings.

    The whole chain is one projection, one filter and one fill.  The row number
    that the filter asks for keeps Catalyst from moving the filter below the projection,
    where all its text expressions would be computed a second time.
    """
    has_age = "Age" in raw.columns
    exprs = []
    for c in raw.columns:
        t = _type_of(raw, c)
        if c == LABEL:
            e = clean_numeric_typed(t, c)  # it drops the currency sign and commas, too
        elif c == "kmDriven":
            e = clean_numeric_typed(t, c)
        elif c == "Year":
            exprs.append(to_int(c).alias(c))
            # Age follows Year, as in the listing schema.
            age = F.col("Age") if has_age else F.lit(None)
            e, c = derive_age(age, to_int("Year"), reference_year), "Age"
        elif c == "Age":
            if "Year" in raw.columns:
                continue
            e = to_int(c)
        else:
            e = F.col(c)
        exprs.append(e.alias(c))
    number = "_row"
    while number in raw.columns:
        number += "_"
    df = raw.select(*exprs, F.monotonically_increasing_id().alias(number)).where(F.col(number) >= 0)
    return fill_defaults(drop_null_critical(df).drop(number))


def column_kinds(df: DataFrame, label: str = LABEL, exclude=("listing_id",)) -> tuple[list[str], list[str]]:
    """Split columns into (text → categorical, any number or boolean → numeric), label excluded."""
    from pyspark.sql.types import BooleanType
    cats, nums = [], []
    for f in df.schema.fields:
        if f.name == label or f.name in exclude:
            continue
        if isinstance(f.dataType, StringType):
            cats.append(f.name)
        elif isinstance(f.dataType, (NumericType, BooleanType)):
            nums.append(f.name)
    return cats, nums

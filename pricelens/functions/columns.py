"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CURRENCY_PATTERN, ID, NON_NUMERIC_PATTERN, REFERENCE_YEAR


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_currency(c) -> Column:
    """Remove the currency sign and digit-group commas from price text."""
    return F.regexp_replace(col_of(c).cast("string"), CURRENCY_PATTERN, "")


def clean_numeric(c) -> Column:
    """Text → double keeping only digits and dots; unparsable text → null.

    Numeric input passes through unchanged (casting ``1.0E7`` to text and
    stripping the ``E`` would corrupt it).  The sign of negative text values
    is dropped, as the digit-only rule implies.
    """
    return F.regexp_replace(col_of(c).cast("string"), NON_NUMERIC_PATTERN, "").try_cast("double")


def clean_numeric_typed(df_type, c) -> Column:
    """``clean_numeric`` for text columns, a plain double cast for numeric ones."""
    from pyspark.sql.types import NumericType
    if isinstance(df_type, NumericType):
        return col_of(c).cast("double")
    return clean_numeric(c)


def to_int(c) -> Column:
    """Text or number → int; bad text (``'unknown'``, ``'2018.5'``) → null."""
    return col_of(c).try_cast("int")


def derive_age(age, year, reference_year: int = REFERENCE_YEAR) -> Column:
    """Age as given, else ``reference_year - Year``."""
    return F.coalesce(col_of(age).try_cast("int"), F.lit(reference_year) - col_of(year))


def describe_listing(brand, model, year) -> Column:
    """``"<Brand> <model>, <Year>"`` with missing parts as empty text."""
    return F.format_string("%s %s, %s",
                           F.coalesce(col_of(brand), F.lit("")),
                           F.coalesce(col_of(model), F.lit("")),
                           F.coalesce(col_of(year).cast("string"), F.lit("")))


def format_price(c) -> Column:
    """``₹1,234,567.89`` display text."""
    return F.concat(F.lit("₹"), F.format_number(col_of(c), 2))


def creation_timestamp() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def split_key(id_col=ID) -> Column:
    """Stable 32-bit key from the first 8 hex digits of md5(listing_id).

    It depends only on the row's id, so the train/test split and the CV
    folds do not change with row order or partition count.
    """
    return F.conv(F.substring(F.md5(col_of(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")


def is_train(key: Column, train_tenths: int = 8) -> Column:
    return (key % 10) < train_tenths


def fold_of(key: Column, folds: int) -> Column:
    return (key % folds).cast("int")

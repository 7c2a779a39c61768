"""Schemas, defaults, domains and constants of the listing data model.

Everything here is a plain value; no Spark work happens at import time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------

# Year the listing ages are counted from (Age = REFERENCE_YEAR - Year).
REFERENCE_YEAR = 2025
# Share of the model prediction quoted as the market price.
MARKET_FACTOR = 0.85

# Characters stripped from the price text before the numeric cleanup.
CURRENCY_PATTERN = "[₹,]"
# Everything that is not a digit or a dot is dropped from numeric text.
NON_NUMERIC_PATTERN = "[^0-9.]"

# Rows missing any of these are dropped during cleaning.
CRITICAL_COLUMNS = ["Brand", "model", "Year", "kmDriven", "AskPrice"]

# Defaults filled into non-critical text columns during cleaning.
TRAIN_DEFAULTS = {
    "Transmission": "Manual",
    "Owner": "first",
    "FuelType": "Petrol",
    "PostedDate": "Unknown",
    "AdditionInfo": "No additional info",
}

# Defaults used when a score request omits a field.
SERVE_POSTED_DATE = "Current"

# Allowed values for score requests.
VALID_FUEL_TYPES = ["Petrol", "Diesel", "CNG", "LPG", "Electric"]
VALID_TRANSMISSIONS = ["Manual", "Automatic"]
VALID_OWNERS = ["first", "second", "third", "fourth", "Test Drive Car"]
MIN_YEAR = 1950
MAX_YEAR = 2025
MIN_KM = 0.0

# Model families, in the order they are trained and compared.
MODEL_FAMILIES = ["Linear Regression", "Random Forest", "Gradient Boosting"]

# Hyper-parameter grids searched by cross-validation, per family.
PARAM_GRIDS = {
    "Linear Regression": {"regParam": [0.01, 0.1, 0.5], "elasticNetParam": [0.0, 0.5, 1.0]},
    "Random Forest": {"numTrees": [20, 50, 100], "maxDepth": [5, 10, 15]},
    "Gradient Boosting": {"maxDepth": [3, 5, 7], "maxIter": [10, 20, 30]},
}
CV_FOLDS = 3
# Decimals of a displayed price.
PRICE_DECIMALS = 2
RF_TREES = 50
GBT_ROUNDS = 10
SEED = 42

# Categorical columns shown in the category profile.
PROFILE_CATEGORIES = ["Brand", "FuelType", "Transmission", "Owner"]
TOP_K_CATEGORIES = 10

# ---------------------------------------------------------------------------
# Column names
# ---------------------------------------------------------------------------

ID = "listing_id"
LABEL = "AskPrice"

RAW_COLUMNS = [
    "Brand", "model", "Year", "Age", "kmDriven", "Transmission", "Owner",
    "FuelType", "PostedDate", "AdditionInfo", "AskPrice",
]

# Feature profiles.  "wide" is every text column plus every number, as the
# original job derives them from the schema; "narrow" keeps the low-cardinality
# columns so the vector size does not grow with the data.
WIDE_CATEGORICALS = ["Brand", "model", "Transmission", "Owner", "FuelType", "PostedDate", "AdditionInfo"]
WIDE_NUMERICS = ["Year", "Age", "kmDriven"]
NARROW_CATEGORICALS = ["Brand", "Transmission", "FuelType", "Owner"]
NARROW_NUMERICS = ["Year", "kmDriven"]

PROFILES = {
    "wide": (WIDE_CATEGORICALS, WIDE_NUMERICS),
    "narrow": (NARROW_CATEGORICALS, NARROW_NUMERICS),
}

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [T.StructField(ID, T.StringType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS]
)

CLEAN_SCHEMA = T.StructType([
    T.StructField(ID, T.StringType(), True),
    T.StructField("Brand", T.StringType(), True),
    T.StructField("model", T.StringType(), True),
    T.StructField("Year", T.IntegerType(), True),
    T.StructField("Age", T.IntegerType(), True),
    T.StructField("kmDriven", T.DoubleType(), True),
    T.StructField("Transmission", T.StringType(), True),
    T.StructField("Owner", T.StringType(), True),
    T.StructField("FuelType", T.StringType(), True),
    T.StructField("PostedDate", T.StringType(), True),
    T.StructField("AdditionInfo", T.StringType(), True),
    T.StructField("AskPrice", T.DoubleType(), True),
])

# The fields a score request carries, in this order, all nullable.
SCORE_SCHEMA = T.StructType([
    T.StructField("Brand", T.StringType(), True),
    T.StructField("model", T.StringType(), True),
    T.StructField("Year", T.IntegerType(), True),
    T.StructField("Age", T.IntegerType(), True),
    T.StructField("kmDriven", T.DoubleType(), True),
    T.StructField("Transmission", T.StringType(), True),
    T.StructField("Owner", T.StringType(), True),
    T.StructField("FuelType", T.StringType(), True),
    T.StructField("PostedDate", T.StringType(), True),
    T.StructField("AdditionInfo", T.StringType(), True),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("RMSE", T.DoubleType(), True),
    T.StructField("R2", T.DoubleType(), True),
    T.StructField("MAE", T.DoubleType(), True),
])

RUN_METADATA_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType(), True),
    T.StructField("metrics", METRICS_SCHEMA, True),
    T.StructField("creation_date", T.StringType(), True),
])

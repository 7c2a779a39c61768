"""Listing sources and sinks.

* ``raw_listings`` derives a dirty listing table from the driver's
  ``lineitem``/``part``/``orders`` parquet tables (the test-data mapping).
* ``read_raw_csv`` / ``read_clean_csv`` read listing files with a fixed schema
  (no inference pass over the data).
* ``write_clean`` writes a clean table from the executors.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import CLEAN_SCHEMA, ID, RAW_COLUMNS
from ..session import keep_stages_compiled, sf_path
from .split_csv import read_split_csv

LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"]
CSV = {"header": True, "quote": '"', "escape": '"'}
ORDERS_COLUMNS = ["o_orderkey", "o_orderdate", "o_orderpriority"]


def _joined_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part, pruned to the columns the listing needs.

    Both joins are plain equi-joins: AQE turns a side into a broadcast only
    after measuring it under ``autoBroadcastJoinThreshold``; otherwise they
    are sort-merge joins on the key, and skewed key partitions are split by
    the AQE skew-join rule.
    """
    li = spark.read.parquet(sf_path(sf_dir, "lineitem")).select(*LINEITEM_COLUMNS)
    orders = spark.read.parquet(sf_path(sf_dir, "orders")).select(*ORDERS_COLUMNS)
    part = spark.read.parquet(sf_path(sf_dir, "part")).select(*PART_COLUMNS)
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey))


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty listing rows (all text columns) with planted nulls and bad values.

    ``h`` picks which field of a row is spoiled; the asking price is built
    from integers so its text form is exact and carries a signal in Year,
    km and transmission.
    """
    keep_stages_compiled(spark)
    j = _joined_base(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    h = (F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber")) % 20
    yr = F.year("l_shipdate")
    ask = (F.floor("p_retailprice").cast("bigint") * 300
           + (yr - 1995) * 20000
           - F.col("l_quantity").cast("bigint") * 2000
           + F.floor(F.col("l_extendedprice") / 10).cast("bigint")
           + F.when(F.col("l_returnflag") == "A", 40000).otherwise(0))
    j = j.select(
        F.concat_ws("-", s("l_orderkey"), s("l_partkey"), s("l_suppkey"), s("l_linenumber")).alias(ID),
        h.alias("h"), "p_brand", "p_name", "p_type", yr.alias("yr"), "l_quantity", "l_returnflag",
        "l_linestatus", "o_orderpriority", "o_orderdate", ask.alias("ask"))
    h = F.col("h")
    null = F.lit(None).cast("string")
    return j.select(
        ID,
        F.when(h == 0, null).otherwise(F.col("p_brand")).alias("Brand"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("model"),
        F.when(h == 1, null).when(h == 2, F.lit("unknown")).otherwise(s("yr")).alias("Year"),
        F.when(h == 3, null).when(h == 4, F.lit("n/a"))
         .otherwise(F.concat(F.format_number(F.col("l_quantity") * 1000, 0), F.lit(" km"))).alias("kmDriven"),
        F.when(h == 5, null).when(F.col("l_returnflag") == "A", F.lit("Automatic"))
         .otherwise(F.lit("Manual")).alias("Transmission"),
        F.when(h == 6, null).otherwise(F.col("o_orderpriority")).alias("Owner"),
        F.when(h == 7, null).when(F.col("l_linestatus") == "O", F.lit("Diesel"))
         .otherwise(F.lit("Petrol")).alias("FuelType"),
        F.when(h == 8, null).otherwise(F.date_format("o_orderdate", "MMM-yy")).alias("PostedDate"),
        F.when(h == 9, null)
         .otherwise(F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(", "), s("yr"))).alias("AdditionInfo"),
        F.when(h == 10, null).when(h == 11, F.lit("Rs. 4.5"))
         .otherwise(F.concat(F.lit("₹ "), F.format_number("ask", 0))).alias("AskPrice"),
    )


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a raw listing CSV with a header, every column as text.

    Columns are named by the header of the first file; several files of one
    folder or glob must have the same columns in the same order.  Text keeps
    its line breaks, quotes and outer spaces.  No type
    inference: no extra pass over the data, and no column silently turning
    into a date or boolean that the feature step would then ignore.  A file is
    read by as many tasks as it has blocks.
    """
    names = _found(path, lambda: spark.read.options(**CSV).csv(path).columns)
    return read_split_csv(spark, path, StructType([StructField(n, StringType()) for n in names]), CSV)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a clean listing CSV written by ``write_clean``."""
    _found(path, lambda: spark.read.text(path))
    return read_split_csv(spark, path, CLEAN_SCHEMA, CSV)


def write_clean(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a clean listing table from the executors (no driver collect)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
            .option("emptyValue", '""').csv(path)
    else:
        w.parquet(path)


def raw_columns_present(df: DataFrame) -> list[str]:
    return [c for c in RAW_COLUMNS if c in df.columns]


def _found(path: str, read):
    """What ``read`` gives; a missing path is named in a FileNotFoundError."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"data file not found at {path}") from e
        raise

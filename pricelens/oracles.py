"""Independent SQL for every registered query, in DuckDB's dialect.

The oracle engine only sees the driver's base tables, so each statement
carries the listing derivation itself (``LISTINGS_CTE``) and the cleaning
(``CLEAN_CTE``).  Floating results are rounded to a fixed scale on both
sides so that a different summation order cannot change a hash.
"""

from __future__ import annotations

LISTINGS_CTE = r"""
j AS (
 SELECT concat_ws('-',CAST(l_orderkey AS VARCHAR),CAST(l_partkey AS VARCHAR),CAST(l_suppkey AS VARCHAR),CAST(l_linenumber AS VARCHAR)) AS listing_id,
  (l_orderkey*7+l_partkey*3+l_linenumber) % 20 AS h,
  p_brand, p_name, p_type, year(l_shipdate) AS yr, l_quantity, l_returnflag, l_linestatus, o_orderpriority, o_orderdate,
  CAST(floor(p_retailprice) AS BIGINT)*300 + (year(l_shipdate)-1995)*20000 - CAST(l_quantity AS BIGINT)*2000
   + CAST(floor(l_extendedprice/10) AS BIGINT) + CASE WHEN l_returnflag='A' THEN 40000 ELSE 0 END AS ask
 FROM lineitem JOIN part ON l_partkey=p_partkey JOIN orders ON l_orderkey=o_orderkey),
listings AS (
 SELECT listing_id,
 CASE WHEN h=0 THEN NULL ELSE p_brand END AS Brand,
 concat(p_name,' ',p_type) AS model,
 CASE WHEN h=1 THEN NULL WHEN h=2 THEN 'unknown' ELSE CAST(yr AS VARCHAR) END AS Year,
 CASE WHEN h=3 THEN NULL WHEN h=4 THEN 'n/a' ELSE concat(format('{:,}',CAST(l_quantity*1000 AS BIGINT)),' km') END AS kmDriven,
 CASE WHEN h=5 THEN NULL WHEN l_returnflag='A' THEN 'Automatic' ELSE 'Manual' END AS Transmission,
 CASE WHEN h=6 THEN NULL ELSE o_orderpriority END AS Owner,
 CASE WHEN h=7 THEN NULL WHEN l_linestatus='O' THEN 'Diesel' ELSE 'Petrol' END AS FuelType,
 CASE WHEN h=8 THEN NULL ELSE strftime(o_orderdate,'%b-%y') END AS PostedDate,
 CASE WHEN h=9 THEN NULL ELSE concat(p_brand,' ',p_name,', ',CAST(yr AS VARCHAR)) END AS AdditionInfo,
 CASE WHEN h=10 THEN NULL WHEN h=11 THEN 'Rs. 4.5' ELSE concat('₹ ',format('{:,}',ask)) END AS AskPrice
 FROM j)"""

CLEAN_CTE = r"""
typed AS (
 SELECT listing_id, Brand, model,
  TRY_CAST(Year AS INTEGER) AS Year,
  CAST(2025 - TRY_CAST(Year AS INTEGER) AS INTEGER) AS Age,
  TRY_CAST(regexp_replace(kmDriven,'[^0-9.]','','g') AS DOUBLE) AS kmDriven,
  coalesce(Transmission,'Manual') AS Transmission,
  coalesce(Owner,'first') AS Owner,
  coalesce(FuelType,'Petrol') AS FuelType,
  coalesce(PostedDate,'Unknown') AS PostedDate,
  coalesce(AdditionInfo,'No additional info') AS AdditionInfo,
  TRY_CAST(regexp_replace(regexp_replace(AskPrice,'[₹,]','','g'),'[^0-9.]','','g') AS DOUBLE) AS AskPrice
 FROM listings),
clean AS (
 SELECT * FROM typed
 WHERE Brand IS NOT NULL AND model IS NOT NULL AND Year IS NOT NULL AND kmDriven IS NOT NULL AND AskPrice IS NOT NULL),
keyed AS (
 SELECT *, ('0x'||substr(md5(listing_id),1,8))::BIGINT AS split_key FROM clean),
train AS (SELECT * FROM keyed WHERE split_key % 10 < 8),
test AS (SELECT * FROM keyed WHERE split_key % 10 >= 8)"""


def with_listings(body: str, clean: bool = True) -> str:
    """Prefix ``body`` with the listing (and cleaning) CTEs."""
    ctes = LISTINGS_CTE + ("," + CLEAN_CTE if clean else "")
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH" + ctes + ",\n" + body[5:]
    return "WITH" + ctes + "\n" + body

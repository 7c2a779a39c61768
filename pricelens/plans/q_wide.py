"""Registered queries: feature dictionaries over all ten features (F1-F8 on the whole vocabulary), CSV read in blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import is_train
from ..operators.dictionary import TREE_LABELS, fit_features
from ..operators.features import with_split_key
from ..oracles import with_listings
from ..registry import register
from ..schema import ID, WIDE_CATEGORICALS, WIDE_NUMERICS
from ..session import sf_path
from ..sources.artifacts import run_dir
from ..sources.listings import CSV, write_clean
from ..sources.split_csv import read_split_csv
from .common import materialized

_LABELS = ("lab0 AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS pos, {c} AS label, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY {c}"
    for i, c in enumerate(WIDE_CATEGORICALS)) + """),
lab AS (SELECT column_name, pos, label, n, row_number() OVER (PARTITION BY pos ORDER BY n DESC, label) - 1 AS idx,
 row_number() OVER (ORDER BY pos, n DESC, label) - 1 AS slot FROM lab0),
width AS (SELECT count(*) AS w FROM lab), rows_of AS (SELECT count(*) AS n_rows FROM train)""")
_CELLS = " UNION ALL ".join(f"SELECT listing_id, {i} AS pos, {c} AS label FROM keyed" for i, c in enumerate(WIDE_CATEGORICALS))
_NUMBERS = " UNION ALL ".join(
    f"SELECT listing_id, CAST(w + {j} AS INTEGER) AS idx, CAST({c} AS DOUBLE) AS value, (SELECT stddev_samp({c}) FROM train) AS std FROM keyed, width WHERE {c} <> 0"
    for j, c in enumerate(WIDE_NUMERICS))
_TRIPLES = f"""
WITH {_LABELS}, cells AS ({_CELLS}),
triples AS (SELECT listing_id, CAST(slot AS INTEGER) AS idx, CAST(1.0 AS DOUBLE) AS value,
 sqrt(n * (n_rows - n) / (CAST(n_rows AS DOUBLE) * (n_rows - 1))) AS std FROM cells JOIN lab USING (pos, label), rows_of
 UNION ALL {_NUMBERS})"""


def _fitted(spark, sf_dir):
    rows = with_split_key(materialized(spark, sf_dir))
    return rows, fit_features(rows.where(is_train(F.col("split_key"))))


@register("wide_index", with_listings(f"WITH {_LABELS}\nSELECT column_name, label, n, idx, slot FROM lab"))
def q_wide_index(spark, sf_dir):
    """Every label of every text column: its count, index and slot, numbered by a range sort."""
    return _fitted(spark, sf_dir)[1].labels.select("column_name", "label", "n", "idx", "slot")


@register("wide_assembled_long", with_listings(_TRIPLES + "\nSELECT listing_id, idx, value FROM triples"))
def q_wide_assembled_long(spark, sf_dir):
    """Non-zero places of every row's one-hot vector over all ten features."""
    rows, features = _fitted(spark, sf_dir)
    return features.triples(rows, scaled=False)


@register("wide_scaled_long", with_listings(_TRIPLES + "\nSELECT listing_id, idx, round(value / std, 6) AS value FROM triples"))
def q_wide_scaled_long(spark, sf_dir):
    """The same, scaled to unit standard deviation over the training rows."""
    rows, features = _fitted(spark, sf_dir)
    return features.triples(rows).select(ID, "idx", F.round("value", 6).alias("value"))


@register("wide_vectors", with_listings(_TRIPLES + f"""
, cut AS (SELECT pos, least(count(*), {TREE_LABELS}, greatest(1, (SELECT n_rows FROM rows_of) // 8)) AS kept FROM lab GROUP BY pos),
indexed AS (SELECT c.listing_id, c.pos AS idx, CAST(least(coalesce(l.idx, kept), kept) AS DOUBLE) AS value
 FROM cells c JOIN cut USING (pos) LEFT JOIN lab l ON l.pos = c.pos AND l.label = c.label)
SELECT t.listing_id, CAST(t.n AS BIGINT) AS n_nonzero, round(t.total, 4) AS scaled_sum, CAST(i.total AS DOUBLE) AS index_sum FROM
 (SELECT listing_id, count(*) AS n, sum(value / std) AS total FROM triples GROUP BY listing_id) t JOIN
 (SELECT listing_id, sum(value) AS total FROM indexed GROUP BY listing_id) i USING (listing_id)"""))
def q_wide_vectors(spark, sf_dir):
    """The stored vectors of every row, read back: non-zero places and sum of the sparse one, sum of the nominal indexes."""
    from pyspark.ml.functions import vector_to_array
    rows, features = _fitted(spark, sf_dir)
    table = features.transform(rows, [ID])
    k = len(features.categoricals)
    scaled = table.select(ID, F.unwrap_udt("scaled_features").alias("v"), F.slice(vector_to_array("indexed_features"), 1, k).alias("i"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return scaled.groupBy(ID).agg(F.sum(F.size("v.indices")).alias("n_nonzero"), F.round(F.sum(total(F.col("v.values"))), 4).alias("scaled_sum"),
                                  F.sum(total(F.col("i"))).alias("index_sum"))


@register("documents_csv_roundtrip", "SELECT CAST(doc_id AS BIGINT) AS doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars FROM documents")
def q_documents_csv_roundtrip(spark, sf_dir):
    """Texts with line breaks, commas and quotes as CSV, a file a task, read back block by block."""
    from pyspark.sql import types as T
    docs = spark.read.parquet(sf_path(sf_dir, "documents")).select(F.col("doc_id").cast("long"), "text")
    path = run_dir(spark, "documents_csv")
    write_clean(docs, path, fmt="csv")
    back = read_split_csv(spark, path, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]), CSV)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))

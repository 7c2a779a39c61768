"""Registered queries: split and feature vectors (F1-F8, A1, P10)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import is_train
from ..operators.dictionary import fit_features
from ..operators.features import (FEATURES, SCALED, feature_pipeline, index_labels, profile_columns, scaler_std, split,
                                  vector_long, with_split_key)
from ..oracles import with_listings
from ..registry import register
from ..schema import ID
from ..sources.artifacts import artifact_dir
from ..sources.listings import raw_listings, read_raw_csv, write_clean
from .common import clean, materialized

CATS, NUMS = profile_columns("narrow")


def _fitted(spark, sf_dir):
    train, test = split(materialized(spark, sf_dir, [ID, *CATS, *NUMS, "AskPrice"]))
    model = feature_pipeline(CATS, NUMS).fit(train)
    return train, test, model


def _fitted_all(spark, sf_dir):
    rows = with_split_key(materialized(spark, sf_dir, [ID, *CATS, *NUMS, "AskPrice"]))
    return rows, feature_pipeline(CATS, NUMS).fit(rows.filter(is_train(F.col("split_key"))))


# --- oracle building blocks --------------------------------------------------

def _labels_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, {i} AS pos, {c} AS label, count(*) AS c FROM train GROUP BY {c}"
             for i, c in enumerate(CATS)]
    return ("lab0 AS (" + " UNION ALL ".join(parts) + "),\n"
            "lab AS (SELECT column_name, pos, label, c, "
            "row_number() OVER (PARTITION BY column_name ORDER BY c DESC, label) - 1 AS idx FROM lab0),\n"
            "sizes AS (SELECT column_name, pos, count(*) AS k FROM lab GROUP BY column_name, pos),\n"
            "offs AS (SELECT column_name, coalesce(sum(k) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING "
            "AND 1 PRECEDING), 0) AS off FROM sizes),\n"
            "total AS (SELECT sum(k) AS width FROM sizes)")


def _assembled_sql(src: str = "keyed") -> str:
    parts = [f"SELECT t.listing_id, CAST(o.off + l.idx AS INTEGER) AS idx, 1.0 AS value FROM {src} t "
             f"JOIN lab l ON l.column_name = '{c}' AND l.label = t.{c} JOIN offs o ON o.column_name = '{c}'"
             for c in CATS]
    parts += [f"SELECT listing_id, CAST(width + {j} AS INTEGER) AS idx, CAST({c} AS DOUBLE) AS value "
              f"FROM {src}, total WHERE {c} <> 0" for j, c in enumerate(NUMS)]
    return "assembled AS (" + " UNION ALL ".join(parts) + ")"


def _std_sql() -> str:
    parts = [f"SELECT CAST(o.off + l.idx AS INTEGER) AS idx, "
             f"sqrt(l.c * (n.n - l.c) / (n.n * (n.n - 1.0))) AS std FROM lab l JOIN offs o USING (column_name), "
             f"(SELECT count(*) AS n FROM train) n WHERE l.column_name = '{c}'" for c in CATS]
    parts += [f"SELECT CAST(width + {j} AS INTEGER), (SELECT stddev_samp({c}) FROM train) FROM total"
              for j, c in enumerate(NUMS)]
    return "stds AS (" + " UNION ALL ".join(parts) + ")"


@register("split_counts", with_listings("""
SELECT CASE WHEN split_key % 10 < 8 THEN 'train' ELSE 'test' END AS split, CAST(count(*) AS BIGINT) AS n
FROM keyed GROUP BY 1"""))
def q_split_counts(spark, sf_dir):
    """Rows on each side of the hash split (no shuffle of the rows themselves)."""
    side = F.when(is_train(F.col("split_key")), "train").otherwise("test")
    return (with_split_key(clean(spark, sf_dir)).groupBy(side.alias("split"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@register("train_csv_no_id", with_listings("""
, keyed_raw AS (SELECT CAST('0x' || substr(md5(md5(concat_ws('|', coalesce(Brand,''), coalesce(model,''), coalesce(Year,''), coalesce(kmDriven,''),
 coalesce(Transmission,''), coalesce(Owner,''), coalesce(FuelType,''), coalesce(PostedDate,''), coalesce(AdditionInfo,''), coalesce(AskPrice,'')))), 1, 8) AS BIGINT) AS k
 FROM listings)
SELECT CASE WHEN k % 10 < 8 THEN 'train' ELSE 'test' END AS split, CAST(count(*) AS BIGINT) AS n FROM keyed_raw GROUP BY 1""".replace(", keyed_raw", "WITH keyed_raw", 1), clean=False))
def q_train_csv_no_id(spark, sf_dir):
    """Split of a listing file without an id column: written as CSV, read back, keyed by a hash of each row."""
    path = f"{artifact_dir(spark, 'csv_no_id')}/{uuid.uuid4().hex}"
    write_clean(raw_listings(spark, sf_dir).drop(ID), path, fmt="csv")
    side = F.when(is_train(F.col("split_key")), "train").otherwise("test")
    return (with_split_key(read_raw_csv(spark, path)).groupBy(side.alias("split"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@register("string_index", with_listings(f"""
WITH {_labels_sql()}
SELECT column_name, label, CAST(idx AS INTEGER) AS idx FROM lab"""))
def q_string_index(spark, sf_dir):
    """Label → index of each categorical column, as the fitted indexer assigns it to training rows."""
    train, _, model = _fitted(spark, sf_dir)
    t = model.transform(train)
    stack = ", ".join(f"'{c}', `{c}`, `{c}_index`" for c in CATS)
    return (t.select(F.expr(f"stack({len(CATS)}, {stack}) AS (column_name, label, idx)"))
             .distinct().select("column_name", "label", F.col("idx").cast("int").alias("idx")))


@register("one_hot_long", with_listings(f"""
WITH {_labels_sql()}
SELECT t.listing_id, l.column_name, CAST(l.idx AS INTEGER) AS slot FROM keyed t
JOIN lab l ON (l.column_name = 'Brand' AND l.label = t.Brand) OR (l.column_name = 'Transmission' AND l.label = t.Transmission)
 OR (l.column_name = 'FuelType' AND l.label = t.FuelType) OR (l.column_name = 'Owner' AND l.label = t.Owner)"""))
def q_one_hot_long(spark, sf_dir):
    """The hot slot of each one-hot block of every row (its index; the extra one for unseen labels has no slot)."""
    rows, model = _fitted_all(spark, sf_dir)
    t = model.transform(rows)
    sizes = index_labels(model)
    slots = [F.when(F.col(f"{c}_index") < len(sizes[c]), F.col(f"{c}_index")).otherwise(-1).cast("int") for c in CATS]
    stack = ", ".join(f"'{c}', s{i}" for i, c in enumerate(CATS))
    return (t.select(ID, *[s.alias(f"s{i}") for i, s in enumerate(slots)])
             .select(ID, F.expr(f"stack({len(CATS)}, {stack}) AS (column_name, slot)"))
             .filter(F.col("slot") >= 0))


@register("assemble_long", with_listings(f"""
WITH {_labels_sql()}, {_assembled_sql()}
SELECT listing_id, idx, value FROM assembled"""))
def q_assemble_long(spark, sf_dir):
    """Non-zero entries of the assembled (unscaled) vector of every row."""
    rows, model = _fitted_all(spark, sf_dir)
    return vector_long(model.transform(rows), FEATURES)


@register("scaler_stats", with_listings(f"""
WITH {_labels_sql()}, {_std_sql()}
SELECT idx, round(std, 6) AS std FROM stds"""))
def q_scaler_stats(spark, sf_dir):
    """Per-slot sample standard deviation the scaler divides by (fitted on training rows)."""
    _, _, model = _fitted(spark, sf_dir)
    rows = [(i, float(s)) for i, s in enumerate(scaler_std(model))]
    return spark.createDataFrame(rows, "idx int, std double").select("idx", F.round("std", 6).alias("std"))


@register("scaled_long", with_listings(f"""
WITH {_labels_sql()}, {_assembled_sql()}, {_std_sql()}
SELECT a.listing_id, a.idx, round(a.value * (1.0 / s.std), 6) AS value
FROM assembled a JOIN stds s USING (idx)"""))
def q_scaled_long(spark, sf_dir):
    """Non-zero entries of the scaled vector of every row (divided by the training std)."""
    rows, model = _fitted_all(spark, sf_dir)
    out = vector_long(model.transform(rows), SCALED)
    return out.select(ID, "idx", F.round("value", 6).alias("value"))


_WIDE_CATS, _WIDE_NUMS = profile_columns("wide")
_WIDE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS slots FROM train" for c in _WIDE_CATS)


@register("wide_feature_layout", with_listings(f"""
WITH per AS ({_WIDE_SQL})
SELECT column_name, slots FROM per
UNION ALL SELECT 'total', CAST(sum(slots) + {len(_WIDE_NUMS)} AS BIGINT) FROM per"""))
def q_wide_feature_layout(spark, sf_dir):
    """Vector layout of the wide profile (every text column one-hot, then Year, Age, kmDriven):
    slots per column = labels seen in training (the unknown slot is the one dropped)."""
    train, _ = split(materialized(spark, sf_dir, [ID, *_WIDE_CATS, *_WIDE_NUMS, "AskPrice"]))
    features = fit_features(train)
    total = spark.createDataFrame([("total", features.width)], "column_name string, slots bigint")
    return features.labels.groupBy("column_name").agg(F.count("*").alias("slots")).unionByName(total)

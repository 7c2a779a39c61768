"""Feature vectors: split, index, one-hot, assemble, scale (MLlib stages).

The feature pipeline is four MLlib stages: one multi-column
``StringIndexer`` (a single counting pass for every categorical column), one
multi-column ``OneHotEncoder``, a ``VectorAssembler`` and a ``StandardScaler``
that divides by the sample standard deviation without centring (vectors stay
sparse).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fold_of, is_train, split_key
from ..schema import ID, LABEL, PROFILES

FEATURES = "features"
SCALED = "scaled_features"


def with_row_id(df: DataFrame, id_col: str = ID) -> DataFrame:
    """``df`` with an id: where it has none, a hash over all its columns, so equal rows share one."""
    if id_col in df.columns:
        return df
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    return df.withColumn(id_col, F.md5(F.concat_ws("|", *text)))


def with_split_key(df: DataFrame, id_col: str = ID) -> DataFrame:
    df = with_row_id(df, id_col)
    return df if "split_key" in df.columns else df.withColumn("split_key", split_key(id_col))


def split(df: DataFrame, train_tenths: int = 8, id_col: str = ID) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split on a hash of the row id.

    Unlike ``randomSplit`` the result does not depend on row order or on
    the number of partitions, and it needs no shuffle: each side is a filter.
    """
    k = with_split_key(df, id_col)
    return k.filter(is_train(F.col("split_key"), train_tenths)), k.filter(~is_train(F.col("split_key"), train_tenths))


def with_fold(df: DataFrame, folds: int, id_col: str = ID) -> DataFrame:
    """Cross-validation fold id from the same row hash (``fold`` column)."""
    return with_split_key(df, id_col).withColumn("fold", fold_of(F.col("split_key"), folds))


def profile_columns(profile: str) -> tuple[list[str], list[str]]:
    if profile not in PROFILES:
        raise ValueError(f"unknown feature profile {profile!r}; choose one of {sorted(PROFILES)}")
    cats, nums = PROFILES[profile]
    return list(cats), list(nums)


def feature_pipeline(categoricals, numerics, scale: bool = True) -> Pipeline:
    """index → one-hot → assemble (one-hot blocks first, then numerics) → scale.

    Unknown or null labels go to the extra "keep" index, which is the slot the
    one-hot encoder drops: an unseen category becomes an all-zero block.
    """
    categoricals, numerics = list(categoricals), list(numerics)
    stages = []
    if categoricals:
        stages.append(StringIndexer(inputCols=categoricals, outputCols=[f"{c}_index" for c in categoricals],
                                    handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_index" for c in categoricals],
                                    outputCols=[f"{c}_vec" for c in categoricals], dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"{c}_vec" for c in categoricals] + numerics,
                                  outputCol=FEATURES, handleInvalid="error"))
    if scale:
        stages.append(StandardScaler(inputCol=FEATURES, outputCol=SCALED, withStd=True, withMean=False))
    return Pipeline(stages=stages)


@dataclass
class Prepared:
    """Train and test tables with feature vectors, and the fitted pipeline."""
    train: DataFrame
    test: DataFrame
    pipeline_model: PipelineModel
    categoricals: list
    numerics: list


def prepare(clean: DataFrame, profile: str = "narrow", train_tenths: int = 8,
            keep=(ID, LABEL)) -> Prepared:
    """Split first, then fit the feature pipeline on the training rows only.

    Fitting on the training side keeps test rows out of the label index
    order and the scaler statistics.
    """
    cats, nums = profile_columns(profile)
    clean = with_row_id(clean)
    train, test = split(clean, train_tenths)
    model = feature_pipeline(cats, nums).fit(train)
    cols = [c for c in keep if c in clean.columns] + ["split_key", SCALED]
    return Prepared(model.transform(train).select(*cols), model.transform(test).select(*cols), model, cats, nums)


def vector_long(df: DataFrame, vec_col: str, id_col: str = ID, keep_zeros: bool = False) -> DataFrame:
    """Explode a vector column into ``(id, idx, value)`` rows (non-zeros only).

    A sparse vector's places are taken as they are stored; only ``keep_zeros`` spreads them out.
    """
    if keep_zeros:
        out = df.select(id_col, F.posexplode(vector_to_array(vec_col)).alias("idx", "value"))
        return out.select(id_col, F.col("idx").cast("int").alias("idx"), "value")
    raw = F.unwrap_udt(F.col(vec_col))
    places = F.when(raw["type"] == 0, raw["indices"]).when(F.size(raw["values"]) > 0, F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    out = df.select(id_col, F.explode(F.arrays_zip(places.alias("idx"), raw["values"].alias("value"))).alias("z"))
    return out.select(id_col, F.col("z.idx").cast("int").alias("idx"), F.col("z.value").alias("value")).filter(F.col("value") != 0.0)


def feature_names(df: DataFrame, vec_col: str = FEATURES) -> list[str]:
    """Slot names from the ML attribute metadata the assembler writes."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", str(a["idx"]))
    size = meta.get("num_attrs", len(names))
    return [names.get(i, str(i)) for i in range(size)]


def index_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Label order per categorical column of a fitted pipeline."""
    for st in model.stages:
        if st.__class__.__name__ == "StringIndexerModel":
            return dict(zip(st.getInputCols(), st.labelsArray))
    return {}


def scaler_std(model: PipelineModel) -> list[float]:
    for st in model.stages:
        if st.__class__.__name__ == "StandardScalerModel":
            return list(st.std.toArray())
    return []

"""Shared building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_listings
from ..session import cut_lineage
from ..sources.listings import raw_listings


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_listings(raw_listings(spark, sf_dir))


def materialized(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    """Clean listings pruned to ``cols`` and checkpointed to the shared folder.

    For queries that pass over the same rows several times (index, scale,
    fit, score): the scan, joins and cleaning run once, and only for the
    columns the query needs.
    """
    df = clean(spark, sf_dir)
    return cut_lineage(df.select(*cols) if cols else df)

"""Regression metrics in one aggregation pass.

RMSE, MSE, MAE and R² come out of a single ``agg`` (partial aggregation on
every task, one tiny final merge) instead of one evaluator job per metric,
and no evaluator object is shared between metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LABEL


def metric_columns(label: str = LABEL, prediction: str = "prediction") -> list[Column]:
    """Over the rows that have both values; R² is null where the label doesn't vary."""
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    err = F.when(both, F.col(label) - F.col(prediction))
    n = F.count(err)
    sse = F.sum(err * err)
    sst = F.var_pop(F.when(both, F.col(label))) * n
    return [
        F.sqrt(F.try_divide(sse, n)).alias("rmse"),
        F.try_divide(sse, n).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
        n.cast("bigint").alias("n"),
    ]


def regression_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction",
                       by=None) -> DataFrame:
    """``(rmse, mse, mae, r2, n)`` of ``prediction`` against ``label``, optionally per group."""
    cols = metric_columns(label, prediction)
    return pred.groupBy(*by).agg(*cols) if by else pred.agg(*cols)


def collect_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> dict:
    """The one metrics row as a dict (one small row to the driver)."""
    return regression_metrics(pred, label, prediction).first().asDict()

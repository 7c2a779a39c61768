"""Listing price analytics on Spark.

Main entry points (all take and return Spark DataFrames):

* ``clean_listings(raw)`` — dirty listings → typed, cleaned listings
* ``prepare(clean, profile)`` — hash split + fitted feature pipeline
* ``train(clean, out_dir)`` — compare families, tune, save artefacts
* ``score_requests(requests, load_artifacts(spark, out_dir))`` — price a request table
* ``profile(clean)`` — the exploration summaries
"""

from __future__ import annotations

_EXPORTS = {
    "clean_listings": ".operators.clean",
    "prepare": ".operators.features",
    "split": ".operators.features",
    "regression_metrics": ".operators.metrics",
    "compare_models": ".operators.models",
    "cross_validate": ".operators.models",
    "profile": ".operators.profile",
    "exact_quantiles": ".operators.quantiles",
    "conform": ".operators.serve",
    "validate": ".operators.serve",
    "train": ".plans.train",
    "train_then_score": ".plans.train",
    "score_requests": ".plans.score",
    "score_from_saved": ".plans.score",
    "load_artifacts": ".sources.artifacts",
    "read_raw_csv": ".sources.listings",
    "score_stream": ".streaming.score_stream",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    # Imported on first use, so ``import pricelens`` stays cheap.
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name], __name__), name)
    raise AttributeError(name)

"""Command line: train on a listing CSV, score a request file, or both.

    python -m pricelens --mode train   --data listings.csv --out models/
    python -m pricelens --mode predict --requests requests.csv --out models/ --scored scored/
    python -m pricelens --mode both    --data listings.csv --requests requests.csv --out models/ --scored scored/

Under ``spark-submit`` the cluster's session settings apply; run directly it
starts a local session.  Scoring is skipped when training fails.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="pricelens", description=__doc__.splitlines()[0])
    ap.add_argument("--mode", choices=["train", "predict", "both"], default="predict")
    ap.add_argument("--data", help="raw listing CSV (header, text columns)")
    ap.add_argument("--requests", help="request CSV to score (header, text columns)")
    ap.add_argument("--out", required=True, help="artefact store: a folder for each training run, the newest finished one serves")
    ap.add_argument("--scored", help="output folder for scored and quarantined requests")
    ap.add_argument("--profile", choices=["all", "narrow", "wide"], default="all")
    ap.add_argument("--select-on", choices=["test", "validation"], default="test")
    ap.add_argument("--no-tune", action="store_true")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .operators.clean import clean_listings
    from .plans.score import score_from_saved
    from .plans.train import train
    from .session import SESSION_DEFAULTS, ensure_checkpoint_dir, size_session
    from .sources.listings import read_raw_csv

    builder = SparkSession.builder.appName("pricelens")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.data:
        size_session(spark, a.data)

    if a.mode in ("train", "both"):
        if not a.data:
            ap.error("--data is required to train")
        try:
            res = train(clean_listings(read_raw_csv(spark, a.data)), a.out, a.profile, tune=not a.no_tune,
                        select_on=a.select_on, versioned=True)
        except Exception as e:  # noqa: BLE001
            print(f"training failed: {e}", file=sys.stderr)
            if a.mode == "both":
                print("skipping prediction", file=sys.stderr)
            return 1
        m = res.final_metrics
        print(f"best model: {res.best_name} ({res.choice}); RMSE={m['rmse']:.2f} R2={m['r2']:.4f} MAE={m['mae']:.2f}")
    if a.mode in ("predict", "both"):
        if not (a.requests and a.scored):
            ap.error("--requests and --scored are required to predict")
        scored, bad = score_from_saved(spark, a.out, read_raw_csv(spark, a.requests))
        scored.write.mode("overwrite").parquet(f"{a.scored}/scored")
        bad.selectExpr("*", "concat_ws('; ', errors) AS error_text").drop("errors") \
           .write.mode("overwrite").parquet(f"{a.scored}/quarantine")
        print(f"scored requests written to {a.scored}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

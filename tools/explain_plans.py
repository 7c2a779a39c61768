"""Print the formatted physical plan of registered queries.

usage: python tools/explain_plans.py [--sf DIR] name ...
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from pricelens.registry import queries
    from pricelens.session import build_session
    spark = build_session("local[8]")
    q = queries()
    for n in a.names:
        print(f"===== {n}")
        q[n](spark, a.sf).explain(a.mode)
    spark.stop()


if __name__ == "__main__":
    main()

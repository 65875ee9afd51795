"""Print the formatted physical plan of registered queries.

    python tools/explain.py [--sf DIR] name [name ...]

Look for ``PushedFilters`` / ``ReadSchema`` on every scan, the number of
``Exchange`` nodes, and ``*(n)`` whole-stage-codegen markers on the hot path.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamledger.plans.queries import QUERIES  # noqa: E402
from streamledger.session import build_session  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    spark = build_session()
    for name in args.names:
        print(f"===== {name}")
        QUERIES[name](spark, args.sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

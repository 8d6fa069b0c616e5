"""Run checked queries and print their executed (final adaptive) plans.

Usage: python tools/show_plans.py [sf_dir] name [name ...]   (meant for the small tables)
The final plan shows what ran: pushed filters, codegen stages (*(n)),
exchanges, join strategies and AQE changes (coalesced reads, skew splits).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestrata.plans.registry import QUERIES  # noqa: E402
from lakestrata.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")] or ["silver_flags", "gold_counts"]
    spark = local_session(8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # runs this DataFrame's own plan (small tables), so the final plan is set
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        print(f"===== {name}\n{final}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

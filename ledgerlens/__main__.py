"""Command line: list, run or explain the registered queries.

    python -m ledgerlens list
    python -m ledgerlens run q05_1_gross_profit_by_product_category_year /root/testdata/sf0.01 [rows]
    python -m ledgerlens explain q07_8_pareto_customers /root/testdata/sf0.01
"""

from __future__ import annotations

import sys

from .plans.registry import QUERIES


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in ("list", "run", "explain"):
        print(__doc__)
        return 2
    if argv[0] == "list":
        print("\n".join(QUERIES))
        return 0
    from .session import build_session
    name, sf_dir = argv[1], argv[2]
    spark = build_session()
    df = QUERIES[name](spark, sf_dir)
    if argv[0] == "explain":
        df.explain(mode="formatted")
    else:
        df.show(int(argv[3]) if len(argv) > 3 else 20, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

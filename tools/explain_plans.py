"""Print the formatted physical plan of registered queries.

Usage: python tools/explain_plans.py [tables_dir] [key ...]

With no keys, the bench's headline queries are shown. Look for
``PushedFilters`` / ``PartitionFilters`` / ``ReadSchema`` on the scans,
partial and final ``HashAggregate``, ``WindowGroupLimit`` before the silver
dedup exchange, and ``TakeOrderedAndProject`` for the top-k reports.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from strata.registry import QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402


def main() -> int:
    tables_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or bench.HEADLINE
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for key in keys:
        print(f"\n######## {key}")
        QUERIES[key](spark, tables_dir).explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main())

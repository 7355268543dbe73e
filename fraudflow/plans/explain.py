"""Print the physical plan of catalogue queries.

    python -m fraudflow.plans.explain fraud_loss_1d per_sender_pivot [--sf DIR] [--mode formatted]

Use it to check that filters reach the scans (``PushedFilters``), that only
the needed columns are read (``ReadSchema``), where the exchanges are, and
which joins are broadcast.
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    from ..session import get_spark
    from .catalog import QUERIES
    p = argparse.ArgumentParser()
    p.add_argument("names", nargs="*")
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("--mode", default="formatted")
    p.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)
    spark = get_spark(a.master, app="fraudflow-explain")
    for name in a.names or sorted(QUERIES):
        print(f"===== {name} =====")
        QUERIES[name](spark, a.sf).explain(a.mode)


if __name__ == "__main__":
    main()

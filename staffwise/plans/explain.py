"""Print the physical plans of registered queries.

    python -m staffwise.plans.explain state_summary low_staffing [--sf-dir DIR] [--brief]

``--brief`` keeps only the lines that matter for scale: scans (with pushed
filters and read schema), exchanges, joins, aggregates and window limits.
"""

from __future__ import annotations

import argparse
import io
from contextlib import redirect_stdout

KEYS = ("Scan", "PushedFilters", "PartitionFilters", "ReadSchema", "Exchange", "Join",
        "HashAggregate", "WindowGroupLimit", "Window", "BroadcastExchange")


def formatted_plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def brief(plan: str) -> str:
    return "\n".join(line for line in plan.splitlines() if any(k in line for k in KEYS))


def main(argv=None) -> None:
    from pyspark.sql import SparkSession

    from staffwise.plans.queries import QUERIES

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("queries", nargs="+", choices=sorted(QUERIES))
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--brief", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    for name in args.queries:
        plan = formatted_plan(QUERIES[name](spark, args.sf_dir))
        print(f"===== {name}\n{brief(plan) if args.brief else plan}")


if __name__ == "__main__":
    main()

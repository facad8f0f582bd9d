"""Print the formatted physical plan of registered queries, with a one-line summary.

Usage: python tools/explain.py [sf_dir] name [name ...]
Summary: number of shuffles (Exchange), broadcasts, window operators, and the
filters pushed into each Parquet scan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quantlake.plans.catalog import load_all  # noqa: E402
from quantlake.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark("local[8]", 8)
    reg = load_all()
    for n in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            reg[n].fn(spark, sf).explain("formatted")
        plan = buf.getvalue()
        tree = plan.split("\n\n(1)")[0]
        shuffles = len(re.findall(r"\bExchange\b", tree))   # \b skips BroadcastExchange
        print(f"== {n}: {shuffles} shuffle(s), {tree.count('BroadcastExchange')} broadcast(s), "
              f"{tree.count('Window')} window(s)")
        for pf in re.findall(r"PushedFilters: (\[.*?\])", plan):
            print("   pushed:", pf)
        print(plan)


if __name__ == "__main__":
    main()

"""Condensed physical plans of the registered queries.

    python tools/plan_report.py /root/testdata/sf0.1 [name ...] > PLANS.txt

For each query: operator tree (as ``explain("formatted")`` prints it), the
columns each parquet scan reads, and the filters pushed into it.  Queries
that write (CSV, store, stream) are shown for the frame they return.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def condensed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    keep = []
    for line in details.splitlines():
        if re.match(r"^(ReadSchema|PushedFilters|Arguments: (hashpartitioning|RoundRobin|rangepartitioning|SinglePartition|\d+, \[))", line):
            keep.append("    " + line[:240])
    return tree.replace("== Physical Plan ==\n", "") + "\n" + "\n".join(keep)


def main() -> None:
    from tonalyze.plans import catalog
    from tonalyze.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(catalog.QUERIES)
    spark = build_session("local[8]", extra={"spark.ui.showConsoleProgress": "false"})
    for name in names:
        print(f"### {name}\n```")
        print(condensed(catalog.QUERIES[name](spark, sf)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()

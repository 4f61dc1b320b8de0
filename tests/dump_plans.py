"""Print the physical plan trees of the key queries (``explain('formatted')``,
tree part only), as recorded in docs/PLANS.md.

    python tests/dump_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY = ["prepare", "splits", "fraction_splits", "ranking_metrics", "topk_lists_running",
       "als_topk_explicit"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n")[0].replace("== Physical Plan ==\n", "")


def main() -> None:
    from __spark_entry__ import queries
    from recsift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or KEY
    spark = local_session(8)
    q = queries()
    for name in names:
        print(f"### {name}\n\n```\n{tree(q[name](spark, sf))}\n```\n")


if __name__ == "__main__":
    main()

"""Write the physical plan tree of every registered query to PLANS.md.

Usage: python tools/explain_all.py [--sf DIR] [--out PLANS.md]
Only the operator tree of ``explain("formatted")`` is kept (no node detail).
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cinelake.session import build_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    body = text.split("== Physical Plan ==", 1)[-1].strip("\n")
    return body.split("\n\n", 1)[0]


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="PLANS.md")
    args = ap.parse_args(argv)
    from cinelake.registry import REGISTRY

    spark = build_session("local[8]", 16)
    parts = [
        "# Physical plans",
        "",
        f"Operator trees of `explain(\"formatted\")` for every registered query on `{args.sf}`",
        "(before AQE re-planning; generated by `tools/explain_all.py`).",
        "",
    ]
    for key, fn in sorted(REGISTRY.items()):
        parts += [f"## {key}", "", "```", tree(fn(spark, args.sf)), "```", ""]
    with open(args.out, "w", encoding="utf-8") as f:
        f.write("\n".join(parts))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Write PLANS.md: the physical plan shape of every registered query.

Usage: python tests/plan_report.py [sf_dir]
For each query: shuffles (Exchange), join strategies, hash aggregates
(every shuffle below an aggregate is preceded by a partial one),
filters pushed into Parquet scans, pruned read schemas, Python nodes.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ["fact_count_distinct", "star_vaccination_fact", "star_dm_regiao_estab", "csv_preamble_scan"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def shape(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "exchanges": len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree)),
        "broadcast joins": tree.count("BroadcastHashJoin"),
        "sort-merge joins": tree.count("SortMergeJoin"),
        "hash aggregates": tree.count("HashAggregate"),
        "scans": tree.count("Scan "),
        "scans with pushed filters": len(re.findall(r"PushedFilters: \[[^\]]", text)),
        "python nodes": sum(tree.count(n) for n in ("BatchEvalPython", "ArrowEvalPython", "InPandas")),
    }


def main(argv):
    from starloom.plans.queries import QUERIES
    from starloom.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    rows, full = [], {}
    for name, fn in QUERIES.items():
        text = formatted(fn(spark, sf_dir))
        rows.append((name, shape(text)))
        if name in HEADLINE:
            full[name] = text
    cols = list(rows[0][1])
    out = ["# Physical plans", "",
           f"Generated by `python tests/plan_report.py` at `{sf_dir}` (local[8], AQE on). Exchange counts are "
           "shuffles before AQE re-planning; the round-trip and stream queries show the plan of the final read "
           "(their write ran first).", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, s in rows:
        out.append(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    for name, text in full.items():
        out += ["", f"## `{name}`", "", "```", text.strip(), "```"]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print(f"wrote PLANS.md ({len(rows)} queries)")


if __name__ == "__main__":
    main(sys.argv)

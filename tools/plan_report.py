"""Summarise the physical plan of every query of plans/catalog.py into PLANS.md.

usage: python tools/plan_report.py [sf_dir]
For each query: exchanges (with their keys), scans (pushed filters, read
schema), broadcasts, window operators and Python operators, taken from
``explain("formatted")`` before execution (AQE may still coalesce or switch
joins at runtime).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattgrid.plans.catalog import QUERIES  # noqa: E402
from wattgrid.session import build_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    exchanges = re.findall(r"Arguments: (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition[^,\n]*)", text)
    exchanges = [re.sub(r"#\d+L?", "", e) for e in exchanges]
    pushed = sorted(set(re.sub(r"#\d+L?", "", p) for p in re.findall(r"PushedFilters: \[(.*)\]$", text, flags=re.M) if p))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)))
    count = lambda pat: len(re.findall(pat, text, flags=re.M))
    return {
        "exchanges": exchanges,
        "broadcast": count(r"^\(\d+\) BroadcastExchange"),
        "windows": count(r"^\(\d+\) Window"),
        "python": count(r"^\(\d+\) (MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython)"),
        "pushed": pushed,
        "schemas": schemas,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    lines = ["# PLANS", "",
             f"Generated by `tools/plan_report.py` from `explain(\"formatted\")` on {os.path.basename(sf)}.",
             "Exchanges are listed with their partitioning keys; AQE may coalesce partitions or turn a",
             "shuffle join into a broadcast at runtime from measured sizes.", "",
             "| query | exchanges (keys) | broadcasts | windows | python ops | pushed filters |",
             "| --- | --- | --- | --- | --- | --- |"]
    scans = {}
    for name, fn in QUERIES.items():
        if name in ("forecast_gbt", "forecast_metrics", "importance_topn"):
            continue  # model fitting runs at definition time; its plan is Spark ML's
        s = summarise(formatted(fn(spark, sf)))
        ex = "; ".join(s["exchanges"]) or "none"
        lines.append(f"| {name} | {len(s['exchanges'])}: {ex} | {s['broadcast']} | {s['windows']} | "
                     f"{s['python']} | {'; '.join(s['pushed']) or '-'} |")
        for sc in s["schemas"]:
            scans.setdefault(sc, set()).add(name)
    lines += ["", "## Scans (pruned read schemas)", ""]
    for sc, names in sorted(scans.items()):
        lines.append(f"- `{sc}` - {', '.join(sorted(names))}")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()

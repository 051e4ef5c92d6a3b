"""Summarise the physical plans of the headline models into PLANS.md.

For each model: the shuffles (Exchange), joins and their strategy, window
and aggregate operators, and the scans with their pruned schema and pushed
filters -- the facts the scale review looks at.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.plans.models import Models  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

HEADLINE = ["stg_transactions", "int_transactions_fx_enriched", "fct_transactions", "mart_kpi_daily",
            "mart_kpi_user_segments_daily", "fraud_features"]
PARENTS = {"int_transactions_fx_enriched": ["stg_transactions"],
           "fct_transactions": ["int_transactions_fx_enriched", "dim_date", "dim_users_history"],
           "mart_kpi_daily": ["fct_transactions"],
           "mart_kpi_user_segments_daily": ["fct_transactions", "dim_date", "dim_users_history"],
           "fraud_features": ["fct_transactions", "dim_date"]}
KEEP = re.compile(r"(Exchange|Join|WindowGroupLimit|Window |Expand|HashAggregate|SortAggregate|"
                  r"ObjectHashAggregate|Generate|FileScan|BroadcastExchange|Union)")


def summarise(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = KEEP.search(line)
        if not m:
            continue
        s = line.strip().lstrip(":+- ").strip()
        s = re.sub(r"#\d+L?", "", s)
        if s.startswith("FileScan"):
            loc = re.search(r"file:[^\],]*?/([^/\],]+)\]", s)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", s)
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            s = (f"FileScan {loc.group(1) if loc else ''} ReadSchema={rs.group(1) if rs else ''} "
                 f"PushedFilters={pf.group(1) if pf else ''}")
        elif s.startswith(("HashAggregate", "Window", "Expand", "Generate")):
            s = s[:160] + ("..." if len(s) > 160 else "")
        else:
            s = s[:200] + ("..." if len(s) > 200 else "")
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        out.append("  " * min(depth, 12) + s)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.sql.maxMetadataStringLength": "2000",
                                 "spark.sql.debug.maxToStringFields": "200"})
    spark.sparkContext.setLogLevel("ERROR")
    built = Models(spark, sf_dir).build(["stg_transactions", "int_transactions_fx_enriched", "dim_date",
                                         "dim_users_history", "fct_transactions"])
    print("# Physical plans of the headline models\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8]); each model reads its "
          "materialised parents, as in the build.  Final adaptive plans after one execution.\n")
    for name in HEADLINE:
        m = Models(spark, sf_dir)
        for p in PARENTS.get(name, []):
            m.__dict__[p] = getattr(built, p)
        df = getattr(m, name)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(summarise(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()

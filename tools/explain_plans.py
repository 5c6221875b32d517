"""Write PLANS.md: the physical plans of the headline queries, with the properties checked.

    python tools/explain_plans.py /root/testdata/sf0.01 PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fareline.operators import cleanse as C  # noqa: E402
from fareline.operators import reports as R  # noqa: E402
from fareline.plans.catalog import QUERIES  # noqa: E402
from fareline.plans.explain import plan_text  # noqa: E402
from fareline.plans.month_job import MonthJob, build_month  # noqa: E402
from fareline.session import build_session, shared_dir  # noqa: E402
from fareline.sources.testdata import raw_trips, raw_zones  # noqa: E402

CHECKS = [
    ("partial WindowGroupLimit before the exchange (map-side dedup)", r"row_number\(\), 1, Partial"),
    ("Parquet PushedFilters on the scan", r"PushedFilters: \[[^\]]+\]"),
    ("BroadcastHashJoin for zone lookups", r"BroadcastHashJoin"),
    ("partial + final HashAggregate", r"HashAggregate"),
    ("TakeOrderedAndProject for top-k", r"TakeOrderedAndProject"),
    ("no CartesianProduct / nested-loop join", r"CartesianProduct|BroadcastNestedLoopJoin"),
    ("no Python UDF", r"BatchEvalPython|ArrowEvalPython"),
    ("metrics collected after the exchange (result stage)", r"CollectMetrics"),
]


def physical(text: str) -> str:
    return text.split("\n\n(1)")[0]


def main():
    sf_dir, out = sys.argv[1], sys.argv[2]
    scratch = tempfile.mkdtemp(prefix="fareline-plans-")
    spark = build_session(extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    shared_dir(spark)
    landing = f"{scratch}/raw"
    raw_trips(spark, sf_dir).write.parquet(landing)  # a real Parquet landing, so scan pushdown shows
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    observed = C.finish(
        C.rule_filter(C.with_measures(C.dedup_raw(spark.read.parquet(landing))), C.RULE_NAMES, 2024, 1)
    ).observe(Observation("c"), F.count(F.lit(1)), F.sum("total_amount"))
    sections = {
        "cleanse over a Parquet landing (O-20..O-33)": C.cleanse(spark.read.parquet(landing)),
        "month job clean write frame (load KPIs observed in the result stage)": observed,
        "fct_trips (O-50..O-63)": QUERIES["fct_trips"](spark, sf_dir),
        "report_top5_boroughs (O-64, O-74, O-78)": QUERIES["report_top5_boroughs"](spark, sf_dir),
        "audit_metrics (O-72, O-73)": QUERIES["audit_metrics"](spark, sf_dir),
    }
    build_month(spark, MonthJob(warehouse=f"{scratch}/wh", fail_on_test_error=False),
                raw=raw_trips(spark, sf_dir), zones=raw_zones(spark, sf_dir))
    fct, dz = spark.table("marts.fct_trips"), spark.table("marts.dim_zones")
    sections["report over the persisted mart (month job output)"] = R.report_top_boroughs(fct, dz, 5)
    lines = ["# Physical plans", "", f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8], AQE on).", ""]
    for title, df in sections.items():
        text = plan_text(df)
        lines += [f"## {title}", "", "```", physical(text).strip(), "```", ""]
        for label, pat in CHECKS:
            found = re.search(pat, text)
            if label.startswith("no "):
                lines.append(f"- {label}: {'VIOLATED' if found else 'yes'}")
            elif found:
                lines.append(f"- {label}: yes")
        pushed = re.findall(r"PushedFilters: \[[^\]]*\]", text)
        if pushed:
            lines.append(f"- scan filters: `{pushed[0]}`")
        schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
        if schemas:
            lines.append(f"- read schema of the first scan: `{schemas[0]}`")
        lines.append("")
    with open(out, "w") as f:
        f.write("\n".join(lines))
    print("wrote", out)


if __name__ == "__main__":
    main()

"""Write docs/PLANS.md: the physical plans of the headline queries.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = ("precision_leads", "build_signatures", "build_compound_metadata", "valid_ids", "moa_mimics", "toxicity_extreme_hits", "final_matrix",
        "final_matrix_pivot", "moa_transfer", "dedup_first", "merge_outer", "late_new_hits", "leads_per_time", "orphaned_signatures", "column_statistics",
        "literature_counts", "gene_statistics")

HEAD = """# Physical plans of headline queries

Generated by `tools/plans.py` at sf0.1 on local[8] (AQE on, initial plans). Each tree shows where
filters and column pruning reach the scan, where aggregation is partial before an exchange, and
which joins Spark chose. File paths are shortened.
"""


def main(argv: list[str]) -> None:
    from sigspark.plans.registry import QUERIES
    from sigspark.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    parts = [HEAD]
    for key in KEYS:
        plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", re.sub(r"\[file:[^\]]*/([^/\]]*)\]", r"[\1]", plan))
        parts.append(f"## `{key}`\n\n```\n{plan.rstrip()}\n```\n")
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv)

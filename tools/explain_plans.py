"""Write PLANS.md: the final physical plan (after AQE) of every registered query of the base library (formatted, trimmed).

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Output", "PushedFilters", "PartitionFilters", "ReadSchema", "Arguments", "Condition", "Keys", "Functions")


def final_only(text: str) -> str:
    """Drop the initial plans that AQE prints below the final ones."""
    kept, skip = [], False
    for line in text.splitlines():
        if "== Initial Plan ==" in line:
            skip = True
            depth = len(line) - len(line.lstrip(" :+-"))
            continue
        if skip and line.strip() and len(line) - len(line.lstrip(" :+-")) < depth:
            skip = False
        if not skip:
            kept.append(line)
    return "\n".join(kept)


def condensed(text: str) -> str:
    """The operator tree plus the lines that show pruning, pushdown and exchanges."""
    out = []
    for line in text.splitlines():
        if not line.strip():
            continue
        if line.startswith(("(", "+-", ":", "*", " ")) or line.startswith("=="):
            out.append(line)
        elif line.split(" ")[0].rstrip(":") in KEEP or line.startswith(KEEP):
            out.append("    " + line[:240])
    return "\n".join(out)


def main(argv):
    from pyspark.sql import SparkSession

    from spoolwire.plans.catalog import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    parts = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local mode, AQE on): the final plan of "
        "each query after it ran. Inputs the queries derive (CSV files, topics) are written first; the "
        "plan shown is the query over them.",
        "",
    ]
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        df.collect()  # so that the plan is the one AQE ended with
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        text = re.sub(r"#\d+L?", "", text).replace("\x00", "\\x00")
        parts += [f"## {name}", "", "```", condensed(final_only(text)), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main(sys.argv[1:])

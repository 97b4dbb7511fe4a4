"""Print the physical plans of the headline reports as Markdown.

Usage: python -m tools.explain_plans [sf_dir] > docs/PLANS.md
The clean table is written once to the checkpoint folder and read back,
as the reports run in production (over a Parquet table).
"""

from __future__ import annotations

import re
import sys
import uuid


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    from tarmac.plans import catalog as C
    from tarmac.plans import reports as R
    from tarmac.session import checkpoint_dir, get_session
    from tarmac.sources.catalog import register_table, run_sql_file

    spark = get_session("local[8]", shuffle_partitions=8)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tarmac_plans_{uuid.uuid4().hex}"
    C.flights(spark, sf_dir).write.parquet(path)
    f = spark.read.parquet(path)
    register_table(spark, "flights", df=f)
    plans = {
        "Q1 carrier_stats": R.carrier_stats(f),
        "Q2 airport_month_report": R.airport_month_report(f),
        "Q3 carrier_vs_airport": R.carrier_vs_airport(f),
        "Q2 SQL form (sql/q2.sql)": run_sql_file(spark, "q2", {"flights": "flights", "k": 3}),
        "Q3 SQL form (sql/q3.sql)": run_sql_file(spark, "q3", {"flights": "flights",
                                                               "rate_scale": 2}),
        "X4 cancel_causes": R.cancel_causes(f),
    }
    print("# Physical plans of the headline reports\n")
    print("Generated by `python -m tools.explain_plans` over the clean table written as "
          "Parquet (local[8], shuffle partitions 8, AQE on; initial plans before AQE "
          "re-optimisation).\n")
    for name, df in plans.items():
        text = df._jdf.queryExecution().executedPlan().toString()
        hashx = len(re.findall(r"Exchange hashpartitioning", text))
        rangex = len(re.findall(r"Exchange rangepartitioning", text))
        schema = re.findall(r"ReadSchema: (\S+)", text)
        pushed = re.findall(r"PushedFilters: (\[[^\]]*\])", text)
        print(f"## {name}\n")
        print(f"- scans: {text.count('FileScan parquet')}")
        print(f"- hash exchanges: {hashx}; range exchanges (final ORDER BY): {rangex}")
        print(f"- scan ReadSchema: `{schema[0] if schema else '-'}`")
        print(f"- PushedFilters: `{pushed[0] if pushed else '-'}`\n")
        text = re.sub(r"#\d+L?", "", text)
        text = re.sub(r"file:[^\],]*", "<path>", text)
        print("```")
        print(text.rstrip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

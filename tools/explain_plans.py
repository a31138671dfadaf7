"""Print the physical plans of the heavy steps, to check joins, exchanges and pushdown.

    python tools/explain_plans.py [sf_dir] [--formatted]

Steps: the valid-row ingest pass (split offsets broadcast, no shuffle of the
lines), the fact build, the bridge build, and two reports.
"""
from __future__ import annotations

import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from starforge.operators.ingest import read_classified, split_counts, split_offsets, typed_from_raw  # noqa: E402
from starforge.operators.star import build_bridge_job_skills, build_fact_jobs, with_job_id  # noqa: E402
from starforge.plans import registry, reports  # noqa: E402
from starforge.session import get_spark, scratch_path  # noqa: E402


def show(name, df, formatted):
    print(f"===== {name}")
    if formatted:
        df.explain("formatted")
    else:
        print(df._jdf.queryExecution().executedPlan().toString())


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    formatted = "--formatted" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    m = registry.model(spark, sf_dir)
    t = m.tables

    classified = read_classified(spark, m.csv_path)
    out = scratch_path(spark, "explain")
    split_counts(classified).write.parquet(f"{out}/counts")
    split_offsets(spark.read.parquet(f"{out}/counts")).write.parquet(f"{out}/stats")
    off = F.broadcast(spark.read.parquet(f"{out}/stats").drop("_n", "_ng", "_nb", "_header_hash"))
    good = classified.join(off, ["_file", "_block"]).where(F.col("_ok")).withColumn(
        "_gpos", F.monotonically_increasing_id())
    show("ingest: valid-row pass", good, formatted)

    jobs = with_job_id(typed_from_raw(t["raw_jobs"]))
    show("fact_jobs", build_fact_jobs(jobs, t["dim_companies"], t["dim_locations"]), formatted)
    show("bridge_job_skills", build_bridge_job_skills(jobs, t["dim_skills"]), formatted)
    show("top_skills (R5)", reports.top_skills(t), formatted)
    show("salary_by_skill (R13)", reports.salary_by_skill(t), formatted)


if __name__ == "__main__":
    main()

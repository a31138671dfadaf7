"""A star with deterministic damage, so that the checks have something to find.

Rows are chosen by arithmetic on their ids; the SQL oracle repeats it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Added to a key to make it refer to nothing.
NOWHERE = 1_000_000_000


def _replaced(df: DataFrame, column: str, where: str, value: str) -> DataFrame:
    return df.withColumn(column, F.when(F.expr(where), F.expr(value).cast(df.schema[column].dataType)).otherwise(F.col(column)))


def _repeated(df: DataFrame, where: str) -> DataFrame:
    return df.unionByName(df.where(where))


def damaged(t: dict) -> dict:
    """The seven tables with repeated and missing keys, repeated names, missing names and dangling references."""
    companies = _repeated(t["dim_companies"], "company_id % 97 = 3")
    companies = _replaced(companies, "company_name", "company_id % 101 = 5", "NULL")
    companies = _replaced(companies, "company_name", "company_id % 89 = 0", "'The same name'")
    locations = t["dim_locations"]
    again = locations.where("location_id % 71 = 2").withColumn("location_id", F.col("location_id") + NOWHERE)
    nowhere = locations.where("location_id % 73 = 4").withColumn("country", F.lit(None).cast("string"))
    locations = locations.unionByName(again).unionByName(nowhere)
    skills = _replaced(t["dim_skills"], "skill_id", "skill_id % 31 = 6", "NULL")
    skills = _replaced(skills, "skill_name", "skill_id % 29 = 1", "NULL")
    skills = _replaced(skills, "skill_name", "skill_id % 23 = 2", "'one skill'")
    fact = _replaced(t["fact_jobs"], "company_id", "job_id % 53 = 0", f"company_id + {NOWHERE}")
    fact = _replaced(fact, "location_id", "job_id % 59 = 0", "-location_id")
    fact = _repeated(fact, "job_id % 61 = 1")
    fact = _replaced(fact, "job_id", "job_id % 67 = 2", "NULL")
    bridge = _repeated(t["bridge_job_skills"], "(job_id + skill_id) % 61 = 0")
    bridge = _repeated(bridge, "job_id % 3 = 0 AND skill_id % 7 = 1")
    bridge = _replaced(bridge, "skill_id", "job_id % 47 = 7", f"skill_id + {NOWHERE}")
    bridge = _replaced(bridge, "job_id", "job_id % 43 = 9", "NULL")
    raw = _replaced(_repeated(t["raw_jobs"], "raw_id % 83 = 1"), "raw_id", "raw_id % 79 = 3", "NULL")
    rejected = _replaced(_repeated(t["raw_jobs_rejected"], "rejected_id % 5 = 0"), "line_number", "rejected_id % 7 = 0", "NULL")
    return {"dim_companies": companies, "dim_locations": locations, "dim_skills": skills, "fact_jobs": fact,
            "bridge_job_skills": bridge, "raw_jobs": raw, "raw_jobs_rejected": rejected}

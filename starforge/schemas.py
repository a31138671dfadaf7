"""Fixed values and table schemas.

The names, title set, arity and labels below are FIXED VALUES: they must equal
the source system's for results to match, so they are stated plainly here.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------
# The 17 header names of the postings CSV, in file order.
CSV_COLUMNS = [
    "job_title_short", "job_title", "job_location", "job_via",
    "job_schedule_type", "job_work_from_home", "search_location",
    "job_posted_date", "job_no_degree_mention", "job_health_insurance",
    "job_country", "salary_rate", "salary_year_avg", "salary_hour_avg",
    "company_name", "job_skills", "job_type_skills",
]
EXPECTED_COLS = 17

# The ten accepted values of job_title_short.
VALID_JOB_TITLES = [
    "Data Analyst", "Data Engineer", "Data Scientist",
    "Senior Data Analyst", "Senior Data Engineer", "Senior Data Scientist",
    "Business Analyst", "Software Engineer", "Machine Learning Engineer",
    "Cloud Engineer",
]

BOOL_COLUMNS = ["job_work_from_home", "job_no_degree_mention", "job_health_insurance"]
NUMBER_COLUMNS = ["salary_year_avg", "salary_hour_avg"]

# Reject rows keep this many characters of the offending line.
REJECT_CONTENT_CHARS = 500
# Load-time stamps are wall-clock time in this zone.
LOAD_TIME_ZONE = "America/Bogota"
# The raw copy stores a missing skills text as this literal.
RAW_NA_TEXT = "<NA>"
# Default category for a skill that no dictionary names.
DEFAULT_SKILL_CATEGORY = "other"

# fact_jobs: source column -> stored column, in stored order.
FACT_COLUMN_MAP = [
    ("company_id", "company_id"),
    ("location_id", "location_id"),
    ("job_title_short", "job_title_short"),
    ("job_title", "job_title"),
    ("job_via", "job_via"),
    ("job_schedule_type", "schedule_type"),
    ("job_work_from_home", "work_from_home"),
    ("job_posted_date", "posted_date"),
    ("job_no_degree_mention", "no_degree_mention"),
    ("job_health_insurance", "health_insurance"),
    ("salary_rate", "salary_rate"),
    ("salary_year_avg", "salary_year_avg"),
    ("salary_hour_avg", "salary_hour_avg"),
]

# Table names and their report descriptions (row-count report labels).
TABLE_LABELS = [
    ("raw_jobs", "Copia exacta del CSV (filas válidas)"),
    ("raw_jobs_rejected", "Filas del CSV con problemas"),
    ("dim_companies", "Empresas únicas"),
    ("dim_locations", "Ubicaciones únicas"),
    ("dim_skills", "Habilidades técnicas únicas"),
    ("fact_jobs", "Avisos de trabajo (tabla principal)"),
    ("bridge_job_skills", "Relaciones aviso↔habilidad"),
]
# ---- end of fixed values --------------------------------------------------

S, B, D, I, L = T.StringType(), T.BooleanType(), T.DoubleType(), T.IntegerType(), T.LongType()
TS = T.TimestampNTZType()

# Typed postings (what ingest produces, before the parsed columns).
TYPED_POSTING = T.StructType([
    T.StructField("job_title_short", S), T.StructField("job_title", S),
    T.StructField("job_location", S), T.StructField("job_via", S),
    T.StructField("job_schedule_type", S), T.StructField("job_work_from_home", B, False),
    T.StructField("search_location", S), T.StructField("job_posted_date", TS),
    T.StructField("job_no_degree_mention", B, False), T.StructField("job_health_insurance", B, False),
    T.StructField("job_country", S), T.StructField("salary_rate", S),
    T.StructField("salary_year_avg", D), T.StructField("salary_hour_avg", D),
    T.StructField("company_name", S), T.StructField("job_skills", S),
    T.StructField("job_type_skills", S),
])

SKILL_GROUPS = T.ArrayType(T.StructType([
    T.StructField("category", S), T.StructField("skills", T.ArrayType(S)),
]))

RAW_JOBS_SCHEMA = T.StructType(
    [T.StructField("raw_id", L, False)]
    + [T.StructField(f.name, f.dataType, f.nullable) for f in TYPED_POSTING.fields]
    + [T.StructField("ingested_at", TS), T.StructField("source_file", S), T.StructField("line_number", L),
       T.StructField("job_skills_parsed", T.ArrayType(S)), T.StructField("job_type_skills_parsed", SKILL_GROUPS)])

REJECT_SCHEMA = T.StructType([
    T.StructField("rejected_id", L), T.StructField("source_file", S),
    T.StructField("line_number", L, False), T.StructField("fields_found", I),
    T.StructField("fields_expected", I), T.StructField("raw_content", S),
    T.StructField("ingested_at", TS),
])

BRIDGE_SCHEMA = T.StructType([T.StructField("job_id", L), T.StructField("skill_id", L)])

DIM_COMPANIES_SCHEMA = T.StructType([T.StructField("company_id", L, False), T.StructField("company_name", S, False)])
DIM_LOCATIONS_SCHEMA = T.StructType([
    T.StructField("location_id", L, False), T.StructField("raw_location", S),
    T.StructField("city", S), T.StructField("country", S)])
DIM_SKILLS_SCHEMA = T.StructType([
    T.StructField("skill_id", L, False), T.StructField("skill_name", S, False), T.StructField("skill_category", S)])
FACT_JOBS_SCHEMA = T.StructType([
    T.StructField("job_id", L, False), T.StructField("_csv_row", L, False),
    T.StructField("company_id", L), T.StructField("location_id", L),
    T.StructField("job_title_short", S), T.StructField("job_title", S), T.StructField("job_via", S),
    T.StructField("schedule_type", S), T.StructField("work_from_home", B),
    T.StructField("posted_date", TS), T.StructField("no_degree_mention", B),
    T.StructField("health_insurance", B), T.StructField("salary_rate", S),
    T.StructField("salary_year_avg", D), T.StructField("salary_hour_avg", D)])

# L2/L3: the declared schema of every stored table.
TABLE_SCHEMAS = {
    "raw_jobs": RAW_JOBS_SCHEMA,
    "raw_jobs_rejected": REJECT_SCHEMA,
    "dim_companies": DIM_COMPANIES_SCHEMA,
    "dim_locations": DIM_LOCATIONS_SCHEMA,
    "dim_skills": DIM_SKILLS_SCHEMA,
    "fact_jobs": FACT_JOBS_SCHEMA,
    "bridge_job_skills": BRIDGE_SCHEMA,
}

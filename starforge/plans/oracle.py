"""DuckDB SQL equivalents of the registry queries (the correctness oracle).

The SQL rebuilds the postings sample, the CSV line numbering, the broken lines
and the seven tables straight from the driver's tables with window functions,
independently of the Spark code paths.
"""
from __future__ import annotations

from starforge import schemas
from starforge.plans.registry import EXTRA_TITLES, LOAD_STAMP, SKILL_OF_INTEREST
from starforge.sources import postings as P


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _q(x: str) -> str:
    """CSV-quote a field when it holds a comma or a quote."""
    x = f"coalesce({x}, '')"
    return (f"(CASE WHEN contains({x}, ',') OR contains({x}, '\"') "
            f"THEN '\"' || replace({x}, '\"', '\"\"') || '\"' ELSE {x} END)")


def _excel(fields: list) -> str:
    inner = "concat_ws(',', " + ", ".join(_q(f) for f in fields) + ")"
    return f"('\"' || replace({inner}, '\"', '\"\"') || '\"')"


def _pct(num: str, den: str, scale: int = 1) -> str:
    p = 10 ** scale
    units = f"((CAST({num} AS HUGEINT) * {200 * p} + ({den})) // (2 * CAST({den} AS HUGEINT)))"
    return (f"(CASE WHEN ({den}) > 0 THEN CAST({units} // {p} AS VARCHAR) || '.' || "
            f"lpad(CAST({units} % {p} AS VARCHAR), {scale}, '0') || '%' END)")


def _money(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN NULL ELSE '$' || format('{{:,}}', "
            f"CAST(round(CAST({x} AS DECIMAL(38,10)), 0) AS BIGINT)) END)")


_FIELDS = ["job_title_short", "job_title", "job_location", "job_via", "job_schedule_type",
           "CASE WHEN job_work_from_home THEN 'True' ELSE 'False' END", "search_location",
           "strftime(job_posted_date, '%Y-%m-%d %H:%M:%S')",
           "CASE WHEN job_no_degree_mention THEN 'True' ELSE 'False' END",
           "CASE WHEN job_health_insurance THEN 'True' ELSE 'False' END",
           "job_country", "salary_rate", "sy_text", "sh_text", "company_name", "job_skills", "job_type_skills"]

BASE = f"""
WITH items AS (
  SELECT l.l_orderkey AS k, p.p_name AS name, p.p_type AS ptype,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey) AS r
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
cat_first AS (SELECT k, ptype, min(r) AS first_r FROM items GROUP BY k, ptype),
cat_text AS (
  SELECT i.k, c.first_r,
         '''' || c.ptype || ''': [' || string_agg('''' || i.name || '''', ', ' ORDER BY i.r) || ']' AS t
  FROM items i JOIN cat_first c ON i.k = c.k AND i.ptype = c.ptype
  GROUP BY i.k, c.ptype, c.first_r
),
sk AS (
  SELECT k,
    CASE WHEN k % {P.DQ_EVERY} = {P.DQ_AT}
         THEN '[' || string_agg('"' || name || '"', ', ' ORDER BY r) || ',]'
         ELSE '[' || string_agg('''' || name || '''', ', ' ORDER BY r) || ']' END AS js
  FROM items GROUP BY k
),
dt AS (SELECT k, '{{' || string_agg(t, ', ' ORDER BY first_r) || '}}' AS jts FROM cat_text GROUP BY k),
postings AS (
  SELECT o.o_orderkey AS k,
    {_list(schemas.VALID_JOB_TITLES)}[(o.o_orderkey % 10) + 1] AS job_title_short,
    'Sr "' || c.c_mktsegment || '", ' || o.o_orderpriority
      || CASE WHEN o.o_orderkey % {P.BYTE_EVERY} = {P.BYTE_AT} THEN chr(65533) ELSE '' END AS job_title,
    CASE WHEN o.o_orderkey % 23 = 0 THEN NULL
         ELSE 'City' || CAST(o.o_custkey % 40 AS VARCHAR) || ', ST' END AS job_location,
    'via ' || c.c_mktsegment AS job_via,
    CASE o.o_orderstatus WHEN 'O' THEN 'Full-time' WHEN 'F' THEN 'Contractor' ELSE 'Part-time' END
      AS job_schedule_type,
    o.o_orderstatus = 'F' AS job_work_from_home,
    n.n_name AS search_location,
    o.o_orderdate AS job_posted_date,
    o.o_orderkey % 2 = 0 AS job_no_degree_mention,
    o.o_orderkey % 3 = 0 AS job_health_insurance,
    n.n_name AS job_country,
    CASE WHEN o.o_orderstatus = 'P' THEN 'hour' ELSE 'year' END AS salary_rate,
    CASE WHEN o.o_orderstatus <> 'P' THEN CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS sy_text,
    CASE WHEN o.o_orderstatus = 'P' THEN CAST(CAST(o.o_totalprice / 1000 AS DECIMAL(18,5)) AS VARCHAR) END
      AS sh_text,
    CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_name END AS company_name,
    o.o_totalprice AS price,
    CASE WHEN o.o_orderkey % {P.MISSING_EVERY} <> {P.MISSING_AT} THEN coalesce(sk.js, '[]') END AS job_skills,
    CASE WHEN o.o_orderkey % {P.MISSING_EVERY} <> {P.MISSING_AT} THEN coalesce(dt.jts, '{{}}') END AS job_type_skills,
    o.o_orderkey // {P.POSTINGS_PER_FILE} AS bucket,
    CASE WHEN o.o_orderkey % {P.BLANK_EVERY} = {P.BLANK_AT} THEN 1 ELSE 0 END
      + CASE WHEN o.o_orderkey % {P.BARE_EVERY} = {P.BARE_AT} THEN 1 ELSE 0 END AS blank_after,
    o.o_orderkey % {P.BROKEN_EVERY} = {P.BROKEN_AT} AS broken
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN sk ON sk.k = o.o_orderkey
  LEFT JOIN dt ON dt.k = o.o_orderkey
),
numbered AS (
  SELECT *,
    CAST(1 + row_number() OVER (PARTITION BY bucket ORDER BY k)
      + coalesce(sum(blank_after) OVER (PARTITION BY bucket ORDER BY k
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_number
  FROM postings
),
valid AS (
  SELECT *, row_number() OVER (ORDER BY k) AS job_id,
         CAST(sy_text AS DOUBLE) AS salary_year_avg, CAST(sh_text AS DOUBLE) AS salary_hour_avg
  FROM numbered WHERE NOT broken
),
raw_jobs AS (
  SELECT job_id AS raw_id, job_title_short, job_title, job_location, job_via, job_schedule_type,
         job_work_from_home, search_location, job_posted_date, job_no_degree_mention, job_health_insurance,
         job_country, salary_rate, salary_year_avg, salary_hour_avg, company_name,
         coalesce(job_skills, '{schemas.RAW_NA_TEXT}') AS job_skills,
         coalesce(job_type_skills, '{schemas.RAW_NA_TEXT}') AS job_type_skills,
         TIMESTAMP '{LOAD_STAMP}' AS ingested_at, line_number
  FROM valid
),
raw_jobs_rejected AS (
  SELECT row_number() OVER (ORDER BY bucket, line_number) AS rejected_id, bucket, line_number,
         CAST(NULL AS INTEGER) AS fields_found, CAST({schemas.EXPECTED_COLS} AS INTEGER) AS fields_expected,
         left({_excel(_FIELDS[:P.BROKEN_FIELDS])}, {schemas.REJECT_CONTENT_CHARS}) AS raw_content,
         TIMESTAMP '{LOAD_STAMP}' AS ingested_at
  FROM numbered WHERE broken
),
dim_companies AS (
  SELECT row_number() OVER (ORDER BY company_name) AS company_id, company_name
  FROM (SELECT DISTINCT company_name FROM valid WHERE company_name IS NOT NULL)
),
dim_locations AS (
  SELECT row_number() OVER (ORDER BY first_id) AS location_id, job_location AS raw_location,
         trim(split_part(job_location, ',', 1)) AS city, job_country AS country
  FROM (SELECT job_location, job_country, min(job_id) AS first_id FROM valid
        WHERE job_location IS NOT NULL GROUP BY job_location, job_country)
),
vitems AS (
  SELECT v.job_id, i.name, i.ptype, i.r, c.first_r
  FROM valid v JOIN items i ON i.k = v.k JOIN cat_first c ON c.k = i.k AND c.ptype = i.ptype
  WHERE v.job_skills IS NOT NULL
),
dim_skills AS (
  SELECT row_number() OVER (ORDER BY skill_name) AS skill_id, skill_name, skill_category
  FROM (SELECT name AS skill_name, arg_min(ptype, (job_id, first_r, r)) AS skill_category
        FROM vitems GROUP BY name)
),
loc_last AS (SELECT raw_location, max(location_id) AS location_id FROM dim_locations GROUP BY raw_location),
fact_jobs AS (
  SELECT v.job_id, v.job_id - 1 AS _csv_row, dc.company_id, ll.location_id,
         v.job_title_short, v.job_title, v.job_via, v.job_schedule_type AS schedule_type,
         v.job_work_from_home AS work_from_home, v.job_posted_date AS posted_date,
         v.job_no_degree_mention AS no_degree_mention, v.job_health_insurance AS health_insurance,
         v.salary_rate, v.salary_year_avg, v.salary_hour_avg
  FROM valid v
  LEFT JOIN dim_companies dc ON v.company_name = dc.company_name
  LEFT JOIN loc_last ll ON v.job_location = ll.raw_location
),
bridge_job_skills AS (
  SELECT DISTINCT vi.job_id, ds.skill_id FROM vitems vi JOIN dim_skills ds ON ds.skill_name = vi.name
)
"""

_LABELS = " ".join(f"WHEN tabla = '{t}' THEN '{d}'" for t, d in schemas.TABLE_LABELS)
_COUNTS = "\n  UNION ALL ".join(f"SELECT '{t}' AS tabla, CAST(count(*) AS BIGINT) AS filas FROM {t}"
                               for t, _ in schemas.TABLE_LABELS)


def _key_checks_sql(prefix: str = "") -> str:
    """G1-G5 written directly in SQL (violation counts) over the tables with ``prefix``."""
    parts = []
    for tbl, keys in [("raw_jobs", ["raw_id"]), ("raw_jobs_rejected", ["rejected_id"]),
                      ("dim_companies", ["company_id"]), ("dim_locations", ["location_id"]),
                      ("dim_skills", ["skill_id"]), ("fact_jobs", ["job_id"]),
                      ("bridge_job_skills", ["job_id", "skill_id"])]:
        ks = ", ".join(keys)
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        anynull = " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(f"SELECT 'pk_unique:{tbl}' AS \"check\", CAST(count(*) AS BIGINT) AS violations FROM "
                     f"(SELECT {ks} FROM {prefix}{tbl} WHERE {nn} GROUP BY {ks} HAVING count(*) > 1)")
        parts.append(f"SELECT 'pk_not_null:{tbl}', CAST(count(*) FILTER (WHERE {anynull}) AS BIGINT) FROM {prefix}{tbl}")
    uniq = [("dim_companies", "company_name", "unique:dim_companies.company_name"),
            ("dim_locations", "raw_location, country", "unique:dim_locations.raw_location_country"),
            ("dim_skills", "skill_name", "unique:dim_skills.skill_name")]
    for tbl, ks, name in uniq:
        nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in ks.split(","))
        parts.append(f"SELECT '{name}', CAST(count(*) AS BIGINT) FROM "
                     f"(SELECT {ks} FROM {prefix}{tbl} WHERE {nn} GROUP BY {ks} HAVING count(*) > 1)")
    fks = [("fact_jobs", "company_id", "dim_companies", "company_id", "fk:fact_jobs.company_id"),
           ("fact_jobs", "location_id", "dim_locations", "location_id", "fk:fact_jobs.location_id"),
           ("bridge_job_skills", "job_id", "fact_jobs", "job_id", "fk:bridge_job_skills.job_id"),
           ("bridge_job_skills", "skill_id", "dim_skills", "skill_id", "fk:bridge_job_skills.skill_id")]
    for c, fk, p, pk, name in fks:
        parts.append(f"SELECT '{name}', CAST(count(*) AS BIGINT) FROM {prefix}{c} ch WHERE ch.{fk} IS NOT NULL "
                     f"AND NOT EXISTS (SELECT 1 FROM {prefix}{p} pa WHERE pa.{pk} = ch.{fk})")
    for tbl, col, name in [("dim_companies", "company_name", "not_null:dim_companies.company_name"),
                           ("dim_skills", "skill_name", "not_null:dim_skills.skill_name"),
                           ("raw_jobs_rejected", "line_number", "not_null:raw_jobs_rejected.line_number")]:
        parts.append(f"SELECT '{name}', CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) FROM {prefix}{tbl}")
    return "\nUNION ALL ".join(parts)



# The damage of ``plans.damage``, written again.
DAMAGED = """
, d1 AS (
  SELECT * FROM dim_companies UNION ALL SELECT * FROM dim_companies WHERE company_id % 97 = 3
), bad_dim_companies AS (
  SELECT company_id, CASE WHEN company_id % 89 = 0 THEN 'The same name' WHEN company_id % 101 = 5 THEN NULL ELSE company_name END AS company_name
  FROM d1
), bad_dim_locations AS (
  SELECT location_id, raw_location, country FROM dim_locations
  UNION ALL SELECT location_id + 1000000000, raw_location, country FROM dim_locations WHERE location_id % 71 = 2
  UNION ALL SELECT location_id, raw_location, NULL FROM dim_locations WHERE location_id % 73 = 4
), d2 AS (
  SELECT CASE WHEN skill_id % 31 <> 6 THEN skill_id END AS skill_id, skill_name FROM dim_skills
), bad_dim_skills AS (
  SELECT skill_id, CASE WHEN skill_id % 23 = 2 THEN 'one skill' WHEN skill_id % 29 = 1 THEN NULL ELSE skill_name END AS skill_name FROM d2
), d3 AS (
  SELECT job_id, CASE WHEN job_id % 53 = 0 THEN company_id + 1000000000 ELSE company_id END AS company_id,
         CASE WHEN job_id % 59 = 0 THEN -location_id ELSE location_id END AS location_id FROM fact_jobs
), bad_fact_jobs AS (
  SELECT CASE WHEN job_id % 67 <> 2 THEN job_id END AS job_id, company_id, location_id
  FROM (SELECT * FROM d3 UNION ALL SELECT * FROM d3 WHERE job_id % 61 = 1)
), d4 AS (
  SELECT * FROM bridge_job_skills UNION ALL SELECT * FROM bridge_job_skills WHERE (job_id + skill_id) % 61 = 0
), d5 AS (
  SELECT * FROM d4 UNION ALL SELECT * FROM d4 WHERE job_id % 3 = 0 AND skill_id % 7 = 1
), bad_bridge_job_skills AS (
  SELECT CASE WHEN job_id % 43 <> 9 THEN job_id END AS job_id,
         CASE WHEN job_id % 47 = 7 THEN skill_id + 1000000000 ELSE skill_id END AS skill_id FROM d5
), bad_raw_jobs AS (
  SELECT CASE WHEN raw_id % 79 <> 3 THEN raw_id END AS raw_id
  FROM (SELECT raw_id FROM raw_jobs UNION ALL SELECT raw_id FROM raw_jobs WHERE raw_id % 83 = 1)
), bad_raw_jobs_rejected AS (
  SELECT rejected_id, CASE WHEN rejected_id % 7 <> 0 THEN line_number END AS line_number
  FROM (SELECT rejected_id, line_number FROM raw_jobs_rejected
        UNION ALL SELECT rejected_id, line_number FROM raw_jobs_rejected WHERE rejected_id % 5 = 0)
)
"""


def _profile_sql() -> str:
    """Declared columns of every table, with the rows and NULLs of the rebuilt ones."""
    parts = []
    # columns that the rebuilt tables do not have; they hold no NULL
    extra = {"source_file", "job_skills_parsed", "job_type_skills_parsed"}
    for table, schema in schemas.TABLE_SCHEMAS.items():
        for i, f in enumerate(schema.fields):
            nulls = "0" if f.name in extra else f"count(*) - count({f.name})"
            parts.append(f"SELECT '{table}' AS tabla, {i + 1} AS posicion, '{f.name}' AS columna, '{f.dataType.simpleString()}' AS tipo, "
                         f"count(*) AS filas, CAST({nulls} AS BIGINT) AS nulos, false AS viola_not_null FROM {table}")
    return "\nUNION ALL ".join(parts)


_TITLES12 = _list(schemas.VALID_JOB_TITLES + EXTRA_TITLES)

ORACLE_TAILS = {
    "dim_companies": "SELECT company_id, company_name FROM dim_companies",
    "dim_locations": "SELECT location_id, raw_location, city, country FROM dim_locations",
    "dim_skills": "SELECT skill_id, skill_name, skill_category FROM dim_skills",
    "fact_jobs": "SELECT * FROM fact_jobs",
    "fact_jobs_by_country": """
        SELECT v.job_id, dl.location_id FROM valid v
        LEFT JOIN dim_locations dl ON v.job_location = dl.raw_location
             AND v.job_country IS NOT DISTINCT FROM dl.country""",
    "bridge_job_skills": "SELECT job_id, skill_id FROM bridge_job_skills",
    "location_lookup": "SELECT raw_location, location_id FROM loc_last",
    "null_key_counts": """SELECT count(*) FILTER (WHERE company_id IS NULL) AS sin_empresa,
                                 count(*) FILTER (WHERE location_id IS NULL) AS sin_ubicacion FROM fact_jobs""",
    "line_numbers": "SELECT raw_id, line_number FROM raw_jobs",
    "raw_jobs": "SELECT * EXCLUDE (line_number) FROM raw_jobs",
    "raw_rejected": """SELECT rejected_id, line_number, fields_found, fields_expected, raw_content, ingested_at
                       FROM raw_jobs_rejected""",
    "reject_preview": """SELECT line_number, fields_expected, left(raw_content, 120) AS content
                         FROM raw_jobs_rejected ORDER BY bucket, line_number LIMIT 20""",
    "parse_skill_list": """
        SELECT job_id AS raw_id, CAST(r - 1 + CASE job_id % 8 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 6 THEN 2 ELSE 0 END AS INTEGER) AS pos,
               name AS skill
        FROM vitems WHERE job_id % 8 <> 1
        UNION ALL SELECT raw_id, 0, 'None, x' FROM raw_jobs WHERE raw_id % 8 = 2 AND job_skills <> '<NA>'
        UNION ALL SELECT raw_id, 0, 'joined' FROM raw_jobs WHERE raw_id % 8 = 3 AND job_skills <> '<NA>'
        UNION ALL SELECT raw_id, 0, 'café' FROM raw_jobs WHERE raw_id % 8 = 6 AND job_skills <> '<NA>'
        UNION ALL SELECT raw_id, 1, '(''p'', 1)' FROM raw_jobs WHERE raw_id % 8 = 6 AND job_skills <> '<NA>'""",
    "parse_skill_dict": """
        SELECT job_id AS raw_id,
               CAST(dense_rank() OVER (PARTITION BY job_id ORDER BY first_r) - 1
                    + (job_id % 8 IN (3, 5))::INTEGER AS INTEGER) AS cat_pos,
               ptype AS category,
               CAST(row_number() OVER (PARTITION BY job_id, ptype ORDER BY r) - 1 AS INTEGER) AS skill_pos,
               name AS skill
        FROM vitems WHERE job_id % 8 <> 1
        UNION ALL SELECT raw_id, 0, '7', 0, 'seven' FROM raw_jobs WHERE raw_id % 8 = 3 AND job_skills <> '<NA>'
        UNION ALL SELECT raw_id, 0, '7', 1, '7' FROM raw_jobs WHERE raw_id % 8 = 3 AND job_skills <> '<NA>'
        UNION ALL SELECT raw_id, 0, 'again', 0, 'last' FROM raw_jobs WHERE raw_id % 8 = 5 AND job_skills <> '<NA>'""",
    "lenient_timestamp": """
        SELECT o_orderkey, CAST(CASE
            WHEN layout IN (5, 12, 13) THEN NULL
            WHEN layout IN (6, 10, 21) AND day(o_orderdate) <= 12
                 THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate), 0, 0, 0)
            WHEN layout IN (15, 16, 17, 18, 23, 25) THEN date_trunc('minute', timed)
            WHEN layout IN (22, 26) THEN timed
            WHEN layout IN (27, 28) THEN date_trunc('month', o_orderdate)
            WHEN layout = 29 THEN date_trunc('quarter', o_orderdate)
            ELSE o_orderdate END AS TIMESTAMP) AS parsed
        FROM (SELECT *, o_orderkey % 30 AS layout, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS timed FROM orders)""",
    "lenient_number": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (2, 4) THEN NULL
               ELSE CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) END AS parsed
        FROM orders""",
    "strict_true": "SELECT o_orderkey, (o_orderstatus = 'F' AND o_orderkey % 9 <> 0) AS flag FROM orders",
    "strip_text": "SELECT c_custkey, c_name AS stripped, lower(c_name) AS lowered FROM customer",
    "validation_failures": f"""
        , v AS (
          SELECT k AS row_key,
                 CASE WHEN k % 29 = 0 THEN NULL ELSE {_TITLES12}[(k % 12) + 1] END AS title,
                 CASE WHEN salary_rate = 'year' THEN price - 250000 END AS sy,
                 CASE WHEN salary_rate = 'hour' THEN 5.0 - price / 1000 END AS sh
          FROM postings)
        SELECT 'job_title_short' AS "column", 'isin' AS "check", title AS failure_case, row_key FROM v
          WHERE title IS NOT NULL AND NOT list_contains({_list(schemas.VALID_JOB_TITLES)}, title)
        UNION ALL SELECT 'job_title_short', 'not_nullable', NULL, row_key FROM v WHERE title IS NULL
        UNION ALL SELECT 'salary_year_avg', 'greater_than_or_equal_to(0)', CAST(round(sy, 6) AS VARCHAR), row_key
          FROM v WHERE sy < 0
        UNION ALL SELECT 'salary_hour_avg', 'greater_than_or_equal_to(0)', CAST(round(sh, 6) AS VARCHAR), row_key
          FROM v WHERE sh < 0""",
    "load_counts": f"SELECT tabla, filas, CASE {_LABELS} END AS descripcion FROM ({_COUNTS}) t ORDER BY tabla",
    "load_times": """
        SELECT tabla, min(t) AS primera_carga, max(t) AS ultima_carga, count(*) AS total_filas
        FROM (SELECT ingested_at AS t, 'raw_jobs' AS tabla FROM raw_jobs
              UNION ALL BY NAME SELECT ingested_at AS t, 'raw_jobs_rejected' AS tabla FROM raw_jobs_rejected)
        GROUP BY tabla""",
    "reload_counts": f"""
        SELECT carga, tabla, filas FROM ({_COUNTS}) t, (VALUES ('first'), ('second'), ('rebuilt')) l(carga)
        WHERE carga <> 'rebuilt' OR tabla NOT LIKE 'raw%'""",
    "ads_without_company": "SELECT count(*) AS avisos_sin_empresa FROM fact_jobs WHERE company_id IS NULL",
    "ads_without_location": "SELECT count(*) AS avisos_sin_ubicacion FROM fact_jobs WHERE location_id IS NULL",
    "duplicate_pairs": """
        SELECT CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS pares_duplicados
        FROM (SELECT skill_id, job_id, count(*) AS n FROM bridge_job_skills GROUP BY ALL)""",
    "orphan_skills": """
        SELECT count(*) AS habilidades_huerfanas FROM bridge_job_skills
        WHERE skill_id NOT IN (SELECT skill_id FROM dim_skills)""",
    "key_checks": _key_checks_sql(),
    "key_checks_damaged": DAMAGED + _key_checks_sql("bad_"),
    "duplicate_pairs_damaged": DAMAGED + """
        SELECT count(*) AS pares_duplicados
        FROM (SELECT job_id, skill_id FROM bad_bridge_job_skills GROUP BY job_id, skill_id HAVING count(*) > 1)""",
    "orphan_skills_damaged": DAMAGED + """
        SELECT count(*) AS habilidades_huerfanas FROM bad_bridge_job_skills b
        WHERE NOT EXISTS (SELECT 1 FROM bad_dim_skills s WHERE s.skill_id = b.skill_id)""",
    "column_profile": _profile_sql(),
    "ads_by_category": """
        SELECT s.skill_category AS categoria, count(DISTINCT b.job_id) AS avisos_distintos,
               count(DISTINCT b.skill_id) AS habilidades_usadas, count(b.job_id) AS veces_mencionada
        FROM bridge_job_skills b JOIN dim_skills s ON s.skill_id = b.skill_id
        GROUP BY s.skill_category ORDER BY avisos_distintos DESC, categoria""",
    "empty_input": """
        SELECT 'raw_jobs' AS tabla, 0 AS filas, 'no valid rows' AS resultado
        UNION ALL SELECT 'raw_jobs_rejected', count(*), 'no valid rows' FROM postings""",
    "skills_per_ad": """
        SELECT min(n) AS minimo_habilidades, max(n) AS maximo_habilidades,
               CAST(((sum(n) * 20 + count(*)) // (2 * count(*))) AS DOUBLE) / 10 AS promedio_habilidades,
               count(*) AS avisos_con_habilidades, CAST(sum(n) AS BIGINT) AS total_filas_en_bridge
        FROM (SELECT job_id, count(*) AS n FROM bridge_job_skills GROUP BY job_id) t""",
    "top_skills": f"""
        SELECT s.skill_name AS habilidad, s.skill_category AS categoria, count(bs.job_id) AS avisos_que_la_piden,
               {_pct('count(bs.job_id)', '(SELECT count(*) FROM fact_jobs)')} AS porcentaje_avisos
        FROM bridge_job_skills bs JOIN dim_skills s ON bs.skill_id = s.skill_id
        GROUP BY s.skill_id, s.skill_name, s.skill_category
        ORDER BY avisos_que_la_piden DESC, habilidad LIMIT 15""",
    "salary_by_title": f"""
        SELECT job_title_short AS titulo_puesto, count(*) AS total_avisos,
               count(salary_year_avg) AS avisos_con_salario,
               {_money('avg(salary_year_avg)')} AS salario_promedio_anual,
               {_money('min(salary_year_avg)')} AS salario_minimo,
               {_money('max(salary_year_avg)')} AS salario_maximo
        FROM fact_jobs WHERE salary_year_avg IS NOT NULL
        GROUP BY job_title_short ORDER BY avg(salary_year_avg) DESC NULLS FIRST, job_title_short""",
    "ads_by_title": f"""
        SELECT job_title_short AS tipo_puesto, count(*) AS cantidad_avisos,
               {_pct('count(*)', 'sum(count(*)) OVER ()')} AS porcentaje
        FROM fact_jobs GROUP BY job_title_short ORDER BY cantidad_avisos DESC, tipo_puesto""",
    "remote_by_country": """
        SELECT pais, CAST(sum(home) AS BIGINT) AS remotos, CAST(count(*) - sum(home) AS BIGINT) AS presenciales,
               count(*) AS total
        FROM (SELECT CAST(work_from_home AS INTEGER) AS home,
                     (SELECT country FROM dim_locations p WHERE p.location_id = fact_jobs.location_id) AS pais
              FROM fact_jobs WHERE location_id IS NOT NULL)
        GROUP BY pais ORDER BY total DESC, pais NULLS FIRST LIMIT 10""",
    "top_companies": f"""
        SELECT c.company_name AS empresa, count(fj.job_id) AS avisos_publicados,
               {_money('avg(fj.salary_year_avg)')} AS salario_promedio
        FROM fact_jobs fj JOIN dim_companies c ON fj.company_id = c.company_id
        GROUP BY c.company_id, c.company_name ORDER BY avisos_publicados DESC, empresa LIMIT 10""",
    "skills_by_category": f"""
        SELECT s.skill_category AS categoria, count(DISTINCT s.skill_id) AS habilidades_distintas,
               count(bs.job_id) AS veces_mencionada,
               {_pct('count(bs.job_id)', '(SELECT count(*) FROM bridge_job_skills)')} AS porcentaje
        FROM dim_skills s LEFT JOIN bridge_job_skills bs ON s.skill_id = bs.skill_id
        GROUP BY s.skill_category ORDER BY veces_mencionada DESC, categoria""",
    "reject_count": "SELECT count(*) AS filas_con_problemas FROM raw_jobs_rejected",
    "reject_sample": """
        SELECT line_number AS numero_linea_csv, fields_expected AS columnas_esperadas,
               left(raw_content, 200) AS contenido_de_la_fila, ingested_at AS hora_de_carga_colombia
        FROM raw_jobs_rejected ORDER BY bucket, line_number LIMIT 50""",
    "valid_share": f"""
        SELECT v AS filas_validas, r AS filas_con_problemas, {_pct('v', '(v + r)', 2)} AS porcentaje_calidad
        FROM (SELECT (SELECT count(*) FROM raw_jobs) AS v, (SELECT count(*) FROM raw_jobs_rejected) AS r)""",
    "ads_for_skill": f"""
        SELECT count(*) AS "count" FROM bridge_job_skills bs JOIN dim_skills s ON bs.skill_id = s.skill_id
        WHERE s.skill_name = '{SKILL_OF_INTEREST}'""",
    "salary_by_skill": """
        SELECT s.skill_name,
               CAST(round(CAST(avg(f.salary_year_avg) AS DECIMAL(38,10)), 2) AS DOUBLE) AS salario_promedio
        FROM fact_jobs f JOIN bridge_job_skills b ON f.job_id = b.job_id JOIN dim_skills s ON b.skill_id = s.skill_id
        WHERE f.salary_year_avg IS NOT NULL GROUP BY s.skill_name ORDER BY avg(f.salary_year_avg) DESC, s.skill_name""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(isodow(d) AS INTEGER) AS iso_day_of_week
        FROM (SELECT unnest(generate_series(CAST(min(posted_date) AS DATE), CAST(max(posted_date) AS DATE),
                                            INTERVAL 1 DAY)) AS d FROM fact_jobs)""",
    "dim_flags": """
        SELECT CAST(w * 4 + d * 2 + h + 1 AS INTEGER) AS flag_id, w = 1 AS work_from_home,
               d = 1 AS no_degree_mention, h = 1 AS health_insurance,
               (SELECT count(*) FROM fact_jobs f WHERE f.work_from_home = (w = 1) AND f.no_degree_mention = (d = 1)
                AND f.health_insurance = (h = 1)) AS avisos
        FROM range(2) a(w), range(2) b(d), range(2) c(h)""",
    "fact_analytic": """
        SELECT job_id, CAST(strftime(posted_date, '%Y%m%d') AS INTEGER) AS date_id,
               CAST(CAST(work_from_home AS INTEGER) * 4 + CAST(no_degree_mention AS INTEGER) * 2
                 + CAST(health_insurance AS INTEGER) + 1 AS INTEGER) AS flag_id,
               company_id, location_id, salary_year_avg, salary_hour_avg, 1 AS job_count
        FROM fact_jobs""",
}


def oracle_sql() -> dict:
    return {k: BASE + tail for k, tail in ORACLE_TAILS.items()}

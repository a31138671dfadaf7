"""Reports (R1-R13) and the analytic model (M1-M3) on the sample postings, with
expectations worked out by hand."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starforge.operators import checks
from starforge.operators.star import build_dim_date, build_dim_flags, build_fact_analytic, build_star, skill_categories
from starforge.plans import reports
from starforge.session import conf_override


@pytest.fixture(scope="module")
def tables(spark, sample_df):
    star = build_star(sample_df)
    t = {**star.tables()}
    t["raw_jobs"] = sample_df.withColumn("raw_id", F.col("_row")).withColumn(
        "ingested_at", F.lit("2024-01-01 08:00:00").cast("timestamp_ntz"))
    t["raw_jobs_rejected"] = spark.createDataFrame(
        [(1, "f", 7, None, 17, '"a,b"', dt.datetime(2024, 1, 1, 8))],
        "rejected_id long, source_file string, line_number long, fields_found int, fields_expected int, "
        "raw_content string, ingested_at timestamp_ntz")
    return t


def test_skills_per_ad(tables):
    r = reports.skills_per_ad(tables).first()
    assert (r.minimo_habilidades, r.maximo_habilidades, r.promedio_habilidades,
            r.avisos_con_habilidades, r.total_filas_en_bridge) == (1, 3, 2.0, 3, 6)


def test_salary_by_title(tables):
    rows = [tuple(r) for r in reports.salary_by_title(tables).collect()]
    assert rows == [("Cloud Engineer", 2, 2, "$49,500", "$47,000", "$52,000")]


def test_ads_by_title(tables):
    rows = [tuple(r) for r in reports.ads_by_title(tables).collect()]
    assert rows == [("Cloud Engineer", 2, "50.0%"), ("Software Engineer", 2, "50.0%")]


def test_remote_by_country(tables):
    assert [tuple(r) for r in reports.remote_by_country(tables).collect()] == [
        ("Estonia", 1, 1, 2), ("Portugal", 0, 2, 2)]


def test_top_companies(tables):
    rows = [tuple(r) for r in reports.top_companies(tables).collect()]
    assert rows == [("Jarv OU", 2, "$52,000"), ("Aveiro SA", 1, "$47,000"), ("Cais Lda", 1, None)]


def test_skills_by_category(tables):
    rows = {r.categoria: (r.habilidades_distintas, r.veces_mencionada, r.porcentaje)
            for r in reports.skills_by_category(tables).collect()}
    assert rows == {"infra": (2, 3, "50.0%"), "languages": (1, 2, "33.3%"), "systems": (1, 1, "16.7%")}


def test_rejects_and_share(tables):
    assert reports.reject_count(tables).first().filas_con_problemas == 1
    r = reports.reject_sample(tables).first()
    assert (r.numero_linea_csv, r.columnas_esperadas, r.contenido_de_la_fila) == (7, 17, '"a,b"')
    v = reports.valid_share(tables).first()
    assert (v.filas_validas, v.filas_con_problemas, v.porcentaje_calidad) == (4, 1, "80.00%")


def test_load_times_and_checks(tables):
    rows = {r.tabla: (r.total_filas, r.primera_carga) for r in reports.load_times(tables).collect()}
    assert rows["raw_jobs"] == (4, dt.datetime(2024, 1, 1, 8)) and rows["raw_jobs_rejected"][0] == 1
    assert checks.ads_without_company(tables).first()[0] == 0
    assert checks.ads_without_location(tables).first()[0] == 0
    assert checks.duplicate_pairs(tables).first()[0] == 0
    assert checks.orphan_skills(tables).first()[0] == 0


def test_salary_by_skill(tables):
    rows = {r.skill_name: r.salario_promedio for r in reports.salary_by_skill(tables).collect()}
    assert rows == {"go": 52000.4, "terraform": 49500.2}
    assert [r.skill_name for r in reports.salary_by_skill(tables).collect()] == ["go", "terraform"]


def test_order_is_by_the_unrounded_mean(spark, tables):
    fact = spark.createDataFrame([(1, 10.001), (2, 10.004)], "job_id long, salary_year_avg double")
    bridge = spark.createDataFrame([(1, 1), (2, 2)], "job_id long, skill_id long")
    skills = spark.createDataFrame([(1, "a"), (2, "b")], "skill_id long, skill_name string")
    got = reports.salary_by_skill({"fact_jobs": fact, "bridge_job_skills": bridge, "dim_skills": skills}).collect()
    assert [tuple(r) for r in got] == [("b", 10.0), ("a", 10.0)]


def test_analytic_model(tables):
    fact = tables["fact_jobs"]
    dd = build_dim_date(fact)
    assert dd.count() == 69
    first = dd.orderBy("date_id").first()
    assert (first.date_id, first.year, first.quarter, first.iso_day_of_week) == (20240228, 2024, 1, 3)
    flags = {r.flag_id: (r.work_from_home, r.no_degree_mention, r.health_insurance)
             for r in build_dim_flags(fact).collect()}
    assert flags == {1 + 4 * w + 2 * d + h: (w, d, h) for w in (False, True) for d in (False, True)
                     for h in (False, True)}
    fa = {r.job_id: (r.date_id, r.flag_id, r.job_count) for r in build_fact_analytic(fact).collect()}
    assert fa == {1: (20240228, 5, 1), 2: (20240506, 1, 1), 3: (20240301, 2, 1), 4: (20240301, 1, 1)}


def test_load_counts_labels(tables):
    from starforge import schemas
    rows = {r.tabla: (r.filas, r.descripcion) for r in reports.load_counts(tables).collect()}
    labels = dict(schemas.TABLE_LABELS)
    assert rows["fact_jobs"] == (4, labels["fact_jobs"]) and rows["bridge_job_skills"] == (6, labels["bridge_job_skills"])
    assert rows["raw_jobs_rejected"] == (1, labels["raw_jobs_rejected"]) and len(rows) == 7


def below(node, path=()):
    """(names of the operators passed on the way, scan) of every scan under a plan node."""
    children = node.children()
    if not children.size():
        yield path, node
    for i in range(children.size()):
        child = children.apply(i)
        yield from below(child, (*path, child.nodeName()))


def exchanges(node):
    if node.nodeName() == "Exchange":
        yield node
    for i in range(node.children().size()):
        yield from exchanges(node.children().apply(i))


DIMENSION_COLUMNS = {"skill_name", "skill_category", "company_name", "raw_location", "city", "country"}


def test_big_tables_are_aggregated_before_they_meet_a_dimension(spark, tables, tmp_path):
    """Without broadcasts no report shuffles unaggregated fact or bridge rows by a dimension id.

    A scan is one of a dimension if it reads a column that only dimensions have.
    """
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        for report in (reports.top_skills, reports.remote_by_country, reports.top_companies,
                       reports.skills_by_category, reports.salary_by_skill):
            seen = {True: 0, False: 0}
            for exchange in exchanges(report(t)._jdf.queryExecution().executedPlan()):
                if not re.match(r"hashpartitioning\((skill|company|location)_id#", exchange.outputPartitioning().toString()):
                    continue
                for path, scan in below(exchange):
                    dimension = bool(DIMENSION_COLUMNS & set(scan.schema().fieldNames()))
                    seen[dimension] += 1
                    assert dimension or "HashAggregate" in path, (report.__name__, path)
            assert all(seen.values()), report.__name__


def test_categories_are_hash_aggregated(spark, sample_df):
    plan = skill_categories(sample_df)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_min("):]
    assert "SortAggregate" not in below


def test_damage_is_found_by_every_check(spark, tables):
    """Each kind of damage, by hand, on a star of a few rows."""
    t = dict(tables)
    t["dim_companies"] = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, None)], "company_id long, company_name string")
    t["dim_locations"] = spark.createDataFrame([(1, "x", "p"), (2, "x", "p"), (3, "x", None), (4, "x", None), (None, "y", "p")],
                                               "location_id long, raw_location string, country string")
    t["dim_skills"] = spark.createDataFrame([(1, "go"), (None, "go"), (None, None)], "skill_id long, skill_name string")
    t["fact_jobs"] = spark.createDataFrame([(1, 9, 1), (1, None, 8), (None, 1, 7)], "job_id long, company_id long, location_id long")
    t["bridge_job_skills"] = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 5)], "job_id long, skill_id long")
    t["raw_jobs_rejected"] = spark.createDataFrame([(1, None), (2, 5)], "rejected_id long, line_number long")
    got = {r["check"]: r["violations"] for r in checks.key_checks(t).collect() if r["violations"]}
    assert got == {"pk_unique:dim_companies": 1, "unique:dim_companies.company_name": 1, "not_null:dim_companies.company_name": 1,
                   "pk_not_null:dim_locations": 1, "unique:dim_locations.raw_location_country": 1, "pk_not_null:dim_skills": 2,
                   "unique:dim_skills.skill_name": 1, "not_null:dim_skills.skill_name": 1, "pk_unique:fact_jobs": 1,
                   "pk_not_null:fact_jobs": 1, "fk:fact_jobs.company_id": 1, "fk:fact_jobs.location_id": 2,
                   "pk_unique:bridge_job_skills": 1, "pk_not_null:bridge_job_skills": 1, "fk:bridge_job_skills.job_id": 1,
                   "fk:bridge_job_skills.skill_id": 1, "not_null:raw_jobs_rejected.line_number": 1}
    assert checks.duplicate_pairs(t).first()[0] == 1 and checks.orphan_skills(t).first()[0] == 1


def test_registered_damage_leaves_no_check_at_zero(spark):
    from starforge.plans.registry import queries
    rows = queries()["key_checks_damaged"](spark, "/root/testdata/sf0.01").collect()
    clean = [r["check"] for r in rows if not r["violations"]]
    # ids of these tables are damaged by nothing but repeated or missing rows, not by both
    assert sorted(clean) == ["pk_not_null:dim_companies", "pk_not_null:dim_locations", "pk_not_null:raw_jobs_rejected", "pk_unique:dim_skills"]


def test_distinct_counts(spark):
    """Postings that mention several skills of a category count once; a skill nobody mentions is not used."""
    t = {"dim_skills": spark.createDataFrame([(1, "go", "x"), (2, "c", "x"), (3, "nats", "y"), (4, "sql", "y")],
                                             "skill_id long, skill_name string, skill_category string"),
         "bridge_job_skills": spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 3), (3, 2)], "job_id long, skill_id long")}
    rows = [tuple(r) for r in reports.ads_by_category(t).collect()]
    assert rows == [("x", 3, 2, 4), ("y", 1, 1, 1)]
    assert [tuple(r)[:3] for r in reports.skills_by_category(t).collect()] == [("x", 2, 4), ("y", 2, 1)]


def test_a_hot_category_is_aggregated_before_it_is_shuffled(spark, tables):
    """Bridge rows are shuffled by (category, posting) after a partial sum, never by the category alone."""
    with conf_override(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = reports.ads_by_category(tables)._jdf.queryExecution().executedPlan()
    keys = []
    for exchange in exchanges(plan):
        partitioning = exchange.outputPartitioning().toString()
        if partitioning.startswith("hashpartitioning(categoria"):
            keys.append("job_id" in partitioning)
            assert exchange.children().apply(0).nodeName().startswith(("HashAggregate", "WholeStageCodegen")), partitioning
    assert True in keys and False in keys


def test_flag_counts(tables):
    rows = {r["flag_id"]: r["avisos"] for r in reports.flag_counts(tables).collect()}
    assert len(rows) == 8 and sum(rows.values()) == 4 and rows[1] == 2 and rows[8] == 0


def test_column_profile(spark, tables):
    from starforge import schemas
    t = {name: spark.createDataFrame([], schemas.TABLE_SCHEMAS[name]) for name in schemas.TABLE_SCHEMAS}
    t["dim_skills"] = spark.createDataFrame([(1, "a", None), (2, None, "c")], "skill_id long, skill_name string, skill_category string")
    rows = {(r["tabla"], r["columna"]): (r["posicion"], r["tipo"], r["filas"], r["nulos"], r["viola_not_null"])
            for r in reports.column_profile(t).collect()}
    assert rows["dim_skills", "skill_name"] == (2, "string", 2, 1, True)
    assert rows["dim_skills", "skill_category"] == (3, "string", 2, 1, False)
    assert rows["fact_jobs", "posted_date"][1:3] == ("timestamp_ntz", 0)
    assert len(rows) == sum(len(s.fields) for s in schemas.TABLE_SCHEMAS.values())

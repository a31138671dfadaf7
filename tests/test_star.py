"""Star schema builders (B2-B7), keys (K1-K4), checks, reports and the load (L*)."""
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starforge.operators import checks, joins
from starforge.operators.keys import dense_key
from starforge.operators.quality import EmptyInputError, require_rows
from starforge.operators.star import (
    build_bridge_job_skills, build_dim_companies, build_dim_locations, build_dim_skills, build_fact_jobs,
    build_star, with_job_id,
)
from starforge.plans import reports
from starforge.session import conf_override
from starforge.sources.store import read_tables, save_tables
from tests.conftest import POSTINGS, make_typed, posting


def _row(title, location, country, company, skills, types):
    return posting(job_title_short=title, job_location=location, job_country=country, company_name=company,
                   job_skills=skills, job_type_skills=types)


class TestDimCompanies:
    def test_dedup_and_ids(self, sample_df):
        d = {r.company_name: r.company_id for r in build_dim_companies(sample_df).collect()}
        assert d == {"Aveiro SA": 1, "Cais Lda": 2, "Jarv OU": 3}

    def test_null_names_dropped(self, spark):
        rows = [_row("Data Analyst", "a, b", "c", None, "[]", "{}"), _row("Data Analyst", "a, b", "c", "Z", "[]", "{}")]
        assert [r.company_name for r in build_dim_companies(make_typed(spark, rows)).collect()] == ["Z"]


    def test_empty_frame_gives_empty_dimension(self, sample_df):
        dim = build_dim_companies(sample_df.limit(0))
        assert dim.count() == 0 and dim.columns == ["company_id", "company_name"]


class TestDimLocations:
    def test_two_locations_and_city(self, sample_df):
        d = {r.raw_location: (r.location_id, r.city) for r in build_dim_locations(sample_df).collect()}
        assert d == {"Tartu, Estonia": (1, "Tartu"), "Porto, Norte": (2, "Porto")}

    def test_one_location_two_countries_last_id_wins(self, spark):
        rows = [_row("Data Analyst", "Paris, X", "France", "A", "[]", "{}"),
                _row("Data Analyst", "Paris, X", "USA", "A", "[]", "{}"),
                _row("Data Analyst", "Paris, X", "France", "A", "[]", "{}")]
        df = make_typed(spark, rows)
        dl = build_dim_locations(df)
        assert dl.count() == 2
        fact = build_fact_jobs(with_job_id(df), build_dim_companies(df), dl)
        assert {r.location_id for r in fact.collect()} == {2}


class TestDimSkills:
    def test_skills_with_categories(self, sample_df):
        d = {r.skill_name: r.skill_category for r in build_dim_skills(sample_df).collect()}
        assert d == {"go": "languages", "terraform": "infra", "rust": "systems", "nats": "infra"}

    def test_ids_in_name_order(self, sample_df):
        rows = build_dim_skills(sample_df).orderBy("skill_id").collect()
        assert [r.skill_name for r in rows] == sorted(r.skill_name for r in rows)
        assert [r.skill_id for r in rows] == [1, 2, 3, 4]

    def test_first_category_wins_and_other_and_case(self, spark):
        rows = [_row("Data Analyst", "a", "c", "A", "['Python', 'python', ' Go ', 'Rust']",
                     "{'lang': ['python'], 'x': ['Python', 'go']}"),
                _row("Data Analyst", "a", "c", "A", "['Python']", "{'other_cat': ['Python']}")]
        d = {r.skill_name: r.skill_category for r in build_dim_skills(make_typed(spark, rows)).collect()}
        assert d == {"Python": "lang", "python": "lang", "Go": "x", "Rust": "other"}

    def test_no_skills(self, spark):
        rows = [_row("Data Analyst", "a", "c", "A", "[]", "{}")] * 3
        assert build_dim_skills(make_typed(spark, rows)).count() == 0


class TestFactJobs:
    def test_rows_keys_columns(self, sample_df):
        fact = build_fact_jobs(with_job_id(sample_df), build_dim_companies(sample_df), build_dim_locations(sample_df))
        rows = fact.orderBy("job_id").collect()
        assert [r.job_id for r in rows] == [1, 2, 3, 4] and [r._csv_row for r in rows] == [0, 1, 2, 3]
        assert [r.company_id for r in rows] == [3, 2, 1, 3]
        assert [r.location_id for r in rows] == [1, 2, 2, 1]
        assert "schedule_type" in fact.columns and "job_schedule_type" not in fact.columns
        assert "job_skills" not in fact.columns and "job_skills_parsed" not in fact.columns

    def test_null_company_gives_null_id(self, spark):
        df = make_typed(spark, [posting(company_name=None), posting()])
        fact = build_fact_jobs(with_job_id(df), build_dim_companies(df), build_dim_locations(df))
        assert fact.where("job_id = 1").first().company_id is None

    def test_shuffle_join_gives_the_same_rows(self, spark, monkeypatch):
        wide = "x" * 5000
        rows = [posting(company_name=f"{wide}{i % 7}" if i % 3 else None, job_location="P" if i % 2 else None,
                        job_country=None if i % 5 else "F") for i in range(60)]
        df = make_typed(spark, rows)
        companies, locations = build_dim_companies(df), build_dim_locations(df)
        for match in (False, True):
            small = build_fact_jobs(with_job_id(df), companies, locations, match_country=match)
            want = sorted(tuple(r) for r in small.select("job_id", "company_id", F.coalesce("location_id", F.lit(0))).collect())
            with monkeypatch.context() as m:
                m.setattr(joins, "BROADCAST_MAX_BYTES", -1)
                with conf_override(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
                    big = build_fact_jobs(with_job_id(df), companies, locations, match_country=match)
                    got = sorted(tuple(r) for r in big.select("job_id", "company_id", F.coalesce("location_id", F.lit(0))).collect())
                    assert big._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") >= 2
            assert [(a, b or 0, c) for a, b, c in got] == [(a, b or 0, c) for a, b, c in want] and len(got) == 60

    def test_match_country_option(self, spark):
        rows = [_row("Data Analyst", "P", "F", "A", "[]", "{}"), _row("Data Analyst", "P", "U", "A", "[]", "{}")]
        df = make_typed(spark, rows)
        fact = build_fact_jobs(with_job_id(df), build_dim_companies(df), build_dim_locations(df), match_country=True)
        assert [r.location_id for r in fact.orderBy("job_id").collect()] == [1, 2]


class TestBridgeJobSkills:
    def test_pairs_of_the_sample(self, sample_df):
        ds = build_dim_skills(sample_df)
        br = build_bridge_job_skills(with_job_id(sample_df), ds)
        assert br.count() == 6 and br.columns == ["job_id", "skill_id"]
        go = ds.where("skill_name = 'go'").first().skill_id
        assert {r.job_id for r in br.where(F.col("skill_id") == go).collect()} == {1, 2}
        assert br.distinct().count() == 6

    def test_duplicates_and_padding_collapse(self, spark):
        rows = [_row("Data Analyst", "a", "c", "A", "['SQL', ' SQL', 'SQL ', None]", "{}")]
        df = make_typed(spark, rows)
        assert build_bridge_job_skills(with_job_id(df), build_dim_skills(df)).count() == 1

    def test_no_skills_empty_bridge_keeps_columns(self, spark):
        rows = [_row("Data Analyst", "a", "c", "A", "[]", "{}")]
        df = make_typed(spark, rows)
        br = build_bridge_job_skills(with_job_id(df), build_dim_skills(df))
        assert br.count() == 0 and br.columns == ["job_id", "skill_id"]


class TestRobustness:
    def test_empty_frame_raises(self, spark, sample_df):
        with pytest.raises(EmptyInputError):
            require_rows(sample_df.limit(0))
        with pytest.raises(EmptyInputError):
            require_rows(None)
        with pytest.raises(EmptyInputError):
            build_star(sample_df.limit(0))

    def test_valid_frame_passes(self, sample_df):
        require_rows(sample_df)


def test_dense_key_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).distinct()
    got = dense_key(df, ["k"], "id", num_partitions=7)
    exp = df.select("k", F.row_number().over(Window.orderBy("k")).alias("id_exp"))
    bad = got.join(exp, "k").where(F.col("id") != F.col("id_exp")).count()
    assert bad == 0 and got.count() == df.count()


def test_save_swap_reports_and_checks(spark, sample_df, tmp_path):
    star = build_star(sample_df)
    raw = sample_df.withColumn("raw_id", F.col("_row")).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    rej = spark.createDataFrame([], "rejected_id long, source_file string, line_number long, fields_found int, "
                                    "fields_expected int, raw_content string, ingested_at timestamp_ntz")
    tables = {**star.tables(), "raw_jobs": raw, "raw_jobs_rejected": rej}
    out = str(tmp_path / "wh")
    counts = save_tables(spark, tables, out)
    assert counts["bridge_job_skills"] == 6 and counts["raw_jobs_rejected"] == 0
    counts = save_tables(spark, tables, out)     # replace-all: same result twice
    t = read_tables(spark, out)
    assert {r.check: r.violations for r in checks.key_checks(t).collect()} == {
        r.check: 0 for r in checks.key_checks(t).collect()}
    lc = {r.tabla: r.filas for r in reports.load_counts(t).collect()}
    assert lc["fact_jobs"] == 4 and lc["dim_skills"] == 4
    top = reports.top_skills(t).collect()
    assert (top[0].habilidad, top[0].avisos_que_la_piden, top[0].porcentaje_avisos) == ("go", 2, "50.0%")
    vs = reports.valid_share(t).first()
    assert vs.porcentaje_calidad == "100.00%"
    assert reports.ads_for_skill(t, "terraform").first()["count"] == 2


def test_key_checks_find_violations(spark, sample_df, tmp_path):
    star = build_star(sample_df)
    t = {**star.tables()}
    t["raw_jobs"] = spark.createDataFrame([(1,), (1,), (None,)], "raw_id long")
    t["raw_jobs_rejected"] = spark.createDataFrame([(1, None)], "rejected_id long, line_number long")
    t["bridge_job_skills"] = star.bridge_job_skills.unionByName(
        spark.createDataFrame([(99, 1), (1, 999)], "job_id long, skill_id long"))
    got = {r.check: r.violations for r in checks.key_checks(t).collect()}
    assert got["pk_unique:raw_jobs"] == 1 and got["pk_not_null:raw_jobs"] == 1
    assert got["fk:bridge_job_skills.job_id"] == 1 and got["fk:bridge_job_skills.skill_id"] == 1
    assert got["not_null:raw_jobs_rejected.line_number"] == 1
    assert got["pk_unique:fact_jobs"] == 0 and len(got) == 24


def test_exclusive_prefix_sum_matches_python(spark):
    from starforge.operators.keys import exclusive_prefix_sum
    rows = [(f"f{i % 3}", i, (i * 37) % 11, i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "f string, b long, a long, c long")
    got5 = exclusive_prefix_sum(df, ["f", "b"], ["a", "c"], num_partitions=5).collect()
    got1 = exclusive_prefix_sum(df, ["f", "b"], ["a", "c"]).collect()
    got = sorted((r.f, r.b, r._beforea, r._beforec) for r in got5)
    assert sorted((r.f, r.b, r._beforea, r._beforec) for r in got1) == got
    run_a = run_c = 0
    exp = []
    for f, b, a, c in sorted(rows):
        exp.append((f, b, run_a, run_c))
        run_a += a
        run_c += c
    assert got == exp

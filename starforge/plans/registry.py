"""Query registry: every operator of the inventory as a (spark, sf_dir) -> DataFrame query.

The star-schema queries share one model per data folder and Spark app: the
postings sample is derived from the driver tables, written as CSV text to the
shared scratch folder, ingested, and the seven tables written (``run``);
queries then read those written tables.  The load stamp is fixed so that
results are reproducible.
"""
from __future__ import annotations

import os
import threading
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge import schemas
from starforge.functions.text import (
    lenient_number, lenient_timestamp, py_strip, strict_true, with_literals,
)
from starforge.operators import checks
from starforge.operators.ingest import reject_preview as _reject_preview
from starforge.operators.ingest import typed_from_raw
from starforge.operators.quality import EmptyInputError, failures_of
from starforge.operators.star import build_dim_date, build_fact_analytic, build_fact_jobs, location_lookup, with_job_id
from starforge.plans import reports
from starforge.plans.damage import damaged
from starforge.plans.run import run
from starforge.session import scratch_path
from starforge.sources.postings import postings, write_postings_csv
from starforge.sources.store import published, read_tables

# FIXED VALUES of the registry runs.
LOAD_STAMP = "2024-01-01 08:00:00"   # ingested_at of the registry loads
SKILL_OF_INTEREST = "blue bolt"      # R12 parameter (a part name present at every scale)
EXTRA_TITLES = ["Data Janitor", "Chief Data Wrangler"]  # invalid titles for the validation query


@dataclass
class Model:
    root: str
    csv_path: str
    counts: dict
    tables: dict


_MODELS: dict = {}
_LOCK = threading.Lock()


def model(spark: SparkSession, sf_dir: str) -> Model:
    """The loaded tables for ``sf_dir`` (built once per Spark application)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LOCK:
        if key not in _MODELS:
            root = scratch_path(spark, "model")
            csv_path = write_postings_csv(postings(spark, sf_dir), f"{root}/csv")
            counts = run(spark, csv_path, f"{root}/tables", now=LOAD_STAMP)
            _MODELS[key] = Model(root, csv_path, counts, read_tables(spark, f"{root}/tables"))
        return _MODELS[key]


def _t(spark, sf_dir) -> dict:
    return model(spark, sf_dir).tables


def _orders(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


# ---- star tables ---------------------------------------------------------------

def q_dim_companies(spark, sf_dir):
    return _t(spark, sf_dir)["dim_companies"]


def q_dim_locations(spark, sf_dir):
    return _t(spark, sf_dir)["dim_locations"]


def q_dim_skills(spark, sf_dir):
    return _t(spark, sf_dir)["dim_skills"]


def q_fact_jobs(spark, sf_dir):
    return _t(spark, sf_dir)["fact_jobs"]


def q_bridge_job_skills(spark, sf_dir):
    return _t(spark, sf_dir)["bridge_job_skills"]


def q_location_lookup(spark, sf_dir):
    return location_lookup(_t(spark, sf_dir)["dim_locations"])


def q_null_key_counts(spark, sf_dir):
    return checks.null_key_counts(_t(spark, sf_dir)["fact_jobs"])


def q_fact_jobs_by_country(spark, sf_dir):
    t = _t(spark, sf_dir)
    jobs = with_job_id(typed_from_raw(t["raw_jobs"]))
    fact = build_fact_jobs(jobs, t["dim_companies"], t["dim_locations"], match_country=True)
    return fact.select("job_id", "location_id")


# ---- ingest --------------------------------------------------------------------

def q_line_numbers(spark, sf_dir):
    return _t(spark, sf_dir)["raw_jobs"].select("raw_id", "line_number")


def q_raw_jobs(spark, sf_dir):
    raw = _t(spark, sf_dir)["raw_jobs"]
    return raw.select("raw_id", *schemas.CSV_COLUMNS, "ingested_at")


def q_raw_rejected(spark, sf_dir):
    r = _t(spark, sf_dir)["raw_jobs_rejected"]
    return r.select("rejected_id", "line_number", "fields_found", "fields_expected", "raw_content", "ingested_at")


def q_reject_preview(spark, sf_dir):
    return _reject_preview(_t(spark, sf_dir)["raw_jobs_rejected"])


def q_parse_skill_list(spark, sf_dir):
    """Lists as loaded, and by row: text after the end (no list), a quoted ``None`` in front, joined strings, a
    comment at the end, escapes and a nested tuple in front."""
    raw, k, t = _t(spark, sf_dir)["raw_jobs"], F.col("raw_id"), F.col("job_skills")
    rest = F.substring(t, F.lit(2), F.length(t))
    text = (F.when(k % 8 == 1, F.concat(t, F.lit("]")))
             .when(k % 8 == 2, F.concat(F.lit("['None, x', "), rest))
             .when(k % 8 == 3, F.concat(F.lit("['jo' \"ined\", "), rest))
             .when(k % 8 == 5, F.concat(t, F.lit("  # a comment")))
             .when(k % 8 == 6, F.concat(F.lit("['caf\\xe9', ('p', 1), "), rest)).otherwise(t))
    lists = with_literals(raw.select("raw_id", text.alias("text")), lists={"skills": "text"})
    return lists.select("raw_id", F.posexplode("skills").alias("pos", "skill"))


def q_parse_skill_dict(spark, sf_dir):
    """Dictionaries as loaded, and by row: text after the end (no dictionary), values that are no lists in front, a key
    that is no string in front, a key repeated at the end."""
    raw, k, t = _t(spark, sf_dir)["raw_jobs"], F.col("raw_id"), F.col("job_type_skills")
    rest = F.substring(t, F.lit(2), F.length(t))
    text = (F.when(k % 8 == 1, F.concat(t, F.lit(" junk")))
             .when(k % 8 == 2, F.concat(F.lit("{'n': 5, 'm': None, 'd': {'a': ['b']}, 't': ('x',), "), rest))
             .when(k % 8 == 3, F.concat(F.lit("{7: ['seven', 7], "), rest))
             .when(k % 8 == 5, F.concat(F.lit("{'again': ['first'], "), F.left(rest, F.length(rest) - 1),
                                        F.when(F.length(rest) > 1, ", ").otherwise(""), F.lit("'again': ['last']}")))
             .otherwise(t))
    g = with_literals(raw.select("raw_id", text.alias("text")), groups={"groups": "text"})
    g = g.select("raw_id", F.posexplode("groups").alias("cat_pos", "grp"))
    return g.select("raw_id", "cat_pos", F.col("grp.category").alias("category"),
                    F.posexplode("grp.skills").alias("skill_pos", "skill"))


# ---- scalar functions on text derived from the orders table --------------------

# Layouts of the date texts; the SQL beside them repeats what each is read as.
DATE_LAYOUTS = [
    "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm:ss", "MMM d yyyy", "M/d/yyyy h:mm:ss a", "yyyy-MM-dd", "yyyy-'13-01'", "d/M/yyyy", "M/d/yy",
    "MMM d, yyyy H:mm", "yyyyMMdd", "dd-MM-yyyy", "MM-dd-yyyy", "HH:mm", "'1'yyyy"]
# These are written with a time of day.
TIMED_LAYOUTS = [
    "MMMM d, yyyy", "M/d/yy H:mm", "M-d-yyyy H:mm", "d MMM yyyy H:mm", "yyyy/MM/dd HH:mm", "' 'M/d/yyyy' '", "yyyy.MM.dd", "dd.MM.yyyy",
    "yyyyMMdd'T'HHmmss", "EEEE, MMMM d, yyyy 'at' h:mm a", "d'th of' MMMM yyyy", "H:mm d-MMM-yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy MMM",
    "M/yyyy", "yyyy'Q'q"]


def q_lenient_timestamp(spark, sf_dir):
    o = _orders(spark, sf_dir)
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    timed = d + F.make_interval(secs=k * 37 % 86400)
    n = len(DATE_LAYOUTS) + len(TIMED_LAYOUTS)
    text = F.lit(None).cast("string")
    for i, layout in enumerate(DATE_LAYOUTS + TIMED_LAYOUTS):
        text = F.when(k % n == i, F.date_format(d if i < len(DATE_LAYOUTS) else timed, layout)).otherwise(text)
    return o.select("o_orderkey", lenient_timestamp(text).alias("parsed"))


def q_lenient_number(spark, sf_dir):
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey")
    plain = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = (F.when(k % 5 == 0, plain).when(k % 5 == 1, F.concat(F.lit(" "), plain, F.lit(" ")))
             .when(k % 5 == 2, F.concat(plain, F.lit("d"))).when(k % 5 == 3, F.concat(plain, F.lit("e0")))
             .otherwise(F.lit("nan")))
    return o.select("o_orderkey", lenient_number(text).alias("parsed"))


def q_strict_true(spark, sf_dir):
    o = _orders(spark, sf_dir)
    s, k = F.col("o_orderstatus"), F.col("o_orderkey")
    text = (F.when(k % 9 == 0, F.lit(None).cast("string"))
             .when(s == "F", F.lit(" TRUE ")).when(s == "O", F.lit("yes")).otherwise(F.lit("1")))
    return o.select("o_orderkey", strict_true(text).alias("flag"))


def q_strip_text(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    text = F.concat(F.lit("\u00a0\u3000 "), F.col("c_name"), F.lit("\t \u001f"))
    return c.select("c_custkey", py_strip(text).alias("stripped"), F.lower(py_strip(text)).alias("lowered"))


def q_validation_failures(spark, sf_dir):
    p = postings(spark, sf_dir)
    titles = F.array(*[F.lit(t) for t in schemas.VALID_JOB_TITLES + EXTRA_TITLES])
    k = F.col("_row")
    bad = (p.withColumn("job_title_short", F.when(k % 29 == 0, F.lit(None).cast("string"))
                        .otherwise(F.element_at(titles, (k % 12 + 1).cast("int"))))
            .withColumn("salary_year_avg", F.col("salary_year_avg") - 250000)
            .withColumn("salary_hour_avg", F.lit(5.0) - F.col("salary_hour_avg")))
    return failures_of(bad.withColumnRenamed("_row", "row_key"), key="row_key")


# ---- checks and reports --------------------------------------------------------

def _report(fn, **kw):
    return lambda spark, sf_dir: fn(_t(spark, sf_dir), **kw)


def _damaged_report(fn):
    return lambda spark, sf_dir: fn(damaged(_t(spark, sf_dir)))


def q_reload_counts(spark, sf_dir):
    """The counts returned by a second load, of the same text at another path, and by a rebuild of the
    star from its raw table."""
    root = scratch_path(spark, "reload")
    out = f"{root}/tables"
    moved = write_postings_csv(postings(spark, sf_dir), f"{root}/another place/csv")
    loads = [("first", run(spark, model(spark, sf_dir).csv_path, out, now=LOAD_STAMP)),
             ("second", run(spark, moved, out, now=LOAD_STAMP)), ("rebuilt", run(spark, None, out, load_raw=False))]
    return spark.createDataFrame([(load, t, n) for load, counts in loads for t, n in counts.items()],
                                 "carga string, tabla string, filas long")


def q_empty_input(spark, sf_dir):
    """a load whose lines are all cut short raises, builds no star, and publishes the raw tables with its rejects."""
    root = scratch_path(spark, "empty")
    csv_path = write_postings_csv(postings(spark, sf_dir), f"{root}/csv", broken=True)
    try:
        run(spark, csv_path, f"{root}/tables", now=LOAD_STAMP)
        outcome = "loaded"
    except EmptyInputError:
        outcome = "no valid rows"
    paths = published(spark, f"{root}/tables")
    parts = [spark.read.parquet(path).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
             for name, path in paths.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("resultado", F.lit(outcome))


def q_dim_date(spark, sf_dir):
    return build_dim_date(_t(spark, sf_dir)["fact_jobs"])


def q_fact_analytic(spark, sf_dir):
    return build_fact_analytic(_t(spark, sf_dir)["fact_jobs"])


def queries() -> dict:
    return {
        "dim_companies": q_dim_companies,
        "dim_locations": q_dim_locations,
        "dim_skills": q_dim_skills,
        "fact_jobs": q_fact_jobs,
        "fact_jobs_by_country": q_fact_jobs_by_country,
        "bridge_job_skills": q_bridge_job_skills,
        "location_lookup": q_location_lookup,
        "null_key_counts": q_null_key_counts,
        "line_numbers": q_line_numbers,
        "raw_jobs": q_raw_jobs,
        "raw_rejected": q_raw_rejected,
        "reject_preview": q_reject_preview,
        "parse_skill_list": q_parse_skill_list,
        "parse_skill_dict": q_parse_skill_dict,
        "lenient_timestamp": q_lenient_timestamp,
        "lenient_number": q_lenient_number,
        "strict_true": q_strict_true,
        "strip_text": q_strip_text,
        "validation_failures": q_validation_failures,
        "load_counts": _report(reports.load_counts),
        "load_times": _report(reports.load_times),
        "reload_counts": q_reload_counts,
        "ads_without_company": _report(checks.ads_without_company),
        "ads_without_location": _report(checks.ads_without_location),
        "duplicate_pairs": _report(checks.duplicate_pairs),
        "orphan_skills": _report(checks.orphan_skills),
        "key_checks": _report(checks.key_checks),
        "key_checks_damaged": _damaged_report(checks.key_checks),
        "duplicate_pairs_damaged": _damaged_report(checks.duplicate_pairs),
        "orphan_skills_damaged": _damaged_report(checks.orphan_skills),
        "column_profile": _report(reports.column_profile),
        "ads_by_category": _report(reports.ads_by_category),
        "empty_input": q_empty_input,
        "skills_per_ad": _report(reports.skills_per_ad),
        "top_skills": _report(reports.top_skills),
        "salary_by_title": _report(reports.salary_by_title),
        "ads_by_title": _report(reports.ads_by_title),
        "remote_by_country": _report(reports.remote_by_country),
        "top_companies": _report(reports.top_companies),
        "skills_by_category": _report(reports.skills_by_category),
        "reject_count": _report(reports.reject_count),
        "reject_sample": _report(reports.reject_sample),
        "valid_share": _report(reports.valid_share),
        "ads_for_skill": _report(reports.ads_for_skill, skill_name=SKILL_OF_INTEREST),
        "salary_by_skill": _report(reports.salary_by_skill),
        "dim_date": q_dim_date,
        "dim_flags": _report(reports.flag_counts),
        "fact_analytic": q_fact_analytic,
    }

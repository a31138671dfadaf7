"""Star schema builders (B2-B7) and the analytic model (M1-M3).

Input: a typed postings frame with a unique, ordered row key ``_row`` (the
file order; ``raw_id`` after ingest), the typed columns, and the parsed
``job_skills_parsed`` / ``job_type_skills_parsed`` columns.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge import schemas
from starforge.functions.text import city_of, py_strip
from starforge.operators.joins import broadcast_if_small, join_dimension
from starforge.operators.keys import dense_key
from starforge.operators.quality import require_rows


@dataclass
class Star:
    dim_companies: DataFrame
    dim_locations: DataFrame
    dim_skills: DataFrame
    fact_jobs: DataFrame
    bridge_job_skills: DataFrame

    def tables(self) -> dict:
        return {"dim_companies": self.dim_companies, "dim_locations": self.dim_locations,
                "dim_skills": self.dim_skills, "fact_jobs": self.fact_jobs,
                "bridge_job_skills": self.bridge_job_skills}


# ---- dimensions ---------------------------------------------------------------

def build_dim_companies(df: DataFrame) -> DataFrame:
    """B2: distinct non-null names, ids 1..n in name (code point) order."""
    names = df.where(F.col("company_name").isNotNull()).select("company_name").distinct()
    return dense_key(names, ["company_name"], "company_id").select("company_id", "company_name")


def build_dim_locations(df: DataFrame) -> DataFrame:
    """Distinct (location, country) pairs with a location, ids by first appearance."""
    pairs = (df.where(F.col("job_location").isNotNull())
               .groupBy("job_location", "job_country").agg(F.min("_row").alias("_first")))
    keyed = dense_key(pairs, ["_first"], "location_id")
    return keyed.select("location_id", F.col("job_location").alias("raw_location"),
                        city_of("job_location").alias("city"), F.col("job_country").alias("country"))


def skill_occurrences(df: DataFrame) -> DataFrame:
    """One row per (posting, category, skill) with both positions."""
    groups = df.select("_row", F.posexplode("job_type_skills_parsed").alias("cat_pos", "grp"))
    occ = groups.select("_row", "cat_pos", F.col("grp.category").alias("category"),
                        F.posexplode("grp.skills").alias("skill_pos", "skill"))
    # null and empty strings are skipped before stripping
    return occ.where(F.col("skill").isNotNull() & (F.col("skill") != ""))


def skill_categories(df: DataFrame) -> DataFrame:
    """K4: first category seen per lower-cased, stripped skill (row, dict, list order)."""
    occ = skill_occurrences(df)
    # The place of an occurrence as one number: a fixed-width minimum is hash-aggregated, so the
    # occurrences are not sorted; only the few (skill, category) groups meet the second step.
    place = (F.col("_row").cast("decimal(38,0)") * F.lit(10 ** 18).cast("decimal(19,0)")
             + F.col("cat_pos").cast("long") * 10 ** 9 + F.col("skill_pos")).cast("decimal(38,0)")
    first = (occ.groupBy(F.lower(py_strip("skill")).alias("_key"), "category").agg(F.min(place).alias("_place")))
    return first.groupBy("_key").agg(F.min_by("category", "_place").alias("_cat"))


def build_dim_skills(df: DataFrame) -> DataFrame:
    """Distinct stripped skills, category by K4 or 'other', ids in name order."""
    names = (df.select(F.explode("job_skills_parsed").alias("s"))
               .where(F.col("s").isNotNull() & (F.col("s") != ""))
               .select(py_strip("s").alias("skill_name")).distinct())
    cats = skill_categories(df)
    joined = names.join(cats, F.lower("skill_name") == F.col("_key"), "left").select(
        "skill_name", F.coalesce("_cat", F.lit(schemas.DEFAULT_SKILL_CATEGORY)).alias("skill_category"))
    return dense_key(joined, ["skill_name"], "skill_id").select("skill_id", "skill_name", "skill_category")


# ---- fact and bridge -------------------------------------------------------------

def with_job_id(df: DataFrame) -> DataFrame:
    """K3: job_id 1..N in row order (``_row`` is 1..N after ingest)."""
    return df.withColumn("job_id", F.col("_row").cast("long"))


def location_lookup(dim_locations: DataFrame) -> DataFrame:
    """Raw location -> id; with several countries the last (largest) id wins."""
    return dim_locations.groupBy("raw_location").agg(F.max("location_id").alias("location_id"))


def build_fact_jobs(jobs: DataFrame, dim_companies: DataFrame, dim_locations: DataFrame,
                    match_country: bool = False) -> DataFrame:
    """One row per posting (row count always equals the input's)."""
    fact = join_dimension(jobs, dim_companies.select(F.col("company_name").alias("_cn"), "company_id"),
                          {"company_name": "_cn"}, "_row")
    if match_country:
        loc = dim_locations.select(F.col("raw_location").alias("_rl"), F.col("country").alias("_rc"), "location_id")
        fact = join_dimension(fact, loc, {"job_location": "_rl", "job_country": "_rc"}, "_row")
    else:
        loc = location_lookup(dim_locations).withColumnRenamed("raw_location", "_rl")
        fact = join_dimension(fact, loc, {"job_location": "_rl"}, "_row")
    cols = [F.col(src).alias(dst) for src, dst in schemas.FACT_COLUMN_MAP if src in fact.columns]
    return fact.select("job_id", (F.col("job_id") - 1).alias("_csv_row"), *cols)


def build_bridge_job_skills(jobs: DataFrame, dim_skills: DataFrame) -> DataFrame:
    """Distinct (job_id, skill_id) pairs.

    Names are stripped and de-duplicated inside each posting before the
    explode, so distinct names give distinct ids and no shuffle is needed
    for the de-duplication; the skill dimension is broadcast behind a size check.
    """
    names = F.array_distinct(F.transform("job_skills_parsed", lambda s: py_strip(s)))
    exploded = jobs.select("job_id", F.explode(names).alias("skill_name"))
    skills = dim_skills.select("skill_name", "skill_id")
    return exploded.join(broadcast_if_small(skills), "skill_name").select("job_id", "skill_id")


def build_star(df: DataFrame, match_country: bool = False) -> Star:
    """B7 (without the load): the five tables, lazily, from a typed frame."""
    require_rows(df)
    dim_companies = build_dim_companies(df)
    dim_locations = build_dim_locations(df)
    dim_skills = build_dim_skills(df)
    jobs = with_job_id(df)
    fact = build_fact_jobs(jobs, dim_companies, dim_locations, match_country)
    bridge = build_bridge_job_skills(jobs, dim_skills)
    return Star(dim_companies, dim_locations, dim_skills, fact, bridge)


# ---- analytic model (M1-M3) -----------------------------------------------------

def date_key(d) -> F.Column:
    """yyyymmdd integer key of a date/timestamp."""
    d = F.to_date(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def build_dim_date(fact: DataFrame) -> DataFrame:
    """M1: every day from the first to the last posting date, generated in parallel."""
    spark = fact.sparkSession
    bounds = fact.agg(F.min(F.to_date("posted_date")).alias("lo"), F.max(F.to_date("posted_date")).alias("hi"))
    row = bounds.first()
    if row["lo"] is None:
        return spark.createDataFrame([], "date_id int, date date, year int, quarter int, month int, day int, iso_day_of_week int")
    ndays = (row["hi"] - row["lo"]).days + 1
    days = spark.range(0, ndays, numPartitions=max(1, min(ndays // 100_000 + 1, 1000)))
    d = F.date_add(F.lit(row["lo"]), F.col("id").cast("int"))
    return days.select(d.alias("date")).select(
        date_key("date").alias("date_id"), "date", F.year("date").alias("year"),
        F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        ((F.dayofweek("date") + 5) % 7 + 1).alias("iso_day_of_week"))


def flag_key(wfh, no_degree, health) -> F.Column:
    """M2: id 1..8 of the three-flag combination (bits wfh, no_degree, health)."""
    b = lambda c: F.col(c).cast("int") if isinstance(c, str) else c.cast("int")
    return (b(wfh) * 4 + b(no_degree) * 2 + b(health) + 1).cast("int")


def build_dim_flags(fact: DataFrame) -> DataFrame:
    """M2: all eight flag combinations, keyed by their bits."""
    bits = fact.sparkSession.range(8)
    flag = lambda bit: F.col("id").bitwiseAND(bit) != 0
    return bits.select((F.col("id") + 1).cast("int").alias("flag_id"), flag(4).alias("work_from_home"),
                       flag(2).alias("no_degree_mention"), flag(1).alias("health_insurance"))


def build_fact_analytic(fact: DataFrame) -> DataFrame:
    """M3: one row per posting with arithmetic date/flag keys (no join needed)."""
    return fact.select(
        "job_id", date_key("posted_date").alias("date_id"),
        flag_key("work_from_home", "no_degree_mention", "health_insurance").alias("flag_id"),
        "company_id", "location_id", "salary_year_avg", "salary_hour_avg",
        F.lit(1).alias("job_count"))

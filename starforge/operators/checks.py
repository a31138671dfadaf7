"""Integrity checks (G1-G5) and the post-load data checks (R2a-R2d).

Spark does not enforce keys; these queries count violations (all should be 0).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one(df: DataFrame, name: str, value) -> DataFrame:
    return df.agg(value.cast("long").alias("violations")).select(F.lit(name).alias("check"), "violations")




def duplicate_keys(df: DataFrame, keys: list, name: str) -> DataFrame:
    """Key groups occurring more than once (rows with a NULL key part never clash)."""
    nonnull = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    g = nonnull.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _one(g, name, F.count(F.lit(1)))


def null_count(df: DataFrame, cols: list, name: str) -> DataFrame:
    return _one(df, name, F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """Non-null foreign keys without a parent row (left anti join)."""
    c = child.where(F.col(fk).isNotNull()).select(F.col(fk).alias("_k"))
    p = parent.select(F.col(pk).alias("_k"))
    return _one(c.join(p, "_k", "left_anti"), name, F.count(F.lit(1)))


def unique_and_not_null(df: DataFrame, keys: list, unique_name: str, null_name: str | None) -> DataFrame:
    """Duplicate non-null key groups and rows with a NULL key part, in one grouped pass.

    Rows with a NULL key part fall into NULL groups, which count toward the
    null check and never toward duplicates (as in a UNIQUE constraint).
    """
    nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    agg = g.agg(F.count_if(nonnull & (F.col("_n") > 1)).cast("long").alias("_dup"),
                F.coalesce(F.sum(F.when(~nonnull, F.col("_n"))), F.lit(0)).cast("long").alias("_null"))
    items = [F.struct(F.lit(unique_name).alias("check"), F.col("_dup").alias("violations"))]
    if null_name:
        items.append(F.struct(F.lit(null_name).alias("check"), F.col("_null").alias("violations")))
    return agg.select(F.explode(F.array(*items)).alias("r")).select("r.check", "r.violations")


PRIMARY_KEYS = [("raw_jobs", ["raw_id"]), ("raw_jobs_rejected", ["rejected_id"]),
                ("dim_companies", ["company_id"]), ("dim_locations", ["location_id"]),
                ("dim_skills", ["skill_id"]), ("fact_jobs", ["job_id"]),
                ("bridge_job_skills", ["job_id", "skill_id"])]


def primary_key_checks(t: dict, pks=PRIMARY_KEYS) -> DataFrame:
    """G1 for every table in one grouped pass: the (numeric) keys of all tables are
    unioned as (table, k1, k2) rows and grouped once, instead of one shuffle per table."""
    parts = []
    for table, keys in pks:
        k2 = F.col(keys[1]).cast("long") if len(keys) > 1 else F.lit(None).cast("long")
        anynull = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        parts.append(t[table].select(F.lit(table).alias("_t"), F.col(keys[0]).cast("long").alias("_k1"),
                                     k2.alias("_k2"), anynull.alias("_null")))
    groups = (reduce(DataFrame.unionByName, parts)
              .groupBy("_t", "_k1", "_k2", "_null").agg(F.count(F.lit(1)).alias("_n")))
    per = groups.groupBy("_t").agg(
        F.count_if(~F.col("_null") & (F.col("_n") > 1)).cast("long").alias("_dup"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).cast("long").alias("_nulls"))
    # every table gets its two rows, also when it is empty
    names = t[pks[0][0]].sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name, _ in pks])).alias("_t"))
    full = names.join(F.broadcast(per), "_t", "left")
    rows = F.array(
        F.struct(F.concat(F.lit("pk_unique:"), F.col("_t")).alias("check"),
                 F.coalesce(F.col("_dup"), F.lit(0).cast("long")).alias("violations")),
        F.struct(F.concat(F.lit("pk_not_null:"), F.col("_t")).alias("check"),
                 F.coalesce(F.col("_nulls"), F.lit(0).cast("long")).alias("violations")))
    return full.select(F.explode(rows).alias("r")).select("r.check", "r.violations")


def key_checks(t: dict) -> DataFrame:
    """G1-G5 over the seven tables: one row per check with its violation count."""
    parts = [primary_key_checks(t)]
    parts += [
        unique_and_not_null(t["dim_companies"], ["company_name"], "unique:dim_companies.company_name",
                            "not_null:dim_companies.company_name"),
        unique_and_not_null(t["dim_locations"], ["raw_location", "country"],
                            "unique:dim_locations.raw_location_country", None),
        unique_and_not_null(t["dim_skills"], ["skill_name"], "unique:dim_skills.skill_name",
                            "not_null:dim_skills.skill_name"),
        orphans(t["fact_jobs"], "company_id", t["dim_companies"], "company_id", "fk:fact_jobs.company_id"),
        orphans(t["fact_jobs"], "location_id", t["dim_locations"], "location_id", "fk:fact_jobs.location_id"),
        orphans(t["bridge_job_skills"], "job_id", t["fact_jobs"], "job_id", "fk:bridge_job_skills.job_id"),
        orphans(t["bridge_job_skills"], "skill_id", t["dim_skills"], "skill_id", "fk:bridge_job_skills.skill_id"),
        null_count(t["raw_jobs_rejected"], ["line_number"], "not_null:raw_jobs_rejected.line_number"),
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- R2a-R2d -------------------------------------------------------------------

def ads_without_company(t: dict) -> DataFrame:
    return t["fact_jobs"].agg(F.count_if(F.col("company_id").isNull()).alias("avisos_sin_empresa"))


def ads_without_location(t: dict) -> DataFrame:
    return t["fact_jobs"].agg(F.count_if(F.col("location_id").isNull()).alias("avisos_sin_ubicacion"))


def duplicate_pairs(t: dict) -> DataFrame:
    g = t["bridge_job_skills"].groupBy("job_id", "skill_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.agg(F.count(F.lit(1)).alias("pares_duplicados"))


def orphan_skills(t: dict) -> DataFrame:
    b = t["bridge_job_skills"].select("skill_id")
    s = t["dim_skills"].select("skill_id")
    return b.join(s, "skill_id", "left_anti").agg(F.count(F.lit(1)).alias("habilidades_huerfanas"))


def null_key_counts(fact: DataFrame) -> DataFrame:
    """Postings without company / location, in one pass."""
    return fact.agg(F.count_if(F.col("company_id").isNull()).alias("sin_empresa"),
                    F.count_if(F.col("location_id").isNull()).alias("sin_ubicacion"))

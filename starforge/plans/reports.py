"""The SQL reports (R1, R3-R13) as DataFrame queries over the seven tables.

``t`` is a dict of DataFrames: raw_jobs, raw_jobs_rejected, dim_companies,
dim_locations, dim_skills, fact_jobs, bridge_job_skills.  Output columns keep
the report aliases.  Top-k reports break ties by name so results are stable.
Scalar subqueries use ``DataFrame.scalar()`` (run once, no join), bound to a
column once so that a formula using it several times does not repeat it.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starforge import schemas
from starforge.functions.text import money_text, percent_text, ratio_round
from starforge.operators.joins import broadcast_if_small
from starforge.operators.star import build_dim_flags, build_fact_analytic


def _count(df: DataFrame) -> F.Column:
    return df.select(F.count(F.lit(1))).scalar()


def load_counts(t: dict) -> DataFrame:
    """Rows per table with its description."""
    parts = [t[name].agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
             for name, _ in schemas.TABLE_LABELS]
    label = reduce(lambda acc, kv: acc.when(F.col("tabla") == kv[0], kv[1]),
                   schemas.TABLE_LABELS[1:], F.when(F.col("tabla") == schemas.TABLE_LABELS[0][0],
                                                    schemas.TABLE_LABELS[0][1]))
    return reduce(DataFrame.unionByName, parts).select("tabla", "filas", label.alias("descripcion")).orderBy("tabla")


def load_times(t: dict) -> DataFrame:
    """first/last load time and row count per raw table."""
    def one(name):
        return t[name].agg(F.min("ingested_at").alias("primera_carga"), F.max("ingested_at").alias("ultima_carga"),
                           F.count(F.lit(1)).alias("total_filas")).select(F.lit(name).alias("tabla"), "*")
    return one("raw_jobs").unionByName(one("raw_jobs_rejected"))


def skills_per_ad(t: dict) -> DataFrame:
    """Skills per posting (min, max, mean to 1 decimal, postings, bridge rows)."""
    per = t["bridge_job_skills"].groupBy("job_id").agg(F.count(F.lit(1)).alias("k"))
    return per.agg(
        F.min("k").alias("minimo_habilidades"), F.max("k").alias("maximo_habilidades"),
        ratio_round(F.sum("k"), F.count(F.lit(1)), 1).alias("promedio_habilidades"),
        F.count(F.lit(1)).alias("avisos_con_habilidades"), F.sum("k").alias("total_filas_en_bridge"))


def top_skills(t: dict, k: int = 15) -> DataFrame:
    """The k most requested skills and their share of postings."""
    # grouped by id first: the big table is aggregated map-side and only the groups meet the names
    g = (t["bridge_job_skills"].groupBy("skill_id").agg(F.count("job_id").alias("avisos_que_la_piden"))
         .join(t["dim_skills"], "skill_id"))
    # ordering + limit last, so that Spark plans a take-ordered (no global sort)
    return (g.withColumn("_total", _count(t["fact_jobs"]))
             .select(F.col("skill_name").alias("habilidad"), F.col("skill_category").alias("categoria"),
                     "avisos_que_la_piden",
                     percent_text("avisos_que_la_piden", "_total", 1).alias("porcentaje_avisos"))
             .orderBy(F.desc("avisos_que_la_piden"), "habilidad").limit(k))


def salary_by_title(t: dict) -> DataFrame:
    """Postings with a yearly salary, by title (mean, min, max as money text)."""
    f = t["fact_jobs"].where(F.col("salary_year_avg").isNotNull())
    g = f.groupBy("job_title_short").agg(
        F.count(F.lit(1)).alias("total_avisos"), F.count("salary_year_avg").alias("avisos_con_salario"),
        F.avg("salary_year_avg").alias("_avg"), F.min("salary_year_avg").alias("_min"),
        F.max("salary_year_avg").alias("_max"))
    return g.orderBy(F.desc_nulls_first("_avg"), "job_title_short").select(
        F.col("job_title_short").alias("titulo_puesto"), "total_avisos", "avisos_con_salario",
        money_text("_avg").alias("salario_promedio_anual"), money_text("_min").alias("salario_minimo"),
        money_text("_max").alias("salario_maximo"))


def ads_by_title(t: dict) -> DataFrame:
    """Postings per title and share (window over the grouped rows, one per title)."""
    g = t["fact_jobs"].groupBy("job_title_short").agg(F.count(F.lit(1)).alias("cantidad_avisos"))
    total = F.sum("cantidad_avisos").over(Window.partitionBy())
    return g.select(F.col("job_title_short").alias("tipo_puesto"), "cantidad_avisos",
                    percent_text("cantidad_avisos", total, 1).alias("porcentaje")
                    ).orderBy(F.desc("cantidad_avisos"), "tipo_puesto")


def remote_by_country(t: dict, k: int = 10) -> DataFrame:
    """Remote vs on-site postings by country, top k by total."""
    per = t["fact_jobs"].where("location_id is not null").groupBy("location_id").agg(
        F.count_if(F.col("work_from_home")).alias("_r"), F.count_if(~F.col("work_from_home")).alias("_p"),
        F.count(F.lit(1)).alias("_n"))
    g = per.join(t["dim_locations"], "location_id").groupBy(F.col("country").alias("pais")).agg(
        F.sum("_r").alias("remotos"), F.sum("_p").alias("presenciales"), F.sum("_n").alias("total"))
    return g.orderBy(F.desc("total"), F.asc_nulls_first("pais")).limit(k)


def top_companies(t: dict, k: int = 10) -> DataFrame:
    """Companies with most postings, with mean yearly salary."""
    g = (t["fact_jobs"].where("company_id is not null").groupBy("company_id").agg(
            F.count("job_id").alias("avisos_publicados"), F.avg("salary_year_avg").alias("_avg"))
         .join(t["dim_companies"], "company_id"))
    return g.orderBy(F.desc("avisos_publicados"), "company_name").limit(k).select(
        F.col("company_name").alias("empresa"), "avisos_publicados", money_text("_avg").alias("salario_promedio"))


def skills_by_category(t: dict) -> DataFrame:
    """Distinct skills and mentions per category, share of all bridge rows."""
    s, b = t["dim_skills"], t["bridge_job_skills"]
    per = b.groupBy("skill_id").agg(F.count("job_id").alias("_n"))
    g = s.join(per, "skill_id", "left").groupBy(F.col("skill_category").alias("categoria")).agg(
        F.count_distinct("skill_id").alias("habilidades_distintas"),
        F.sum(F.coalesce("_n", F.lit(0))).alias("veces_mencionada"))
    return (g.withColumn("_total", _count(b))
             .select("categoria", "habilidades_distintas", "veces_mencionada",
                     percent_text("veces_mencionada", "_total", 1).alias("porcentaje"))
             .orderBy(F.desc("veces_mencionada"), "categoria"))


def ads_by_category(t: dict) -> DataFrame:
    """Distinct postings and distinct skills beside the mentions, per category.

    The bridge is first reduced to one row per (category, posting) with its mentions, map-side and then by a
    shuffle on both; only these partial counts meet by category, so a category that holds most rows is no
    hot key.  Distinct skills come from the bridge grouped by skill.
    """
    skills = t["dim_skills"].select("skill_id", F.col("skill_category").alias("categoria"))
    bridge = t["bridge_job_skills"]
    per_ad = bridge.join(broadcast_if_small(skills), "skill_id").groupBy("categoria", "job_id").agg(F.count(F.lit(1)).alias("_n"))
    ads = per_ad.groupBy("categoria").agg(F.count("job_id").alias("avisos_distintos"), F.sum("_n").alias("veces_mencionada"))
    used = (bridge.groupBy("skill_id").agg(F.count(F.lit(1)).alias("_n")).join(skills, "skill_id")
                  .groupBy("categoria").agg(F.count_distinct("skill_id").alias("habilidades_usadas")))
    return (ads.join(used, "categoria").select("categoria", "avisos_distintos", "habilidades_usadas", "veces_mencionada")
               .orderBy(F.desc("avisos_distintos"), "categoria"))


def flag_counts(t: dict) -> DataFrame:
    """M2: the eight flag combinations with the postings of each (0 where there are none)."""
    flags = build_dim_flags(t["fact_jobs"])
    per = build_fact_analytic(t["fact_jobs"]).groupBy("flag_id").agg(F.sum("job_count").alias("avisos"))
    return flags.join(per, "flag_id", "left").withColumn("avisos", F.coalesce("avisos", F.lit(0)).cast("long"))


def column_profile(t: dict) -> DataFrame:
    """The columns of every stored table as its files hold them - position, name, type - with the number of
    rows, of NULLs, and whether a column declared NOT NULL holds any."""
    parts = []
    for name, declared in schemas.TABLE_SCHEMAS.items():
        df = t[name]
        nulls = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in df.schema])
        required = {f.name for f in declared.fields if not f.nullable}
        columns = [F.struct(F.lit(i + 1).alias("posicion"), F.lit(f.name).alias("columna"), F.lit(f.dataType.simpleString()).alias("tipo"),
                            F.col("_rows").alias("filas"), F.col(f.name).alias("nulos"),
                            (F.lit(f.name in required) & (F.col(f.name) > 0)).alias("viola_not_null"))
                   for i, f in enumerate(df.schema)]
        parts.append(nulls.select(F.lit(name).alias("tabla"), F.explode(F.array(*columns)).alias("c")).select("tabla", "c.*"))
    return reduce(DataFrame.unionByName, parts)


def reject_count(t: dict) -> DataFrame:
    """R11a."""
    return t["raw_jobs_rejected"].agg(F.count(F.lit(1)).alias("filas_con_problemas"))


def reject_sample(t: dict, k: int = 50) -> DataFrame:
    """The first k rejects in file order, content cut to 200 characters."""
    r = t["raw_jobs_rejected"]
    return r.orderBy("source_file", "line_number").limit(k).select(
        F.col("line_number").alias("numero_linea_csv"), F.col("fields_expected").alias("columnas_esperadas"),
        F.left("raw_content", F.lit(200)).alias("contenido_de_la_fila"),
        F.col("ingested_at").alias("hora_de_carga_colombia"))


def valid_share(t: dict) -> DataFrame:
    """Valid rows, rejected rows, valid share to 2 decimals."""
    spark = t["raw_jobs"].sparkSession
    counts = spark.range(1).select(_count(t["raw_jobs"]).alias("filas_validas"),
                                   _count(t["raw_jobs_rejected"]).alias("filas_con_problemas"))
    v, r = F.col("filas_validas"), F.col("filas_con_problemas")
    return counts.select(v, r, percent_text(v, F.nullif(v + r, F.lit(0)), 2).alias("porcentaje_calidad"))


def ads_for_skill(t: dict, skill_name: str) -> DataFrame:
    """Postings that ask for one skill."""
    s = t["dim_skills"].where(F.col("skill_name") == skill_name).select("skill_id")
    return t["bridge_job_skills"].join(s, "skill_id").agg(F.count(F.lit(1)).alias("count"))


def salary_by_skill(t: dict) -> DataFrame:
    """Mean yearly salary per skill (shown to the cent), highest first by the unrounded mean."""
    f = t["fact_jobs"].where(F.col("salary_year_avg").isNotNull()).select("job_id", "salary_year_avg")
    g = (f.join(t["bridge_job_skills"], "job_id").groupBy("skill_id").agg(F.avg("salary_year_avg").alias("_avg"))
          .join(t["dim_skills"], "skill_id"))
    return g.orderBy(F.desc("_avg"), "skill_name").select(
        "skill_name", F.round(F.col("_avg").cast("decimal(38,10)"), 2).cast("double").alias("salario_promedio"))

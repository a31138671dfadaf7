"""The whole run — text files in, seven tables out, row counts back.

    run(spark, "s3a://bucket/postings/", "s3a://bucket/warehouse/jobs")

Every run writes to a folder of its own and is published as a whole at the end (see
``sources.store``); a failed run leaves the published tables as they were and removes
its folder.  Two failures keep something for the user: failed validation leaves every failure as a table,
and a load whose lines were all rejected still publishes both raw tables.  With
``load_raw=False`` the published ``raw_jobs`` is read instead of the text (S4).
"""
from __future__ import annotations

import logging
import uuid

from pyspark.sql import SparkSession

from starforge.operators.checks import null_key_counts
from starforge.operators.ingest import ingest, reject_preview, typed_from_raw
from starforge.operators.quality import EmptyInputError, ValidationError
from starforge.operators.star import build_star
from starforge.session import hadoop_fs
from starforge.sources.store import publish, published, read_tables, save_tables

log = logging.getLogger("starforge")

FAILURES = "_validation_failures"


def run(spark: SparkSession, path: str | None, out_dir: str, load_raw: bool = True,
        now: str | None = None, match_country: bool = False) -> dict:
    out_dir = out_dir.rstrip("/")
    run_dir = f"{out_dir}/run-{uuid.uuid4().hex[:12]}"
    tables: dict = {}
    done = False
    try:
        if load_raw:
            try:
                ing = ingest(spark, path, out_dir=run_dir, now=now)
            except ValidationError as e:
                _keep_failures(spark, e, f"{out_dir}/{FAILURES}")
                raise
            raw = ing.valid
            _log_rejects(ing)
            tables = dict(ing.paths)        # already written by ingest
        else:
            raw = spark.read.parquet(published(spark, out_dir)["raw_jobs"])
        try:
            star = build_star(typed_from_raw(raw), match_country=match_country)
        except EmptyInputError:
            if load_raw:                    # the rejects tell why nothing is left
                publish(spark, out_dir, tables)
                done = True
            raise
        counts = save_tables(spark, {**tables, **star.tables()}, out_dir, run_dir)
        done = True
    finally:
        if not done:
            _remove(spark, run_dir)         # nothing of a failed run stays behind
    nulls = null_key_counts(read_tables(spark, out_dir)["fact_jobs"]).first()
    if nulls["sin_empresa"]:
        log.warning("%s postings without company -> company_id NULL", f"{nulls['sin_empresa']:,}")
    if nulls["sin_ubicacion"]:
        log.warning("%s postings without location -> location_id NULL", f"{nulls['sin_ubicacion']:,}")
    return counts


def _keep_failures(spark: SparkSession, error: ValidationError, path: str) -> None:
    """V5: every failure as a table outside the run's folder, the first 20 of them in the log."""
    error.failures.write.mode("overwrite").parquet(path)
    error.failures = spark.read.parquet(path)
    log.error("%s data-quality failures; all of them in %s, first ones:", f"{error.count:,}", path)
    for r in error.failures.orderBy("raw_id", "column").limit(20).collect():
        log.error("  row %-10s %s %s %s", r["raw_id"], r["column"], r["check"], r["failure_case"])


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _log_rejects(ing) -> None:
    """The number of rejects and the first 20 of them (120 characters each)."""
    for what in ("dates", "numbers", "literals"):
        if ing.counts.get(f"lost_{what}"):
            log.warning("%s non-empty %s could not be read -> empty", f"{ing.counts[f'lost_{what}']:,}", what)
    n = ing.counts.get("rejected", 0)
    if not n:
        log.info("every CSV line had the expected 17 fields")
        return
    log.warning("%s line(s) rejected; first ones:", f"{n:,}")
    for r in reject_preview(ing.rejected).collect():
        log.warning("  line %-10s expected %-4s %s", r.line_number, r.fields_expected, r.content)
    if n > 20:
        log.warning("  ... and %s more (see raw_jobs_rejected)", f"{n - 20:,}")


def summary(counts: dict) -> str:
    return " | ".join(f"{k}: {v:,}" for k, v in counts.items())



"""Table storage (L1-L7): Parquet folders of a run, published together by one small file.

Every run writes its tables into a folder of its own (row counts are observed on the writes
themselves).  A table set is published by one manifest, ``_tables-<number>``, that names the
folder of every table: readers follow the newest manifest, so they see either the whole old set
or the whole new one, whatever fails in between.  The folders of the published set and of the
one before it are kept.

Several runs may publish into one folder at a time.  A manifest is created only if its number is
still free, in one step; a run that finds the number taken reads the manifest that took it and publishes on
top of that, under the next number.  No run touches the folder of another that is not yet published.
"""
from __future__ import annotations

import json
import logging
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starforge import schemas
from starforge.session import hadoop_fs

# Load order: dimensions, fact, bridge (then the raw tables).
LOAD_ORDER = ["dim_companies", "dim_locations", "dim_skills", "fact_jobs", "bridge_job_skills",
              "raw_jobs", "raw_jobs_rejected"]
MANIFEST = "_tables-"
PUBLISH_TRIES = 100

log = logging.getLogger("starforge")


def conform(df: DataFrame, schema) -> DataFrame:
    """L2/L3: the declared columns, in declared order and types (missing ones -> NULL)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def save_table(df: DataFrame, path: str, columns: list | None = None) -> int:
    """Overwrite ``path`` with ``df`` (optionally a column subset); returns the row count.

    Unlike a bulk COPY that skips empty frames, an empty frame still replaces
    the table (with its schema).
    """
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    obs = Observation(f"save-{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get.get("rows", 0) or 0)


def _manifests(spark: SparkSession, out_dir: str) -> list[tuple[int, str]]:
    """(number, file name) of the manifests of ``out_dir``, oldest first."""
    fs, p = hadoop_fs(spark, out_dir)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted((int(n[len(MANIFEST):]), n) for n in names if n.startswith(MANIFEST) and n[len(MANIFEST):].isdigit())


def _read_manifest(spark: SparkSession, out_dir: str, name: str) -> dict | None:
    """The tables of a manifest; None if it is gone, or not yet whole (some stores show a file while it is written)."""
    fs, p = hadoop_fs(spark, f"{out_dir}/{name}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    except ValueError:
        return None
    finally:
        stream.close()


def _newest(spark: SparkSession, out_dir: str) -> tuple[int, dict]:
    """The highest manifest number there is, and the tables of the newest whole manifest."""
    found = _manifests(spark, out_dir)
    for _, name in reversed(found):
        tables = _read_manifest(spark, out_dir, name)
        if tables is not None:
            return found[-1][0], tables
    return (found[-1][0] if found else 0), {}


def published(spark: SparkSession, out_dir: str) -> dict:
    """Table name -> path of the published set (empty if nothing was published)."""
    out_dir = out_dir.rstrip("/")
    return {t: f"{out_dir}/{rel}" for t, rel in _newest(spark, out_dir)[1].items()}


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text`` unless it exists, in one step; False if it does."""
    fs, target = hadoop_fs(spark, path)
    local = fs.getScheme() == "file"
    # a local file system has no exclusive create through Hadoop: a whole file gets its second name by a link
    written = hadoop_fs(spark, f"{path.rsplit('/', 1)[0]}/_new-{uuid.uuid4().hex[:12]}")[1] if local else target
    try:
        stream = fs.create(written, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if local:
            files = spark.sparkContext._jvm.java.nio.file
            names = [files.Paths.get(fs.makeQualified(p).toUri()) for p in (target, written)]
            files.Files.createLink(*names)
        return True
    except Py4JJavaError as e:
        if not fs.exists(target):
            raise
        log.info("%s is taken (%s)", path, e.java_exception.getClass().getSimpleName())
        return False
    finally:
        if local:
            fs.delete(written, False)


def publish(spark: SparkSession, out_dir: str, tables: dict) -> int:
    """Make ``tables`` (name -> path under ``out_dir``) the published ones; others stay as they are.  Returns the
    number of the manifest."""
    out_dir = out_dir.rstrip("/")
    ours = {t: path[len(out_dir) + 1:] for t, path in tables.items()}
    for _ in range(PUBLISH_TRIES):
        last, current = _newest(spark, out_dir)
        if _create(spark, f"{out_dir}/{MANIFEST}{last + 1:08d}", json.dumps({**current, **ours})):
            _remove_unreferenced(spark, out_dir)
            return last + 1
    raise OSError(f"could not publish into {out_dir}: {PUBLISH_TRIES} other runs were faster")


def _remove_unreferenced(spark: SparkSession, out_dir: str) -> None:
    """Drop manifests before the last two, and the run folders that only those name."""
    found = _manifests(spark, out_dir)

    def folders(manifests: list) -> set:
        tables = [_read_manifest(spark, out_dir, name) or {} for _, name in manifests]
        return {rel.split("/")[0] for t in tables for rel in t.values()}

    old, kept = found[:-2], folders(found[-2:])
    fs, _ = hadoop_fs(spark, out_dir)
    for name in [f for f in folders(old) - kept if f.startswith("run-")] + [name for _, name in old]:
        fs.delete(hadoop_fs(spark, f"{out_dir}/{name}")[1], True)


def save_tables(spark: SparkSession, tables: dict, out_dir: str, run_dir: str | None = None) -> dict:
    """Write all tables to the run's folder, then publish them together. Returns counts.

    A value may be a DataFrame (written here) or the path of a table that is
    already written under ``out_dir``.
    """
    out_dir = out_dir.rstrip("/")
    run_dir = run_dir or f"{out_dir}/run-{uuid.uuid4().hex[:12]}"
    order = [n for n in LOAD_ORDER if n in tables] + [n for n in tables if n not in LOAD_ORDER]
    counts, paths = {}, {}
    for name in order:
        t = tables[name]
        if isinstance(t, str):          # already written (e.g. by ingest)
            paths[name] = t
            counts[name] = spark.read.parquet(t).count()
        else:
            if name in schemas.TABLE_SCHEMAS:
                t = conform(t, schemas.TABLE_SCHEMAS[name])
            paths[name] = f"{run_dir}/{name}"
            counts[name] = save_table(t, paths[name])
    publish(spark, out_dir, paths)
    return counts


def read_tables(spark: SparkSession, out_dir: str, names=None) -> dict:
    paths = published(spark, out_dir)
    return {n: spark.read.parquet(paths[n]) for n in names or LOAD_ORDER}

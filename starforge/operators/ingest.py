"""Read the spreadsheet-exported postings CSV: route, number, type, validate, load.

The text is read and parsed once.  Plan (every pass is a DataFrame job; nothing funnels through one task):

* staging - scan the text, classify every line (blank / good / bad), type the 17 fields of good
  lines and keep the text of bad ones; written as one table in line order.
* statistics - a scan of the staged table's narrow columns, hash-aggregated per text split and staged split:
  line count, first position, good and bad counts, hash of the first line (the header check).  One row per
  pair of splits; running sums over those few rows give each one's line offset (per file) and good/bad-row
  offsets (global, file order).
* valid rows - scan the staged table, keep good rows and number them in their scan partition, then join the
  offsets; write ``raw_jobs`` while observing validation-failure counts.  Literals that the built-in reading left
  over are read here by the exact step; without any there is no Python in the plan.
* rejects - same scan, bad rows, write ``raw_jobs_rejected``.

Rows are numbered before the join, so the ids do not depend on how Spark joins the offsets.  A text position
is a ``monotonically_increasing_id`` of the staging scan, stored with the line; a staged position is one of the
staged scans, which see the same files with the same pinned split size, so they agree.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from starforge import schemas
from starforge.functions.text import (
    finished_groups, finished_list, left_over, lenient_number, lenient_timestamp, plain_groups, plain_list, py_strip, strict_true,
    unwrap_excel, with_literals,
)
from starforge.operators.keys import POS_BITS, exclusive_prefix_sum, partition_of
from starforge.operators.quality import ValidationError, failure_count_columns, failures_of
from starforge.session import conf_override, hadoop_fs, scratch_path
from starforge.sources.lines import read_lines

_FIELD_SCHEMA = ", ".join(f"c{i} string" for i in range(schemas.EXPECTED_COLS)) + ", _bad string"
_CSV_OPTIONS = {"columnNameOfCorruptRecord": "_bad", "escape": '"', "mode": "PERMISSIVE"}


class HeaderError(ValueError):
    pass


@dataclass
class Ingested:
    valid: DataFrame                 # raw_jobs rows (typed) + parsed skill columns
    rejected: DataFrame              # raw_jobs_rejected rows
    header: list = field(default_factory=list)
    counts: dict = field(default_factory=dict)
    paths: dict = field(default_factory=dict)   # where raw_jobs / raw_jobs_rejected were written


def line_checks(value) -> list:
    """_blank (whitespace only) and _rec (the 17 fields + _bad) of a line."""
    rec = F.from_csv(unwrap_excel(value), _FIELD_SCHEMA, _CSV_OPTIONS)
    return [(py_strip(value) == F.lit("")).alias("_blank"), rec.alias("_rec")]


def with_ok(df: DataFrame) -> DataFrame:
    """_ok: exactly 17 fields (not blank, not an empty unwrapped line)."""
    # the texts that unwrap to nothing
    return df.withColumn("_ok", ~F.col("_blank") & ~F.col("value").isin("", '"', '""') & F.col("_rec._bad").isNull())


def classify(lines: DataFrame) -> DataFrame:
    """Add _blank, _rec (17 fields + _bad) and _ok (exactly 17 fields) to lines."""
    return with_ok(lines.select("*", *line_checks(F.col("value"))))


def read_classified(spark: SparkSession, path) -> DataFrame:
    """Lines of ``path`` with positions and checks computed in one projection."""
    return with_ok(read_lines(spark, path, derive=line_checks))


SPLIT = ["_file", "_block", "_sfile", "_sblock"]


def split_counts(staged: DataFrame) -> DataFrame:
    """One row per text split (_file, _block) and staged split (_sfile, _sblock): line count, first positions, good
    and bad counts, hash of the first line.

    Only fixed-width values are aggregated (counts, first positions, flags of
    the first line), so Spark uses a hash aggregate with no sort of the lines.
    """
    per_split = staged.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_pos").alias("_pos0"),
        F.min("_spos").alias("_spos0"),
        F.count_if("_ok").alias("_ok_all"),
        F.min_by("_ok", "_pos").alias("_first_ok"),
        F.min_by("_hash", "_pos").alias("_first_hash"),
        F.count_if("_bad").alias("_bad_all"),
        F.min_by("_bad", "_pos").alias("_first_bad"),
        F.count_if("_left").alias("_left_all"),
        F.min_by("_left", "_pos").alias("_first_left"),
    )
    # The first line of each file (in block 0) is its header, never a data row.
    heads = per_split.where("_block = 0").groupBy(F.col("_file").alias("_hfile")).agg(F.min("_pos0").alias("_head_pos"))
    marked = per_split.join(heads, (F.col("_file") == F.col("_hfile")) & (F.col("_pos0") == F.col("_head_pos")), "left")
    is_head = F.col("_head_pos").isNotNull()
    head_ok = F.when(is_head & F.col("_first_ok"), 1).otherwise(0)
    head_bad = F.when(is_head & F.col("_first_bad"), 1).otherwise(0)
    # the names of the literals' columns are no literals: without this every load would take the exact step
    head_left = F.when(is_head & F.col("_first_left"), 1).otherwise(0)
    return marked.select(
        *SPLIT, "_n", "_pos0", "_spos0", "_ok_all", "_bad_all", (F.col("_left_all") - head_left).alias("_left_all"), "_head_pos",
        head_ok.alias("_head_ok"), head_bad.alias("_head_bad"),
        (F.col("_ok_all") - head_ok).alias("_ng"), (F.col("_bad_all") - head_bad).alias("_nb"),
        F.when(is_head, F.col("_first_hash")).alias("_header_hash"))


def file_key() -> "F.Column":
    """Fixed-width key of the two files of a row, for the join with the split offsets."""
    return F.xxhash64("_file", "_sfile")


def split_offsets(counts: DataFrame) -> DataFrame:
    """Per row of ``split_counts``: line offset within the text file, and what to add to the number that
    ``monotonically_increasing_id`` gives a good / bad row of the staged split, in a pass that
    keeps only those rows (header lines included), to get its id.

    The global running sums are distributed prefix sums; the per-file line
    offset is the global prefix minus the prefix at the file's first split, so
    even one huge file is not funnelled through a single task.
    """
    g = exclusive_prefix_sum(counts, ["_file", "_block", "_sblock", "_sfile"], ["_n", "_ng", "_nb"], prefix="_before")
    starts = g.groupBy("_file").agg(F.min("_before_n").alias("_file_start"))
    g = g.join(starts, "_file")
    part = partition_of(F.col("_spos0"))
    base = F.shiftleft(part, POS_BITS)
    # splits sharing one scan partition: a handful (small files packed together)
    w = Window.partitionBy(part).orderBy("_spos0").rowsBetween(Window.unboundedPreceding, -1)
    good_pos0 = base + F.coalesce(F.sum("_ok_all").over(w), F.lit(0))
    bad_pos0 = base + F.coalesce(F.sum("_bad_all").over(w), F.lit(0))
    return g.select(
        "_file", file_key().alias("_fkey"), F.col("_block").alias("_oblock"), F.col("_sblock").alias("_osblock"),
        "_head_pos", "_header_hash", "_left_all",
        (F.col("_before_n") - F.col("_file_start") - F.col("_pos0") + 1).alias("_line_shift"),
        (F.col("_before_ng") - good_pos0 - F.col("_head_ok") + 1).alias("_good_shift"),
        (F.col("_before_nb") - bad_pos0 - F.col("_head_bad") + 1).alias("_bad_shift"),
    )


# One row of offsets: key, two blocks, header position and three shifts, 8 bytes each.
OFFSET_ROW_BYTES = 56
# Offsets are broadcast up to this size; beyond it Spark joins them by shuffle, with the same result.
BROADCAST_OFFSET_BYTES = 64 << 20


def _header_line(spark: SparkSession, path) -> str:
    """The first line of one file (tasks run until one is found)."""
    # the first line that a task meets in a first split is the first one of that file
    first = read_lines(spark, path).where(F.col("_block") == 0).select("value").limit(1).first()
    if first is None:
        raise HeaderError(f"no lines in {path!r}")
    return first[0]


def _one_header(stats: DataFrame, path) -> None:
    """Every file must have the same first line, by its 64-bit hash."""
    if stats.select("_header_hash").where("_header_hash is not null").distinct().limit(2).count() > 1:
        raise HeaderError(f"files under {path!r} do not share one header line")


def _header_names(header_line: str) -> list:
    names = [c.strip() for c in header_line.split(",")]
    if sorted(names) != sorted(schemas.CSV_COLUMNS):
        raise HeaderError(
            f"header has {len(names)} columns {names!r}; expected the {schemas.EXPECTED_COLS} "
            f"names {schemas.CSV_COLUMNS!r}")
    return names


def typed_columns(header: list) -> list:
    """The 17 fields by header position -> typed columns."""
    pos = {name: i for i, name in enumerate(header)}
    f = lambda name: F.col(f"_rec.c{pos[name]}")
    out = []
    for name in schemas.CSV_COLUMNS:
        if name in schemas.BOOL_COLUMNS:
            out.append(strict_true(f(name)).alias(name))
        elif name in schemas.NUMBER_COLUMNS:
            out.append(lenient_number(f(name)).alias(name))
        elif name == "job_posted_date":
            out.append(lenient_timestamp(f(name)).alias(name))
        else:  # text: from_csv already maps '' and "" to NULL; whitespace is kept
            out.append(F.nullif(f(name), F.lit("")).alias(name))
    return out


def lost_columns(header: list) -> list:
    """How many non-empty dates and numbers of a line became NULL (after ``typed_columns``)."""
    pos = {name: i for i, name in enumerate(header)}

    def lost(name: str) -> F.Column:
        return F.when(F.col(name).isNull() & (py_strip(f"_rec.c{pos[name]}") != ""), 1).otherwise(0)

    return [lost("job_posted_date").alias("_lost_dates"),
            sum((lost(c) for c in schemas.NUMBER_COLUMNS), F.lit(0)).alias("_lost_numbers")]


def staged_lines(spark: SparkSession, path, header: list, out: str) -> DataFrame:
    """The classified lines of ``path``, typed, written to ``out``; read back with staged positions.

    Good lines have their typed fields and plain literals, bad ones their first characters.
    """
    bad = ~F.col("_ok") & ~F.col("_blank")
    lines = read_classified(spark, path).select("*", *typed_columns(header))
    literals = {"_plain_list": plain_list("job_skills"), "_plain_groups": plain_groups("job_type_skills")}
    lines = lines.withColumns({c: F.when(F.col("_ok"), read) for c, read in literals.items()})
    left = left_over("job_skills", F.col("_plain_list")).isNotNull() | left_over("job_type_skills", F.col("_plain_groups")).isNotNull()
    lines.select(
        "_file", "_block", "_pos", "_ok", bad.alias("_bad"), (F.col("_ok") & left).alias("_left"),
        F.when(F.col("_block") == 0, F.xxhash64("value")).alias("_hash"),
        F.when(bad, F.substring("value", 1, schemas.REJECT_CONTENT_CHARS)).alias("_content"),
        *schemas.CSV_COLUMNS, *literals, *lost_columns(header)).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out).select(
        "*", F.col("_metadata.file_path").alias("_sfile"), F.col("_metadata.file_block_start").alias("_sblock"),
        F.monotonically_increasing_id().alias("_spos"))


def lost_literals() -> F.Column:
    """Aggregate: non-empty literals that became empty."""
    def lost(name: str, empty: str) -> F.Column:
        return F.when((F.size(f"{name}_parsed") == 0) & ~F.col(name).rlike(rf"^\s*(\{empty[0]}\s*\{empty[1]}|nan)?\s*$"), 1).otherwise(0)

    return F.sum(lost("job_skills", "[]") + lost("job_type_skills", "{}")).alias("lost_literals")


def with_parsed_skills(df: DataFrame, exact: bool = True) -> DataFrame:
    """List and dict literal text -> nested columns."""
    return with_literals(df, {"job_skills_parsed": "job_skills"}, {"job_type_skills_parsed": "job_type_skills"}, exact)


def load_time(now: str | None) -> "F.Column":
    """One load instant per run, as wall-clock time (no zone) in the load zone."""
    if now is not None:
        return F.lit(now).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(schemas.LOAD_TIME_ZONE), F.current_timestamp().cast("timestamp_ntz"))


def ingest(spark: SparkSession, path, out_dir: str | None = None, now: str | None = None,
           validate: bool = True) -> Ingested:
    """B1 + L1: text files -> raw_jobs and raw_jobs_rejected written under ``out_dir``.

    Raises ``HeaderError`` on a wrong header and ``ValidationError`` (with every
    failure as a DataFrame) when a rule fails; in both cases nothing is returned
    as loaded.
    """
    out_dir = out_dir or scratch_path(spark, "ingest")
    pinned = {"spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism)}
    with conf_override(spark, pinned):
        # The staged scans read the same file listing with the same pinned split size, so every line gets the
        # same (file, split, position) in each (filters on the split columns do not prune splits).
        header = _header_names(_header_line(spark, path))
        lines = staged_lines(spark, path, header, f"{out_dir}/_lines")
        split_counts(lines).write.mode("overwrite").parquet(f"{out_dir}/_split_counts")
        stats_path = f"{out_dir}/_split_stats"
        split_offsets(spark.read.parquet(f"{out_dir}/_split_counts")).write.mode("overwrite").parquet(stats_path)
        stats = spark.read.parquet(stats_path)
        _one_header(stats, path)
        n_splits, n_left = stats.agg(F.count(F.lit(1)), F.coalesce(F.sum("_left_all"), F.lit(0))).first()
        offsets = stats.drop("_file", "_header_hash", "_left_all")
        if n_splits * OFFSET_ROW_BYTES <= BROADCAST_OFFSET_BYTES:
            offsets = F.broadcast(offsets)
        # One load instant per run, shared by both tables
        stamp = F.lit(spark.range(1).select(load_time(now).cast("string")).first()[0]).cast("timestamp_ntz")

        def with_offsets(rows: DataFrame) -> DataFrame:
            """Numbered rows with their split's offsets, header lines left out."""
            numbered = rows.withColumn("_number", F.monotonically_increasing_id())
            joined = numbered.join(offsets, (file_key() == F.col("_fkey")) & (F.col("_block") == F.col("_oblock"))
                                   & (F.col("_sblock") == F.col("_osblock")))
            return (joined.where(F.col("_head_pos").isNull() | (F.col("_pos") != F.col("_head_pos")))
                          .withColumn("line_number", F.col("_pos") + F.col("_line_shift")))

        # ---- valid rows -> raw_jobs
        good = with_offsets(lines.where(F.col("_ok")))
        text = {c: left_over(c, F.col(plain)) if n_left else None
                for c, plain in (("job_skills", "_plain_list"), ("job_type_skills", "_plain_groups"))}
        parsed = good.withColumns({"job_skills_parsed": finished_list(F.col("_plain_list"), text["job_skills"]),
                                   "job_type_skills_parsed": finished_groups(F.col("_plain_groups"), text["job_type_skills"])})
        obs = Observation("raw_jobs")
        parsed = parsed.withColumn("raw_id", F.col("_number") + F.col("_good_shift")).observe(
            obs, F.count(F.lit(1)).alias("rows"), *failure_count_columns(), F.sum("_lost_dates").alias("lost_dates"),
            F.sum("_lost_numbers").alias("lost_numbers"), lost_literals())
        raw = parsed.select(
            "raw_id", *[c for c in schemas.CSV_COLUMNS if c not in ("job_skills", "job_type_skills")],
            # C11: the raw copy keeps a missing literal as the text '<NA>'
            F.coalesce("job_skills", F.lit(schemas.RAW_NA_TEXT)).alias("job_skills"),
            F.coalesce("job_type_skills", F.lit(schemas.RAW_NA_TEXT)).alias("job_type_skills"),
            stamp.alias("ingested_at"), F.col("_file").alias("source_file"), "line_number",
            # P6/P7 parsed once here and stored as nested columns
            "job_skills_parsed", "job_type_skills_parsed")
        raw_path = f"{out_dir}/raw_jobs"
        raw.write.mode("overwrite").parquet(raw_path)
        metrics = obs.get

        # ---- rejected rows -> raw_jobs_rejected
        rejects = with_offsets(lines.where(F.col("_bad")))
        rej = rejects.select(
            (F.col("_number") + F.col("_bad_shift")).alias("rejected_id"),
            F.col("_file").alias("source_file"), F.col("line_number").cast("long").alias("line_number"),
            F.lit(None).cast("int").alias("fields_found"),
            F.lit(schemas.EXPECTED_COLS).cast("int").alias("fields_expected"),
            F.col("_content").alias("raw_content"),
            stamp.alias("ingested_at"))
        obs_r = Observation("raw_jobs_rejected")
        rej = rej.observe(obs_r, F.count(F.lit(1)).alias("rows"))
        rej_path = f"{out_dir}/raw_jobs_rejected"
        rej.write.mode("overwrite").parquet(rej_path)
        rej_rows = obs_r.get["rows"]
    fs, lines_path = hadoop_fs(spark, f"{out_dir}/_lines")
    fs.delete(lines_path, True)         # as large as the input, and not needed any more

    raw_df = spark.read.parquet(raw_path)
    failures = int(metrics.get("failures", 0) or 0)
    if validate and failures:
        raise ValidationError(failures, failures_of(raw_df, key="raw_id"))
    rejected = spark.read.parquet(rej_path)
    counts = {"valid": int(metrics["rows"]), "rejected": int(rej_rows), "splits": int(n_splits),
              **{k: int(metrics.get(k) or 0) for k in ("lost_dates", "lost_numbers", "lost_literals")}}
    return Ingested(valid=raw_df, rejected=rejected, header=header, counts=counts,
                    paths={"raw_jobs": raw_path, "raw_jobs_rejected": rej_path})


def typed_from_raw(raw: DataFrame) -> DataFrame:
    """The saved raw table read back as the typed, parsed frame (``_row`` = raw_id).

    The parsed skill columns are stored by ``ingest``; a raw table without
    them is parsed here.
    """
    df = raw.withColumn("_row", F.col("raw_id"))
    if "job_skills_parsed" in raw.columns and "job_type_skills_parsed" in raw.columns:
        return df
    return with_parsed_skills(df)


def reject_preview(rejected: DataFrame, n: int = 20, width: int = 120) -> DataFrame:
    """The first ``n`` rejects (by file and line) with ``width`` characters each."""
    return (rejected.orderBy("source_file", "line_number").limit(n)
            .select("line_number", "fields_expected",
                    F.substring("raw_content", 1, width).alias("content")))


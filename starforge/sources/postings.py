"""A job-postings sample derived from the driver's TPC-H-style tables.

One posting per order (row order = o_orderkey):

* company = customer name (missing for some orders), location = a city code
  from the customer key (missing for some orders), country = nation name, so
  one raw location appears with many countries;
* title from a fixed list by order key, salary from the order total (hourly
  for status 'P');
* skills = part names of the order's lines (by line number, part key), and the
  skill dictionary groups them by part type in order of first line.

``write_postings_csv`` then writes it as spreadsheet-style CSV text (every line
wrapped in quotes, inner quotes doubled), one header per file, a bounded
number of postings per file; some lines are deliberately broken (too few
fields), some followed by whitespace-only lines, some ended by CRLF or a bare CR, some with
empty skill fields, some with a byte that is not UTF-8.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge import schemas
from starforge.functions.text import excel_line
from starforge.session import conf_override

# Order lines whose lists one task makes; their number sets the number of tasks.
LINES_PER_TASK = 250_000

# FIXED VALUES of the sample (the SQL oracle repeats them).
POSTINGS_PER_FILE = 4000      # bounded rows per written file / writer task
BROKEN_EVERY, BROKEN_AT = 50, 7      # o_orderkey % 50 = 7 -> line cut to 15 fields
BLANK_EVERY, BLANK_AT = 13, 5        # o_orderkey % 13 = 5 -> a '   ' line follows
CRLF_EVERY, CRLF_AT = 11, 3          # o_orderkey % 11 = 3 -> line ends with CRLF
DQ_EVERY, DQ_AT = 19, 4              # o_orderkey % 19 = 4 -> skills list in "..." with a trailing comma
BROKEN_FIELDS = 15
MISSING_EVERY, MISSING_AT = 31, 8    # o_orderkey % 31 = 8 -> both skill fields are empty
BYTE_EVERY, BYTE_AT = 37, 11         # o_orderkey % 37 = 11 -> the title ends in a byte that is no UTF-8
BARE_EVERY, BARE_AT = 41, 17         # o_orderkey % 41 = 17 -> a bare CR and a blank line follow


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its lines' (line number, part key, type, name), sorted.

    An order holds a handful of lines (TPC-H bounds it), so the per-order
    list is bounded.  The lines of an order are far apart in the table, so lists made before a shuffle
    would save nothing and be sorted, and spilled, once more: the lines are dealt by order first, in parts
    of bounded size, and each part makes its lists alone.
    """
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    pa = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // LINES_PER_TASK))
    items = li.join(pa, li.l_partkey == pa.p_partkey).repartition(parts, "l_orderkey")
    return items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "p_type", "p_name"))).alias("items"))


def _quoted(c):
    return F.concat(F.lit("'"), c, F.lit("'"))


def _joined(names, quote: str) -> F.Column:
    """The names that are not null, each in quotes, with commas between; NULL without an array."""
    body = F.array_join(names, f"{quote}, {quote}")
    # nothing between the quotes: no name at all, or one that is empty
    one_by_one = F.array_join(F.transform(names, lambda x: F.concat(F.lit(quote), x, F.lit(quote))), ", ")
    return F.when(body != "", F.concat(F.lit(quote), body, F.lit(quote))).otherwise(one_by_one)


def skills_text(items, double_quoted=None) -> F.Column:
    """"['a', 'b']" of the item names ('[]' when there are none); where
    ``double_quoted`` holds, '["a", "b",]' (double quotes, trailing comma)."""
    body = _joined(items["p_name"], "'")
    text = F.concat(F.lit("["), body, F.lit("]"))
    if double_quoted is not None:
        dq = _joined(items["p_name"], '"')
        text = F.when(double_quoted, F.concat(F.lit("["), dq, F.lit(",]"))).otherwise(text)
    return F.coalesce(text, F.lit("[]"))


def type_skills_text(items) -> F.Column:
    """"{'TYPE': ['a'], ...}" with types in order of first line ('{}' when none)."""
    cats = F.array_distinct(items["p_type"])
    groups = F.transform(cats, lambda c: F.concat(
        _quoted(c), F.lit(": ["),
        F.array_join(F.transform(F.filter(items, lambda x: x["p_type"] == c),
                                 lambda x: _quoted(x["p_name"])), ", "),
        F.lit("]")))
    return F.coalesce(F.concat(F.lit("{"), F.array_join(groups, ", "), F.lit("}")), F.lit("{}"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed postings (17 columns) plus ``_row`` (= o_orderkey)."""
    o = _table(spark, sf_dir, "orders")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sk = order_skills(spark, sf_dir)
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == n.n_nationkey)
          .join(sk, o.o_orderkey == sk.l_orderkey, "left"))
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    titles = F.array(*[F.lit(t) for t in schemas.VALID_JOB_TITLES])
    return j.select(
        k.alias("_row"),
        F.element_at(titles, (k % 10 + 1).cast("int")).alias("job_title_short"),
        F.concat(F.lit('Sr "'), F.col("c_mktsegment"), F.lit('", '), F.col("o_orderpriority")).alias("job_title"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("City"), (F.col("o_custkey") % 40).cast("string"), F.lit(", ST"))).alias("job_location"),
        F.concat(F.lit("via "), F.col("c_mktsegment")).alias("job_via"),
        F.when(status == "O", "Full-time").when(status == "F", "Contractor").otherwise("Part-time").alias("job_schedule_type"),
        (status == "F").alias("job_work_from_home"),
        F.col("n_name").alias("search_location"),
        F.col("o_orderdate").alias("job_posted_date"),
        (k % 2 == 0).alias("job_no_degree_mention"),
        (k % 3 == 0).alias("job_health_insurance"),
        F.col("n_name").alias("job_country"),
        F.when(status == "P", "hour").otherwise("year").alias("salary_rate"),
        F.when(status != "P", F.col("o_totalprice")).alias("salary_year_avg"),
        F.when(status == "P", F.col("o_totalprice") / 1000).alias("salary_hour_avg"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("company_name"),
        F.when(k % MISSING_EVERY != MISSING_AT, skills_text(F.col("items"), k % DQ_EVERY == DQ_AT)).alias("job_skills"),
        F.when(k % MISSING_EVERY != MISSING_AT, type_skills_text(F.col("items"))).alias("job_type_skills"),
    )


def _field_texts(p: DataFrame) -> list:
    """The 17 fields as the export writes them."""
    b = lambda c: F.when(F.col(c), "True").otherwise("False")
    out = []
    for name in schemas.CSV_COLUMNS:
        if name in schemas.BOOL_COLUMNS:
            out.append(b(name))
        elif name == "job_posted_date":
            out.append(F.date_format(name, "yyyy-MM-dd HH:mm:ss"))
        elif name == "job_title":
            bad_byte = F.unhex(F.lit("FF")).cast("string")
            out.append(F.when(F.col("_row") % BYTE_EVERY == BYTE_AT, F.concat(name, bad_byte)).otherwise(F.col(name)))
        elif name == "salary_year_avg":
            out.append(F.col(name).cast("decimal(18,2)").cast("string"))
        elif name == "salary_hour_avg":
            out.append(F.col(name).cast("decimal(18,5)").cast("string"))
        else:
            out.append(F.col(name))
    return out


def posting_lines(p: DataFrame, broken: bool = False) -> DataFrame:
    """One text value per posting (may hold an extra physical line), with file bucket; all cut short if ``broken``."""
    # the texts are columns of a step of their own, so that each is made once however often the line names it
    texts = p.select("_row", *[text.alias(f"_text{i}") for i, text in enumerate(_field_texts(p))])
    fields = [F.col(f"_text{i}") for i in range(len(schemas.CSV_COLUMNS))]
    k = F.col("_row")
    line = F.when(F.lit(broken) | (k % BROKEN_EVERY == BROKEN_AT), excel_line(fields[:BROKEN_FIELDS])).otherwise(excel_line(fields))
    ends = [F.when(k % BARE_EVERY == BARE_AT, "\r  ").otherwise(""), F.when(k % CRLF_EVERY == CRLF_AT, "\r").otherwise(""),
            F.when(k % BLANK_EVERY == BLANK_AT, "\n   ").otherwise("")]
    bucket = F.lpad(F.floor(k / POSTINGS_PER_FILE).cast("string"), 8, "0")
    return texts.select(bucket.alias("bucket"), k.alias("_k"), F.concat(line, *ends).alias("value"))


def write_postings_csv(p: DataFrame, path: str, broken: bool = False) -> str:
    """Write postings as CSV text files under ``path`` (one header per file)."""
    lines = posting_lines(p, broken)
    header = ",".join(schemas.CSV_COLUMNS)
    heads = lines.select("bucket").distinct().select(
        "bucket", F.lit(-1).cast("long").alias("_k"), F.lit(header).alias("value"))
    allrows = lines.unionByName(heads)
    # all rows of one bucket go to one task -> exactly one file per bucket,
    # header first, postings in key order; a bucket holds a bounded row count.  Such a file is
    # too small to be split, so compression costs no parallelism.
    # Lists are made by hash up to the lines of a task (``order_skills``); Spark would sort them from 128 orders on.
    with conf_override(lines.sparkSession, {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": str(LINES_PER_TASK)}):
        (allrows.repartition("bucket").sortWithinPartitions("bucket", "_k")
                .select("bucket", "value")
                .write.mode("overwrite").option("compression", "gzip").partitionBy("bucket").text(path))
    return path

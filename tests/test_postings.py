"""The postings sample: lists of an order's lines and the text files, on rows built here."""
import gzip

import pytest
from pyspark.sql import functions as F

from starforge.session import conf_override
from starforge.sources import postings


@pytest.fixture()
def sf_dir(spark, tmp_path):
    """300 orders, two of one key, one without a key; the lines of order 0 far apart, some without a key."""
    k = F.col("id")
    tables = {
        "orders": spark.range(300).select(
            F.when(k != 298, F.when(k == 299, 5).otherwise(k)).alias("o_orderkey"), (k % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
            F.lit(10.5).alias("o_totalprice"), F.lit("1996-02-10 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
            F.lit("2-HIGH").alias("o_orderpriority")),
        "customer": spark.range(7).select(k.alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"), F.lit(1).alias("c_nationkey"),
                                          F.lit("BUILDING").alias("c_mktsegment")),
        "nation": spark.range(1).select(F.lit(1).alias("n_nationkey"), F.lit("N").alias("n_name")),
        "part": spark.range(5).select(k.alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"),
                                      F.concat(F.lit("T"), k % 2).alias("p_type")),
        "lineitem": spark.range(900).select(F.when(k % 90 != 1, k % 300).alias("l_orderkey"), (k % 5).alias("l_partkey"),
                                            (F.lit(9) - F.floor(k / 300)).cast("int").alias("l_linenumber")),
    }
    for name, df in tables.items():
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_are_dealt_by_order_once_and_listed_there(spark, sf_dir, monkeypatch):
    """No list is made before the shuffle by order, and the number of tasks follows the number of lines."""
    monkeypatch.setattr(postings, "LINES_PER_TASK", 100)
    with conf_override(spark, {"spark.sql.adaptive.enabled": "false"}):
        lists = postings.order_skills(spark, sf_dir)
        plan = lists._jdf.queryExecution().executedPlan().toString()
        assert "ObjectHashAggregate" in plan.split("Exchange hashpartitioning(l_orderkey", 1)[0]
        assert "Aggregate" not in plan.split("Exchange hashpartitioning(l_orderkey", 1)[1]
        assert lists.rdd.getNumPartitions() == 9
    rows = {r["l_orderkey"]: [tuple(i) for i in r["items"]] for r in lists.collect()}
    assert len(rows) == 301 and len(rows[None]) == 10
    assert rows[0] == [(7, 0, "T0", "part 0"), (8, 0, "T0", "part 0"), (9, 0, "T0", "part 0")]


def test_lists_of_repeated_and_missing_order_keys(spark, sf_dir):
    """Each of two orders of one key has all its lines; an order without a key has none."""
    rows = postings.postings(spark, sf_dir).select("_row", "job_skills").collect()
    assert len(rows) == 300
    assert [r["job_skills"] for r in rows if r["_row"] == 5] == ["['part 0', 'part 0', 'part 0']"] * 2
    assert [r["job_skills"] for r in rows if r["_row"] is None] == [None]


def test_text_files_are_written_compressed_whole_and_in_order(spark, sf_dir, tmp_path, monkeypatch):
    """One compressed file per bucket: its header, then its postings by key; Spark reads the same lines."""
    monkeypatch.setattr(postings, "POSTINGS_PER_FILE", 100)
    path = postings.write_postings_csv(postings.postings(spark, sf_dir).where("_row is not null"), f"{tmp_path}/csv")
    files = sorted((tmp_path / "csv").glob("bucket=*/*.txt.gz"))
    assert len(files) == 3 == sum(not f.name.startswith(".") for f in (tmp_path / "csv").glob("bucket=*/*"))
    texts = [gzip.open(f, "rb").read().decode("utf-8", "replace") for f in files]
    assert all(t.startswith("job_title_short,") for t in texts)
    lines = [line for t in texts for line in t.splitlines()]
    read = [r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(path).collect()]
    assert sorted(read) == sorted(lines) and sum("BUILDING" in line for line in lines) == 299


def test_skill_texts_of_null_and_empty_names(spark):
    """Names that are null are left out, empty ones are not; no lines give empty literals."""
    lists = [(0, ["a", None, "b"]), (1, [None]), (2, [""]), (3, []), (4, None), (5, [None, "", "c"])]
    df = spark.createDataFrame(lists, "k int, names array<string>").withColumn(
        "items", F.transform("names", lambda n: F.struct(n.alias("p_name"), F.lit("T").alias("p_type"))))
    rows = df.orderBy("k").select(postings.skills_text(F.col("items")), postings.skills_text(F.col("items"), F.col("k") >= 0),
                                  postings.type_skills_text(F.col("items"))).collect()
    assert [r[0] for r in rows] == ["['a', 'b']", "[]", "['']", "[]", "[]", "['', 'c']"]
    assert [r[1] for r in rows] == ['["a", "b",]', "[,]", '["",]', "[,]", "[]", '["", "c",]']
    assert [r[2] for r in rows] == ["{'T': ['a', 'b']}", "{'T': []}", "{'T': ['']}", "{}", "{}", "{'T': ['', 'c']}"]


def test_each_text_of_a_line_is_made_once(spark, sf_dir):
    """A line names columns, not the texts' expressions: the plan holds those of the skills once."""
    p = postings.postings(spark, sf_dir)

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("array_join")
    assert joins(p) > 0 and joins(postings.posting_lines(p)) == joins(p)

"""Property tests against Python semantics, each example a batch checked in one Spark job."""
import ast
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starforge.functions.text import percent_text, py_strip, ratio_round, with_literals

printable = st.text(alphabet=st.characters(
    blacklist_categories=("Cc", "Cf", "Cs", "Co", "Cn", "Zl", "Zp", "Zs"), whitelist_characters=" "), max_size=10)
any_text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=10)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.one_of(printable, any_text), max_size=5), min_size=1, max_size=20))
def test_list_literals_match_literal_eval(spark, lists):
    texts = [repr(x) for x in lists]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r["r"] for r in with_literals(df, lists={"r": "v"}).collect()]
    assert got == [ast.literal_eval(t) for t in texts]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dictionaries(st.one_of(printable, any_text, st.integers()),
                                st.one_of(st.lists(st.one_of(printable, any_text), max_size=3), st.none(), st.tuples(printable)),
                                max_size=4), min_size=1, max_size=20))
def test_dict_literals_match_literal_eval(spark, dicts):
    texts = [repr(d) for d in dicts]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [[(g["category"], g["skills"]) for g in r["r"]] for r in with_literals(df, groups={"r": "v"}).collect()]
    assert got == [[(str(k), v) for k, v in d.items() if isinstance(v, list)] for d in dicts]


@settings(max_examples=10, deadline=None)
@given(st.lists(any_text, min_size=1, max_size=30))
def test_py_strip_matches_str_strip(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(py_strip("v")).collect()] == [t.strip() for t in texts]




@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9), st.integers(1, 3)), min_size=1, max_size=30))
def test_percent_and_ratio_round_half_up(spark, items):
    df = spark.createDataFrame(items, "n long, d long, s int")
    rows = df.select(*[percent_text("n", "d", s).alias(f"p{s}") for s in (1, 2, 3)],
                     *[ratio_round("n", "d", s).alias(f"r{s}") for s in (1, 2, 3)]).collect()
    for (n, d, _), r in zip(items, rows):
        for s in (1, 2, 3):
            q = Decimal(1).scaleb(-s)
            pct = (Decimal(n) * 100 / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP)
            assert r[f"p{s}"] == f"{pct}%"
            rat = (Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP)
            assert r[f"r{s}"] == float(rat)


@settings(max_examples=6, deadline=None)
@given(files=st.lists(st.lists(st.tuples(st.sampled_from(["good", "bad", "blank", "ws"]),
                                         st.sampled_from(["\n", "\r\n", "\r"])), min_size=1, max_size=40),
                      min_size=1, max_size=3),
       split=st.integers(min_value=200, max_value=3000))
def test_line_numbers_match_python_reading(spark, tmp_path_factory, files, split):
    """Numbering of valid rows and rejects equals Python's universal-newline reading,
    for any mix of line kinds, line ends, files and split sizes."""
    import os

    from starforge.operators.ingest import ingest
    from starforge.session import conf_override
    from tests.conftest import HEADER
    from tests.conftest import line as csv_line

    text_of = {"good": csv_line(), "bad": '"bad,row"', "blank": "", "ws": " \t "}
    d = tmp_path_factory.mktemp("numbering")
    for i, lines in enumerate(files):
        body = HEADER + "\n" + "".join(text_of[k] + end for k, end in lines)
        (d / f"part-{i:03d}.csv").write_bytes(body.encode())
    expected_good, expected_bad = [], []
    for i in range(len(files)):
        with open(d / f"part-{i:03d}.csv", encoding="utf-8", newline=None) as fh:
            fh.readline()
            for n, line in enumerate(fh, start=2):
                s = line.rstrip("\r\n")
                if not s.strip():
                    continue
                (expected_bad if s.startswith('"bad') else expected_good).append((f"part-{i:03d}.csv", n))
    with conf_override(spark, {"spark.sql.files.maxPartitionBytes": str(split)}):
        ing = ingest(spark, str(d), out_dir=str(d / "_out"))
    got_good = [(os.path.basename(r.source_file), r.line_number) for r in ing.valid.orderBy("raw_id").collect()]
    got_bad = [(os.path.basename(r.source_file), r.line_number)
               for r in ing.rejected.orderBy("rejected_id").collect()]
    assert got_good == expected_good
    assert got_bad == expected_bad

"""Literal parsing (P6/P7), line parsing (P1-P3), scalar casts (C2-C6), report text."""
import ast
import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starforge.functions.text import (
    excel_line, left_over, lenient_number, lenient_timestamp, money_text, percent_text, plain_groups, plain_list, py_strip,
    strict_true, with_literals,
)
from starforge.operators.ingest import classify
from tests.conftest import fields, line as csv_line


def _one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr("v").alias("r")).first()["r"]


def python_list(text):
    """What ast.literal_eval makes of it: the list with items as text, else []."""
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return []
    return [None if v is None else str(v) for v in value] if isinstance(value, list) else []


LISTS = ["['rust']", "['go', \"c\"]", "[]", "[ ]", " ['go'] ", "['a',]", "['don\\'t']", "[None]", "['a, None, b', None]",
         "['C,]', 'x',]", "['caf\\xe9']", "['back\\\\slash']", "['a', True, False, 3, -2.5]", "['N', 'None', 'True']",
         "['a']]", "['a'] x", "['a',,'b']", "['a'", "'a'", "('a', 'b')", "{'a': ['b']}", "None", "nan", "", "a b",
         "['" + "y" * 30000 + "']", "[" + "'z', " * 3000 + "'z']",
         # only the exact step reads these
         "['a' 'b']", "['a', 'b'] # c", "['a', ('x', 1), ['n'], {'k': 2}]", "[u'a', r'b\\d', b'c']", "['\\N{BULLET}', '\\U0001F600']",
         "['tab\there']", "[1e3, 0x1F, 1_000, 2j]", "['a'\t,\t'b']", "\t['a']", "['a'] + ['b']", "[x]", "[" * 3000,
         "[" * 90 + "]" * 90, "['''tri'ple''']", "[...]", "[-1, +2]", "['a'; 'b']", " ['a']"]
DICTS = ["{'x': ['go']}", "{'x': ['go'], 'y': ['c', 'd'], 'z': []}", "{'b': ['2'], 'a': ['1'], 'b': ['3']}",
         "{'p': ['a']} junk", "{'p': ['a']}}", "{'a': None, 'b': ['x',]}", "{'a': 'x, None', 'b': ['y', None]}",
         "{'a': {'n': ['z']}, 'b': ['y']}", "{'k': True, 'c': ['caf\\xe9']}", "{'a': 4, 'b': ['q']}", "{}", "{ }",
         "['x']", "{x}", "nan", "", "{'a': ('x',), 'b': ['z']}", "{1: ['x'], None: ['n'], (1, 2): ['t']}", "{'a': ['x'] } # c",
         "{'a': ['x' 'y']}", "{['a']: ['x']}", "{'a': ['x'], **{}}", "{'a'}", "{'a': [['n'], 1, None]}",
         "{1: ['a'], True: ['b'], 1.0: ['c']}"]


def text_of(value):
    return value if value is None or isinstance(value, str) else str(value)


class TestLiterals:
    def test_lists_as_literal_eval(self, spark):
        df = spark.createDataFrame(list(enumerate(LISTS)), "i int, v string")
        for r in with_literals(df, lists={"r": "v"}).collect():
            assert r["r"] == python_list(r["v"]), r["v"][:60]

    def test_dicts_as_literal_eval(self, spark):
        df = spark.createDataFrame(list(enumerate(DICTS)), "i int, v string")
        for r in with_literals(df, groups={"r": "v"}).collect():
            try:
                value = ast.literal_eval(r["v"])
            except (ValueError, SyntaxError, TypeError):
                value = None
            want = [(text_of(k), [text_of(i) for i in v]) for k, v in value.items() if isinstance(v, list)] \
                if isinstance(value, dict) else []
            assert [(g["category"], g["skills"]) for g in r["r"]] == want, r["v"]

    def test_null_and_no_rows(self, spark):
        df = spark.createDataFrame([(None,)], "v string")
        assert with_literals(df, {"l": "v"}, {"g": "v"}).first()[1:] == ([], [])
        assert with_literals(df.limit(0), {"l": "v"}, {"g": "v"}).collect() == []

    def test_only_left_over_texts_reach_python(self, spark):
        """The step's input is NULL for plain and blank texts, and without ``exact`` there is no step."""
        texts = ["['a', 'b',]", "{'a': ['b']}", " ", "nan", "['a' 'b']"]
        df = spark.createDataFrame([(t,) for t in texts], "v string")
        got = df.select(left_over("v", plain_list("v")).alias("l"), left_over("v", plain_groups("v")).alias("g")).collect()
        assert [r["l"] for r in got] == [None, texts[1], None, None, texts[4]]
        assert [r["g"] for r in got] == [texts[0], None, None, None, texts[4]]
        assert "Python" not in with_literals(df, {"l": "v"}, {"g": "v"}, exact=False)._jdf.queryExecution().toString()


def _parse(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = classify(df).select("value", "_ok", "_blank", F.col("_rec")).collect()
    res = []
    for r in out:
        if r["_ok"]:
            res.append([r["_rec"][f"c{i}"] for i in range(17)])
        else:
            res.append(None)
    return res


class TestParseCsvLine:
    @pytest.mark.parametrize("wrap", [True, False])
    def test_fields_come_back(self, spark, wrap):
        # a line that is not wrapped loses doubled quotes before it is split, so its fields hold none
        values = fields(job_location="Évora, Alentejo", job_title='the "best" one' if wrap else "the best one",
                        job_skills="['go', 'c', 'rust']", job_type_skills="{'x': ['go', 'c'], 'y': ['rust']}")
        row = _parse(spark, [csv_line(values, wrap)])[0]
        assert [v or "" for v in row] == values

    @pytest.mark.parametrize("text", ['"one,two"', '"', '  "  ', "x"])
    def test_rejects(self, spark, text):
        assert _parse(spark, [text]) == [None]

    @pytest.mark.parametrize("text", ["", "   ", "\t"])
    def test_blank_is_not_good(self, spark, text):
        df = spark.createDataFrame([(text,)], "value string")
        r = classify(df).first()
        assert r["_blank"] and not r["_ok"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), max_size=12),
                         min_size=17, max_size=17), min_size=1, max_size=5))
def test_excel_roundtrip_matches_python_csv(spark, rows):
    """excel_line -> unwrap -> CSV parse gives the fields back, as Python's csv does."""
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"f{i} string" for i in range(17)))
    lines = df.select(excel_line([F.col(f"f{i}") for i in range(17)]).alias("value"))
    got = [(r["_ok"], [r["_rec"][f"c{i}"] for i in range(17)]) for r in classify(lines).collect()]
    for (ok, fields), src in zip(got, rows):
        line = '"' + ",".join('"' + f.replace('"', '""') + '"' if ("," in f or '"' in f) else f
                              for f in src).replace('"', '""') + '"'
        inner = line[1:-1].replace('""', '"')
        expected = next(csv.reader(io.StringIO(inner)))
        if len(expected) == 17 and inner.strip():
            assert ok
            assert [x or "" for x in fields] == expected


class TestScalars:
    @pytest.mark.parametrize("text,expected", [
        ("true", True), (" TRUE ", True), ("True ", True), ("1", False), ("yes", False),
        (None, False), ("", False), ("false", False)])
    def test_strict_true(self, spark, text, expected):
        assert _one(spark, strict_true, text) is expected

    @pytest.mark.parametrize("text,expected", [
        ("90000", 90000.0), (" 1.5e3 ", 1500.0), ("-2", -2.0), (".5", 0.5), ("120,000", None),
        ("1.0d", None), ("nan", None), ("inf", None), ("", None), (None, None)])
    def test_lenient_number(self, spark, text, expected):
        assert _one(spark, lenient_number, text) == expected

    @pytest.mark.parametrize("text,expected", [
        ("2024-02-29 23:59:58", "2024-02-29 23:59:58"), ("2024-02-29", "2024-02-29 00:00:00"),
        ("2/29/2024", "2024-02-29 00:00:00"), ("29/02/2024", "2024-02-29 00:00:00"),
        ("04/05/2024", "2024-04-05 00:00:00"), ("2/29/2024 1:02:03 PM", "2024-02-29 13:02:03"),
        ("Feb 29 2024", "2024-02-29 00:00:00"), ("Feb 29, 2024 10:05", "2024-02-29 10:05:00"),
        ("2/9/24", "2024-02-09 00:00:00"), ("3/4/96", "1996-03-04 00:00:00"), ("20240229", "2024-02-29 00:00:00"), ("02-29-2024", "2024-02-29 00:00:00"),
        ("29-02-2024", "2024-02-29 00:00:00"), ("2024-02-30", None), ("10000", None), ("12:30", None),
        ("soon", None), ("", None), (None, None)])
    def test_lenient_timestamp(self, spark, text, expected):
        got = _one(spark, lenient_timestamp, text)
        assert (None if got is None else got.strftime("%Y-%m-%d %H:%M:%S")) == expected

    @pytest.mark.parametrize("text", [" a ", " b　", "\x1fc\t", "d", "", " é "])
    def test_py_strip(self, spark, text):
        assert _one(spark, py_strip, text) == text.strip()

    def test_percent_and_money(self, spark):
        r = spark.range(1).select(percent_text(F.lit(1), F.lit(8), 1).alias("a"),
                                  percent_text(F.lit(12), F.lit(100), 1).alias("b"),
                                  percent_text(F.lit(2), F.lit(3), 2).alias("c"),
                                  money_text(F.lit(1234567.5)).alias("d"),
                                  money_text(F.lit(None).cast("double")).alias("e")).first()
        assert (r.a, r.b, r.c, r.d, r.e) == ("12.5%", "12.0%", "66.67%", "$1,234,568", None)

    @pytest.mark.parametrize("value,text", [(100.49996, "$100"), (100.5, "$101"), (99.4999, "$99"), (0.0, "$0")])
    def test_money_is_rounded_once(self, spark, value, text):
        assert _one(spark, money_text, value, "double") == text

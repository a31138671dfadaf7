"""Line routing compared with Python's csv module on awkward lines.

The oracle: drop one outer quote pair when the line both starts and ends with
a quote, collapse doubled quotes, read one record with ``csv``; a record is
good when it has exactly 17 fields.
"""
import csv
import io

from starforge.operators.ingest import classify
from tests.conftest import fields as posting_fields
from tests.conftest import line as csv_line


def python_fields(line):
    if not line.strip():
        return "blank"
    body = line[1:-1] if (line.startswith('"') and line.endswith('"')) else line
    body = body.replace('""', "\x01").replace("\x01", '"')
    try:
        rec = next(csv.reader(io.StringIO(body)))
    except (csv.Error, StopIteration):
        return None
    return rec if len(rec) == 17 else None


def _excel_style_rows():
    """Rows in the style of a spreadsheet export with JSON-ish lists (they do
    not come out as 17 fields, so they must be rejected)."""
    head = 'Data Scientist,Sr. Data Scientist,"Beja, Sul",via LinkedIn,Full-time,False,United States,'
    return [
        '"' + head + '2023-01-01 10:00:00,False,True,United States,year,120000,,Google,'
        '"[""python"",""sql""]","{"analyst_tools": ["tableau"]}""',
        '"' + head + '2023-02-15 11:00:00,True,False,United States,,,,Meta,'
        '"[""python"",""spark""]","{"programming": ["python","spark"]}""',
    ]


def test_spark_matches_python_csv(spark):
    base = posting_fields()
    lines = [
        csv_line(base), csv_line(base, False),
        csv_line(base[:16]), csv_line(base + ["x"]),
        '"' + ",".join(base[:16]) + ',"x""y"', "   ", "", '"', '""', '""""',
        ",".join(base[:2]) + ',"Beja, Sul",' + ",".join(base[3:]),
        ",".join(f if "," not in f else f.replace(",", ";") for f in base),
        " " + ",".join(f.replace(",", ";") for f in base) + " ",
        *_excel_style_rows(),
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = classify(df).collect()
    for line, r in zip(lines, got):
        exp = python_fields(line)
        if exp == "blank":
            assert r["_blank"], line
            continue
        assert bool(r["_ok"]) == (exp is not None), line
        if exp is not None:
            fields = [r["_rec"][f"c{i}"] for i in range(17)]
            assert [f or "" for f in fields] == exp, line

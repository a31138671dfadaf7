import csv
import datetime as dt
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starforge import schemas  # noqa: E402
from starforge.operators.ingest import with_parsed_skills  # noqa: E402
from starforge.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", **{"spark.sql.shuffle.partitions": "4"})
    yield s


HEADER = ",".join(schemas.CSV_COLUMNS)

# What a posting says unless a test says otherwise; names as in the header.
POSTING = {
    "job_title_short": "Software Engineer", "job_title": "Backend, night shift", "job_location": "Porto, Norte",
    "job_via": "board", "job_schedule_type": "Contractor", "job_work_from_home": False, "search_location": "Iberia",
    "job_posted_date": dt.datetime(2024, 5, 6, 7, 8, 9), "job_no_degree_mention": False,
    "job_health_insurance": False, "job_country": "Portugal", "salary_rate": "hour", "salary_year_avg": None,
    "salary_hour_avg": 31.5, "company_name": "Cais Lda", "job_skills": "['rust']",
    "job_type_skills": "{'systems': ['rust']}",
}


def posting(**changes) -> tuple:
    """One typed posting."""
    return tuple({**POSTING, **changes}[c] for c in schemas.CSV_COLUMNS)


def fields(**changes) -> list:
    """The 17 field texts of a posting, by name."""
    def text(v):
        return "" if v is None else v if isinstance(v, str) else str(v)
    return [text({**POSTING, **changes}[c]) for c in schemas.CSV_COLUMNS]


def line(values=None, wrap=True, **changes) -> str:
    """A CSV line of ``values`` or of a posting; wrapped as a spreadsheet does it, whole line in quotes."""
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(fields(**changes) if values is None else values)
    return '"' + out.getvalue().replace('"', '""') + '"' if wrap else out.getvalue()


# Four postings of three companies at two places; worked expectations are beside the tests.
POSTINGS = [
    posting(job_title_short="Cloud Engineer", job_location="Tartu, Estonia", job_country="Estonia",
            company_name="Jarv OU", salary_year_avg=52000.4, salary_hour_avg=None, job_work_from_home=True,
            job_posted_date=dt.datetime(2024, 2, 28), job_skills="['go', 'terraform']",
            job_type_skills="{'languages': ['go'], 'infra': ['terraform']}"),
    posting(job_skills="['rust', 'go', 'nats']", job_type_skills="{'systems': ['rust', 'go'], 'infra': ['nats']}"),
    posting(job_title_short="Cloud Engineer", company_name="Aveiro SA", salary_year_avg=47000.0,
            job_health_insurance=True, job_posted_date=dt.datetime(2024, 3, 1, 23), job_skills="['terraform']",
            job_type_skills="{'infra': ['terraform']}"),
    posting(job_location="Tartu, Estonia", job_country="Estonia", company_name="Jarv OU", job_skills="[]",
            job_type_skills="{}", job_posted_date=dt.datetime(2024, 3, 1)),
]


def make_typed(spark, rows):
    """Typed frame with ``_row`` = 1..n (file order) and the parsed skill columns."""
    schema = "_row long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.TYPED_POSTING)
    return with_parsed_skills(spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], schema))


@pytest.fixture(scope="session")
def sample_df(spark):
    return make_typed(spark, POSTINGS)

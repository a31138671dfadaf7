"""starforge: job-ads CSV -> star schema and reports, as Spark DataFrame jobs.

    from starforge import get_spark, run, read_tables, reports
    counts = run(get_spark(), "hdfs:///landing/postings/", "hdfs:///warehouse/jobs")
    reports.top_skills(read_tables(get_spark(), "hdfs:///warehouse/jobs")).show()
"""

__version__ = "0.1.0"

from starforge.operators.ingest import HeaderError, Ingested, ingest, typed_from_raw  # noqa: E402,F401
from starforge.operators.quality import EmptyInputError, ValidationError  # noqa: E402,F401
from starforge.operators.star import Star, build_star  # noqa: E402,F401
from starforge.plans import reports  # noqa: E402,F401
from starforge.plans.run import run, summary  # noqa: E402,F401
from starforge.session import get_spark  # noqa: E402,F401
from starforge.sources.store import read_tables, save_tables  # noqa: E402,F401

__all__ = ["HeaderError", "Ingested", "ingest", "typed_from_raw", "EmptyInputError", "ValidationError",
           "Star", "build_star", "reports", "run", "summary", "get_spark", "read_tables", "save_tables"]

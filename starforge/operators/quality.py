"""V1-V6 validation rules and F9 emptiness guard.

All rules are evaluated in one pass; failures are gathered as rows
(column, check, failure_case, key) and the run fails as a whole.  During a
load the counts are observed on the write itself (no extra pass); the
failure rows are only computed when there are failures.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge import schemas

_GE0 = "greater_than_or_equal_to(0)"


class ValidationError(ValueError):
    def __init__(self, count: int, failures: DataFrame | None = None):
        super().__init__(f"{count} data-quality failures; nothing was loaded")
        self.count = count
        self.failures = failures


class EmptyInputError(ValueError):
    pass


def _rules() -> list:
    """(column, check, failed-condition, failure value) for every rule."""
    title = F.col("job_title_short")
    rules = [
        ("job_title_short", "isin", title.isNotNull() & ~title.isin(schemas.VALID_JOB_TITLES), title),
        ("job_title_short", "not_nullable", title.isNull(), F.lit(None).cast("string")),
    ]
    for c in schemas.BOOL_COLUMNS:
        rules.append((c, "not_nullable", F.col(c).isNull(), F.lit(None).cast("string")))
    for c in schemas.NUMBER_COLUMNS:
        # the failing value, shown to 6 decimals
        rules.append((c, _GE0, F.col(c) < 0, F.round(F.col(c), 6).cast("string")))
    return rules


def failure_count_columns() -> list:
    """Aggregate expressions (for ``observe``) counting failed checks."""
    n = sum((F.when(cond, 1).otherwise(0) for _, _, cond, _ in _rules()), F.lit(0))
    return [F.sum(n).alias("failures")]


def failures_of(df: DataFrame, key: str = "raw_id") -> DataFrame:
    """Every failed check as a row: column, check, failure_case, <key>."""
    items = [F.when(cond, F.struct(F.lit(col).alias("column"), F.lit(chk).alias("check"),
                                   val.alias("failure_case")))
             for col, chk, cond, val in _rules()]
    arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    return (df.select(F.col(key), F.explode(arr).alias("f"))
              .select("f.column", "f.check", "f.failure_case", key))


def require_rows(df: DataFrame | None) -> None:
    """refuse an empty or missing frame before anything is written."""
    if df is None or len(df.columns) == 0 or df.isEmpty():
        raise EmptyInputError(
            "no data to transform: the frame is empty (were all CSV rows rejected?)")



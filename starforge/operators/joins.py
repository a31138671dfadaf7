"""Joins with dimensions: broadcast only behind a check of the size in bytes, shuffle join beyond it."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension (bytes of its values) shipped to every executor; beyond it the join is a shuffle
# join with the same result.
BROADCAST_MAX_BYTES = 128 << 20


def value_bytes(df: DataFrame) -> int:
    """Bytes of all values of a materialized (cheap to scan) table."""
    width = sum((F.coalesce(F.octet_length(F.col(c)) if kind == "string" else F.lit(8), F.lit(0))
                 for c, kind in df.dtypes), F.lit(0))
    return int(df.agg(F.sum(width.cast("long"))).first()[0] or 0)


def fits_broadcast(df: DataFrame) -> bool:
    return value_bytes(df) <= BROADCAST_MAX_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def join_dimension(rows: DataFrame, dim: DataFrame, on: dict, spread: str) -> DataFrame:
    """Left join of ``rows`` with ``dim`` on ``on`` (row column -> dimension column).

    The first row column must not be null to match, the others match null-safely.  In
    the shuffle join rows that cannot match are spread by ``spread`` over all tasks
    instead of meeting in the one that a null key hashes to.
    """
    first, *others = on.items()
    safe = [rows[a].eqNullSafe(dim[b]) for a, b in others]
    key = rows[first[0]]
    if fits_broadcast(dim):
        dim = F.broadcast(dim)
    else:
        key = F.coalesce(key, F.concat(F.lit("\u0000"), rows[spread].cast("string")))
    condition = (key == dim[first[1]]) & rows[first[0]].isNotNull()
    for same in safe:
        condition = condition & same
    return rows.join(dim, condition, "left")

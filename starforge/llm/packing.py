"""Packing plans: which run of equally long pieces goes to which bins, and its application.

A piece's needs depend on its length alone, so the number of pieces of each length says
all there is to know about a packing problem.  The plan is made from that histogram (at
most ``capacity`` rows, whatever the corpus) and is as small; it is applied to the
pieces as a broadcast join on the length and the piece's place among equally long ones.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import with_global_index

RUN_SCHEMA = "length int, first long, n long, bin long, per_bin int, start long"


@dataclass
class Limits:
    """Capacities of one bin: tokens, documents, attention cost (sum of squared lengths)."""
    tokens: int
    documents: int
    attention: int


def vector_best_fit(histogram: dict[int, int], limits: Limits, rule: str = "norm",
                    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)) -> list[tuple]:
    """Runs (RUN_SCHEMA) packing ``histogram`` (length -> count), longest pieces first.

    Every step takes, among the kinds of open bins that can hold the piece under all three
    capacities, the one whose residual vector fits best: the smallest weighted norm of what
    would stay free (``norm``) or the smallest weighted dot product of the piece and what
    is free (``dot``).  Equal pieces keep filling the chosen bins while they fit, which is
    what placing them one by one would do.
    """
    cap = np.array([limits.tokens, limits.documents, limits.attention], float)
    w = np.array(weights)
    kinds: dict[tuple, int] = {}                  # (tokens, documents, attention) used -> row
    used = np.zeros((64, 3), np.int64)
    open_bins = np.zeros(64, np.int64)
    ranges: list[list[tuple[int, int]]] = []      # bins of each kind as (first, count)
    runs, bins = [], 0

    def add(kind: tuple, first: int, count: int) -> None:
        nonlocal used, open_bins
        row = kinds.get(kind)
        if row is None:
            row = kinds[kind] = len(ranges)
            if row == len(open_bins):
                used, open_bins = np.vstack([used, used * 0]), np.concatenate([open_bins, open_bins * 0])
            used[row] = kind
            ranges.append([])
        ranges[row].append((first, count))
        open_bins[row] += count

    def fits(kind, size: int) -> int:
        """How many pieces of this size a bin of this kind still takes."""
        return int(min((limits.tokens - kind[0]) // size, limits.documents - kind[1],
                       (limits.attention - kind[2]) // (size * size)))

    def place(size: int, done: int, count: int, kind: tuple, first: int, each: int) -> None:
        runs.append((size, done, count * each, first, each, int(kind[0])))
        add((int(kind[0]) + each * size, int(kind[1]) + each, int(kind[2]) + each * size * size), first, count)

    for size in sorted(histogram, reverse=True):
        left, done = int(histogram[size]), 0
        piece = np.array([size, 1, size * size], float) / cap
        while left:
            rest = (np.array(cap, np.int64) - used[:len(ranges)])
            ok = np.flatnonzero((open_bins[:len(ranges)] > 0) & (rest >= [size, 1, size * size]).all(axis=1))
            if len(ok):
                free = rest[ok] / cap
                score = ((free - piece) ** 2 * w).sum(1) if rule == "norm" else (free * piece * w).sum(1)
                row = int(ok[np.argmin(score)])
                kind = tuple(int(v) for v in used[row])
                first, count = ranges[row].pop()
                open_bins[row] -= count
                each = min(fits(kind, size), left)
                take = min(count, left // each)
                if take < count:
                    add(kind, first + take, count - take)
            else:
                kind, each = (0, 0, 0), min(fits((0, 0, 0), size), left)
                if each < 1:
                    raise ValueError(f"a piece of {size} tokens exceeds the capacities {limits}")
                take, first = left // each, bins
                bins += take
            place(size, done, take, kind, first, each)
            left, done = left - take * each, done + take * each
    return runs


def apply_plan(pieces: DataFrame, runs: list[tuple], order_cols: list, name: str) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged ``pieces`` (with an int ``length``).

    The place of a piece among equally long ones comes from a distributed sort by length and
    ``order_cols``.
    """
    spark = pieces.sparkSession
    ranked = with_global_index(pieces, ["length", *order_cols], "_index", name)
    starts, total = {}, 0
    sizes: dict[int, int] = {}
    for size, _, n, *_ in runs:
        sizes[size] = sizes.get(size, 0) + n
    for size in sorted(sizes):
        starts[size] = total
        total += sizes[size]
    plan = spark.createDataFrame([(s, starts[s] + first, n, b, each, start) for s, first, n, b, each, start in runs],
                                 RUN_SCHEMA).withColumnsRenamed({"length": "_length", "start": "_start"})
    i = F.col("_index") - F.col("first")
    return (ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (i >= 0) & (i < F.col("n")))
                  .withColumn("sequence_id", F.col("bin") + F.expr("(_index - first) div per_bin"))
                  .withColumn("offset", (F.col("_start") + (i % F.col("per_bin")) * F.col("length")).cast("long"))
                  .drop("_index", "_length", "first", "n", "bin", "per_bin", "_start"))

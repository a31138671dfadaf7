"""Embedding near-duplicates through a pivot-permutation index.

Pivots are vectors of a sample, each less similar than ``SPREAD`` to those before it, so that a
dense group is seen by one pivot near it and many at a distance, in a stable order.  Every distinct vector is described by the ordered list of
its ``PREFIX`` nearest pivots and entered in the inverted list of each of them.  Two vectors of
one list are candidates if their descriptions share at least ``SHARED`` pivots, and are verified by
cosine in double precision.  A pair that meets in several lists counts in the list of its
smallest shared pivot only.

Long lists are cut into blocks, and every pair of blocks is one task's work, so a pivot that
attracts a third of all vectors is spread over many tasks.  A task returns, per vector, how many
links it found and the smallest vector of its local component: never the pairs.

Equal vectors are collapsed before indexing and counted by multiplicity, so copies cost one entry.

The number of pivots grows with the square root of the number of vectors up to
``MAX_PIVOTS`` (the documented bound of the sample the index is fitted on); every vector is indexed.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing
(n_links 0, component their own id, kept); vectors of different lengths never link; rows of one
id are one vector each in ``n_links`` and one node in components; rows without an id count as
partners but have no component (null, kept); an empty table gives an empty result; other columns
of the input are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import staged
from starforge.llm.components import components

THRESHOLD = 0.95
PREFIX = 8
SHARED = 2
MAX_PIVOTS = 4096
SPREAD = 0.6
BLOCK = 512


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, raw): the vector as little-endian doubles, null if it can link with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, float) if v and None not in v else np.zeros(0)
                raw.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["vec_id", "raw"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v")) \
        .mapInArrow(run, "vec_id long, raw binary")


def unit(raw: list) -> np.ndarray:
    """Rows of equal length scaled to norm 1; scaled by the largest component first, against overflow."""
    x = np.stack([np.frombuffer(r, "<f8") for r in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def describe(nodes: DataFrame, pivots: dict[int, np.ndarray], prefix: int) -> DataFrame:
    """(pivot, node, copies, raw, nearest) for each of a vector's nearest pivots, nearest first."""
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            nearest: list = [None] * len(raw)
            sizes = np.array([len(r) for r in raw])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                p = shared.value.get(int(size))
                if p is None:
                    continue
                for at in range(0, len(rows), 1024):
                    part = rows[at:at + 1024]
                    cosine = unit([raw[i] for i in part]) @ p.T
                    for i, order in zip(part, np.argsort(-cosine, axis=1, kind="stable")[:, :prefix]):
                        nearest[i] = order.astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.list_(pa.int32()))],
                                             ["node", "copies", "raw", "nearest"])

    return nodes.select("node", "copies", "raw").mapInArrow(
        run, "node long, copies long, raw binary, nearest array<int>")


def block_links(rows: pd.DataFrame, threshold: float, shared: int) -> pd.DataFrame:
    """(node, links, root) of the vectors of one block pair of one inverted list."""
    pivot, low, high = rows["pivot"].iloc[0], rows["lo"].iloc[0], rows["hi"].iloc[0]
    node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
    x, near = unit(rows["raw"].to_list()), np.stack(rows["nearest"].to_numpy())
    block = rows["block"].to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    links = np.zeros(len(rows), np.int64)
    root = np.arange(len(rows))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, len(left), 128):
        a = left[at:at + 128]
        count = np.zeros((len(a), len(right)), np.int16)
        smallest = np.full((len(a), len(right)), np.iinfo(np.int32).max, np.int32)
        for k in range(near.shape[1]):
            p = near[a, k][:, None]
            hit = (near[right][:, None, :] == p[None, :, :]).any(axis=2).T
            count += hit
            smallest = np.where(hit, np.minimum(smallest, p), smallest)
        pair = (count >= min(shared, near.shape[1])) & (smallest == pivot)
        if low == high:
            pair &= a[:, None] < right[None, :]
        i, j = np.nonzero(pair)
        i, j = a[i], right[j]
        for part in range(0, len(i), 50_000):
            s, t = i[part:part + 50_000], j[part:part + 50_000]
            ok = np.einsum("ij,ij->i", x[s], x[t]) >= threshold
            s, t = s[ok], t[ok]
            np.add.at(links, s, copies[t])
            np.add.at(links, t, copies[s])
            for u, v in zip(s, t):
                u, v = find(u), find(v)
                root[max(u, v)] = min(u, v)
    linked = np.flatnonzero(links)
    return pd.DataFrame({"node": node[linked], "links": links[linked], "root": node[[find(i) for i in linked]]})


def fit_pivots(nodes: DataFrame, n: int, max_pivots: int) -> dict[int, np.ndarray]:
    """Unit pivots by vector length (in bytes): a sample of at most about ``max_pivots`` vectors."""
    want = min(max_pivots, max(32, math.ceil(4 * math.sqrt(n))))
    u = F.pmod(F.xxhash64("raw"), F.lit(1_000_000)) / 1_000_000
    chosen = nodes.where(u < min(1.0, want / max(n, 1))).select("raw")
    lengths = [r["size"] for r in nodes.select(F.octet_length("raw").alias("size")).distinct().collect()]
    raws = sorted(bytes(r["raw"]) for r in chosen.collect())
    # every length has a pivot, so that every vector is indexed
    for size in sorted(lengths):
        if not any(len(r) == size for r in raws):
            raws.append(bytes(nodes.where(F.octet_length("raw") == size).agg(F.min("raw")).first()[0]))
    return {size: spread_out(unit([r for r in raws if len(r) == size])) for size in sorted(lengths)}


def spread_out(pivots: np.ndarray, limit: float = SPREAD) -> np.ndarray:
    """Those of ``pivots`` whose cosine with every earlier kept one is below ``limit``."""
    kept: list[int] = []
    for i in range(len(pivots)):
        if not kept or (pivots[kept] @ pivots[i]).max() < limit:
            kept.append(i)
    return pivots[kept]


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, prefix: int = PREFIX,
                           shared: int = SHARED, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding)."""
    table = staged(usable(vectors), "vectors")
    # a node is a distinct vector, named by a hash of its bytes
    nodes = staged(table.where("raw is not null").groupBy("raw")
                   .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("smallest"))
                   .withColumn("node", F.xxhash64("raw")), "vector-nodes")
    n = nodes.count()
    links = None
    if n:
        index = staged(describe(nodes, fit_pivots(nodes, n, max_pivots), prefix), "pivot-index")
        lists = index.withColumn("pivot", F.explode("nearest")) \
            .withColumn("size", F.octet_length("raw"))
        sizes = lists.groupBy("size", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        spread = lists.join(sizes, ["size", "pivot"]) \
            .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
            .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")) \
            .select("size", "pivot", "lo", "hi", "block", "node", "copies", "raw", "nearest") \
            .repartition("size", "pivot", "lo", "hi")  # else a list's block pairs stay in the join's one task
        links = staged(spread.groupBy("size", "pivot", "lo", "hi").applyInPandas(
            lambda rows: block_links(rows, threshold, shared), "node long, links long, root long"), "vector-links")
    counted = nodes.select("raw", "node", "copies", "smallest")
    if links is None:
        return table.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")) \
            .withColumn("kept", F.lit(True))
    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select("node", "root"), "node", "root").distinct()
    counted = counted.join(totals, "node", "left").join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node")) \
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    # a component is named by its smallest id
    names = counted.groupBy("root").agg(F.min("smallest").alias("component"))
    found = staged(counted.join(names, "root").select("raw", "links", "component"), "vector-components")
    out = table.join(found, "raw", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id")))

"""Proportional stratified interleaving: shards that all hold the corpus's mixture.

Rows are shuffled by a seeded hash inside each source; the row of rank r among the n
rows of its source gets the fractional rank (r + 1/2) / n.  Sorting all rows by
fractional rank interleaves the sources in proportion, and cutting that order into
equal runs gives shards whose share of every source matches the whole within one row,
with row counts at most one apart.

Both rankings are distributed range sorts of narrow rows (no text is moved), so a
source holding a third of all rows is spread over many tasks.

Defined results: a null source is a source of its own; null text has size 8 and
checksum 0; repeated rows are each placed; a null id is placed like any other; an empty
table gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import staged, with_global_index


def interleave(docs: DataFrame, key_cols: list[Column], source: Column, carry: dict[str, Column],
               shards: int, seed: int = 17) -> DataFrame:
    """Shard every row of ``docs``: columns of ``carry`` plus ``shard`` and ``slot``.

    ``key_cols`` seed the shuffle; ``source`` names the stratum.  ``slot`` is gapless from 0
    in each shard and follows the interleaved order.
    """
    base = staged(docs.select(
        *[c.alias(n) for n, c in carry.items()],
        source.cast("string").alias("_source"),
        F.xxhash64(F.lit(seed), *key_cols).alias("_h")), "shard-rows")
    # null sources sort first and are matched null-safely below
    ranked = with_global_index(base, ["_source", "_h", *carry], "_rank", "shard-ranked")
    strata = ranked.groupBy("_source").agg(F.count(F.lit(1)).alias("_n"), F.min("_rank").alias("_first"))
    strata = strata.withColumnRenamed("_source", "_stratum")
    placed = (ranked.join(strata, F.col("_source").eqNullSafe(F.col("_stratum")))
                    .withColumn("_frac", (F.col("_rank") - F.col("_first") + 0.5) / F.col("_n"))
                    .select(*carry, "_frac", "_h"))
    ordered = with_global_index(staged(placed, "shard-fractions"), ["_frac", "_h", *carry], "_pos", "shard-order")
    n = base.count()
    shard = F.expr(f"cast((_pos * {shards}) div {max(n, 1)} as int)")
    # first position of a shard: the smallest p with p * shards >= shard * n
    first = F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}")
    return (ordered.withColumn("shard", shard)
                   .withColumn("slot", (F.col("_pos") - first).cast("long"))
                   .select(*carry, "shard", "slot"))


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 17) -> DataFrame:
    """The ``rows`` law over documents (doc_id, text, source): counts at most one apart."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    out = interleave(docs, [F.col("doc_id")], F.col("source"), {
        "doc_id": F.col("doc_id"),
        "size": (F.octet_length(text) + 8).cast("long"),
        "text_crc32": F.crc32(text),
    }, shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

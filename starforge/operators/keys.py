"""Deterministic surrogate keys without a one-task sort or window.

``dense_key`` numbers unique keys 1..n in sort order:

1. range-partition + sort within partitions (the sort is distributed),
2. tag every row with ``monotonically_increasing_id()`` — its upper 31 bits are
   the partition index, its lower 33 bits the row's position in the partition,
3. checkpoint, so the sampled range bounds and positions are fixed even if an
   executor is lost and work is recomputed,
4. count rows per partition (one row per partition, fetched to the driver:
   bounded by the partition count) and join the running offsets back as a
   broadcast of that size — no single-task window.

``exclusive_prefix_sum`` uses the same layout for running sums over a
(small) table ordered by some columns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starforge.session import checkpoint_root

POS_BITS = 33  # layout of monotonically_increasing_id()


def partition_of(pos: Column) -> Column:
    """Partition index encoded in a monotonically_increasing_id() value."""
    return F.shiftrightunsigned(pos, POS_BITS)


def row_in_partition(pos: Column) -> Column:
    return pos - F.shiftleft(partition_of(pos), POS_BITS)


def dense_key(df: DataFrame, order_cols: list, id_col: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = 1..n following ``order_cols`` (which must be unique)."""
    spark = df.sparkSession
    checkpoint_root(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, *order_cols)
                 .sortWithinPartitions(*order_cols)
                 .withColumn("_pos", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    # One (partition, count) pair per partition: bounded metadata, fetched to the driver and
    # joined back as a table of that size.
    counts = ordered.groupBy(partition_of(F.col("_pos")).alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, run = [], 0
    for part, n in sorted((r["_part"], r["_n"]) for r in counts):
        offsets.append((part, run))
        run += n
    table = spark.createDataFrame(offsets, "_part long, _off long")
    return (ordered.withColumn("_part", partition_of(F.col("_pos")))
                   .join(F.broadcast(table), "_part")
                   .withColumn(id_col, (F.col("_off") + row_in_partition(F.col("_pos")) + 1).cast("long"))
                   .drop("_pos", "_part", "_off"))


PREFIX_ROWS_PER_PARTITION = 100_000


def exclusive_prefix_sum(df: DataFrame, order_cols: list, value_cols: list, prefix: str = "_before",
                         num_partitions: int | None = None) -> DataFrame:
    """For every value column ``v`` add ``{prefix}{v}``: the sum of ``v`` over all rows
    that come earlier in ``order_cols`` (0 for the first row).

    Distributed: range partition + checkpoint, a window inside each range
    partition, and the per-partition totals (one row per partition, fetched to
    the driver) joined back as a broadcast of that size.  Partitions hold about
    ``PREFIX_ROWS_PER_PARTITION`` rows; a table that fits in one uses a single
    window.
    """
    spark = df.sparkSession
    if num_partitions is None:
        # meant for small, materialized tables: counting them is cheap
        rows = df.count()
        num_partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                             max(1, -(-rows // PREFIX_ROWS_PER_PARTITION)))
    if num_partitions == 1:
        # fits one partition: one window, nothing sampled, nothing to checkpoint
        w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).cast("long").alias(f"{prefix}{v}")
                                for v in value_cols])
    checkpoint_root(spark)
    n = num_partitions
    ordered = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                 .withColumn("_pp", F.spark_partition_id()))
    ordered = ordered.checkpoint(eager=True)
    totals = {r["_pp"]: r for r in ordered.groupBy("_pp").agg(
        *[F.sum(v).alias(v) for v in value_cols]).collect()}
    offsets, run = [], [0] * len(value_cols)
    for part in sorted(totals):
        offsets.append((part, *run))
        run = [r + int(totals[part][v] or 0) for r, v in zip(run, value_cols)]
    table = spark.createDataFrame(offsets, "_pp int, " + ", ".join(f"_off{i} long" for i in range(len(value_cols))))
    w = Window.partitionBy("_pp").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    out = ordered.join(F.broadcast(table), "_pp")
    for i, v in enumerate(value_cols):
        out = out.withColumn(f"{prefix}{v}", (F.col(f"_off{i}") + F.coalesce(F.sum(v).over(w), F.lit(0))).cast("long"))
    return out.drop("_pp", *[f"_off{i}" for i in range(len(value_cols))])

"""Helpers shared by the text operators: staged tables, distributed ranks, word hashes."""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.operators.keys import partition_of, row_in_partition
from starforge.session import scratch_path

WORD = re.compile(r"\w+")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs only its running tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_global_index(df: DataFrame, order_cols: list, index_col: str, name: str) -> DataFrame:
    """Add ``index_col`` = 0..n-1 in the order of ``order_cols``; staged.

    A range partitioning sorts in parallel; each row is tagged with its partition
    and its place in it, and the row counts per partition (one row each, bounded
    by the number of partitions) give the offsets.  Rows equal in all of
    ``order_cols`` get distinct indexes in any order.  The input is read twice (once
    to sample the ranges), so expensive inputs should be staged first.
    """
    spark = df.sparkSession
    tagged = staged(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                      .withColumn("_mid", F.monotonically_increasing_id()), name)
    counts = tagged.groupBy(partition_of(F.col("_mid")).cast("long").alias("_part")).count().collect()
    offsets, run = [], 0
    for part, n in sorted((r["_part"], r["count"]) for r in counts):
        offsets.append((part, run))
        run += n
    table = spark.createDataFrame(offsets, "_part long, _offset long")
    return (tagged.withColumn("_part", partition_of(F.col("_mid")).cast("long"))
                  .join(F.broadcast(table), "_part", "left")
                  .withColumn(index_col, F.col("_offset") + row_in_partition(F.col("_mid")))
                  .drop("_part", "_mid", "_offset"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a fast, well-mixed 64-bit hash of 64-bit integers."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered for words seen; forgets all past ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def hash_words(words: list, cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))

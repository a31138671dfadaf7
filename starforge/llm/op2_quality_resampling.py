"""Importance resampling by hashed n-grams: texts that look like the target corpus.

Words and word pairs of a text (punctuation runs are words) are hashed into
``BUCKETS``.  Two generative models, bucket frequencies of the target texts and of all raw
texts, give every text the log of its importance: the log-likelihood ratio of its n-grams.
Texts are then sampled without replacement by the Gumbel top-k trick: log-importance
plus Gumbel noise drawn from a hash of the id, the ``keep_share`` largest keys are kept.

The ratio is that of the whole text (``weigh='sum'``).  With ``weigh='mean'`` a text counts as if it had
``SAMPLE_NGRAMS`` n-grams of its mean ratio, so that length neither helps nor hurts; that is another
distribution than the resampled one.

The raw model counts every n-gram of every text, the target model every n-gram of every labelled target
row.  The k of top-k is a share of all rows; ranks come from a distributed sort of (id, key).

Defined results: a text without n-grams (null, empty, white space) has no importance: its
log_weight is null, its score 0, and it ranks last; without target rows all ratios are 0; repeated
rows and null ids are scored and ranked like others, equal keys in order of id; an empty table
gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import WordHashes, hash_words, id_remainder, mix64, staged, with_global_index
from starforge.operators.joins import broadcast_if_small

BUCKETS = 1 << 14
SAMPLE_NGRAMS = 100
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def buckets_of(text: str | None, cache: WordHashes) -> np.ndarray:
    """Buckets of a text's words and word pairs, whole."""
    words = _TOKEN.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.int64)
    one = hash_words(words, cache)
    two = mix64(one[:-1] * _PAIR + one[1:])
    return (np.concatenate([one, two]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all of ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, total = WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0).to_pylist():
                held.append(buckets_of(text, cache))
                size += len(held[-1])
                if size > 500_000:
                    total += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["b", "n"])

    rows = texts.select(F.col("text").cast("string")).mapInArrow(count, "b int, n long") \
        .groupBy("b").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS rows
    out = np.zeros(BUCKETS)
    for r in rows:
        out[r["b"]] = r["n"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, prior: float = 1.0) -> np.ndarray:
    """log p_target / p_raw of every bucket; the target is smoothed towards the raw model."""
    if not target.sum() or not raw.sum():
        return np.zeros(BUCKETS)
    p_raw = (raw + prior) / (raw + prior).sum()
    strength = prior * BUCKETS
    p_target = (target + strength * p_raw) / (target.sum() + strength)
    return np.log(p_target / p_raw)


def importance(docs: DataFrame, ratios: np.ndarray, columns: list[str], weigh: str = "sum") -> DataFrame:
    """``columns`` of every row of ``docs`` with ``log_weight`` (null without n-grams)."""
    schema = docs.select(*columns).schema.add("log_weight", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            out = []
            for text in batch.column(len(columns)).to_pylist():
                b = buckets_of(text, cache)
                scale = 1.0 if weigh == "sum" else SAMPLE_NGRAMS / max(len(b), 1)
                out.append(float(ratios[b].sum()) * scale if len(b) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array(out, pa.float64())],
                                             [f.name for f in schema])

    return docs.select(*columns, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def resample(docs: DataFrame, target_ids: DataFrame, keep_share: float, weigh: str = "sum", seed: int = 23) -> DataFrame:
    """(doc_id, log_weight, score, key, selected) for every row of ``docs`` (doc_id, text).

    ``target_ids`` (doc_id) names rows of the target corpus.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    target = target_ids.select(F.col("doc_id").cast("long").alias("_id")).where("_id is not null").distinct()
    target = broadcast_if_small(staged(target, "target-ids"))
    ratios = log_ratios(bucket_counts(docs.join(target, docs["doc_id"] == F.col("_id"), "left_semi")),
                        bucket_counts(docs))
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) + 0.5) / F.lit(2.0 ** 53)
    keyed = staged(importance(docs, ratios, ["doc_id"], weigh)
                   .withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))), "quality-keys")
    k = round(keep_share * keyed.count())
    ranked = with_global_index(keyed.withColumn("_last", -F.coalesce(F.col("key"), F.lit(float("-inf")))),
                               ["_last", "doc_id"], "_rank", "quality-ranked")
    score = F.coalesce(1 / (1 + F.exp(-F.col("log_weight"))), F.lit(0.0))
    return ranked.select("doc_id", "log_weight", score.alias("score"), "key", (F.col("_rank") < k).alias("selected"))


def resample_labelled(docs: DataFrame, labels: DataFrame, margin: float = 0.02, held_out: int = 0,
                      modulus: int = 5, weigh: str = "sum") -> DataFrame:
    """Target: rows labelled good quality outside the held-out fold.

    The kept share is the share of good rows among those labels plus ``margin``, so that noise
    near the cut costs a poor text its place rather than a good one.
    """
    known = labels.where((id_remainder(F.col("doc_id"), modulus) != held_out) & F.col("quality").isin(0, 1))
    share = known.agg(F.avg("quality")).first()[0]
    keep = 1.0 if share is None else min(1.0, share + margin)
    return resample(docs, known.where("quality = 1"), keep, weigh) \
        .withColumn("held_out", id_remainder(F.col("doc_id"), modulus) == held_out)

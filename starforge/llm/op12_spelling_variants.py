"""Spelling variants of a corpus's words, by generation over a reduced alphabet.

**Words.** Maximal runs of letters of all texts are counted; the counting is a hash aggregation
with partial sums, so a frequent word costs no task more than one row of each other.

**Near pairs.** Letters are hashed to a few symbols, which shortens the alphabet and keeps edits: two
words at one edit have reduced words that are equal or at one edit.  The number of symbols is the root of the
vocabulary's size of the order of the shortest word (``symbols_for``), so that there are at least as many reduced words as
words and a neighbour meets few words however large the vocabulary; the result does not depend on it.  Every word generates the
full one-edit neighbourhood of its reduced word (itself, deletions, replacements, insertions), as
64-bit polynomial hashes that an edit changes in constant time.  The neighbourhoods are joined with
the reduced words of the whole vocabulary, and each match is verified on the original strings.  A
word has one reduced word, so every near pair is found once from each side.  A reduced word that more
than ``HOT`` words share is dealt into parts by the word's hash, and the neighbours that meet it go
to all its parts.

**Forms.** A word's form is its near word with the largest count, if that is at least ``ratio`` times its
own.  Counts grow along forms, so following them ends; roots are found by pointer doubling, one
join a round, in as many rounds as the logarithm of the longest chain.

Defined results: null texts and texts without letters give no words; a null id counts as empty in the
hash of a run; rows of one id count as they are; ties go to the word that is first in code-point order; an
empty table gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import mix64, staged
from starforge.operators.joins import broadcast_if_small

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_SYMBOLS = 4
# Words of one reduced word in one part of the join.
HOT = 1024
# Numbers of a batch of neighbourhoods.
_CELLS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)
_LENGTH = 0xC2B2AE3D27D4EB4F


def letter_runs(docs: DataFrame, min_length: int) -> DataFrame:
    """(doc_id, run): maximal letter runs of at least ``min_length``, A to Z in lower case."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                       F.explode(F.regexp_extract_all(F.col("text").cast("string"),
                                                      F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run"))
    return runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER))
                           .otherwise(F.col("run")))


def misspelled(doc_id: Column, run: Column, every: int) -> Column:
    """``run`` without one of its letters where ``every`` divides the hash of document and run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.left(run, at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, every: int = 199) -> DataFrame:
    """(word, n): the words of all texts with their numbers of occurrences."""
    words = letter_runs(docs, min_length).select(misspelled(F.col("doc_id"), F.col("run"), every).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") >= min_count))


def symbols_of(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Letters (code points) as symbols 1 to ``symbols``."""
    return mix64(codes.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)


def symbols_for(words: int, min_length: int) -> int:
    """Symbols with which the reduced words of the least length are as many as ``words``."""
    symbols = LEAST_SYMBOLS
    while symbols ** min_length < words:
        symbols += 1
    return symbols


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _key(polynomial: np.ndarray, length: int) -> np.ndarray:
    return mix64(polynomial + np.uint64(length * _LENGTH % 2 ** 64))


def reduced_keys(words: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of the reduced words of ``words``, an (m, length) array of code points."""
    length = words.shape[1]
    return _key((symbols_of(words, symbols) * _powers(length)).sum(axis=1, dtype=np.uint64), length)


def neighbour_keys(words: np.ndarray, symbols: int) -> np.ndarray:
    """(m, k) keys of the full one-edit neighbourhoods of the reduced words of ``words``; with repeats."""
    m, length = words.shape
    s, power = symbols_of(words, symbols), _powers(length + 1)
    terms = s * power[:length]
    before = np.zeros((m, length + 1), np.uint64)           # sum of the terms before a place
    before[:, 1:] = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = before[:, -1:]
    after = whole - before                                  # sum of the terms from a place on
    others = np.arange(1, symbols + 1, dtype=np.uint64)
    replaced = whole[:, :, None] + (others - s[:, :, None]) * power[:length, None]
    deleted = before[:, :-1] + after[:, 1:] * np.uint64(_INVERSE)
    inserted = (before + after * np.uint64(_BASE))[:, :, None] + others * power[:, None]
    # the replacement of a symbol by itself is the reduced word
    return np.concatenate([_key(replaced.reshape(m, -1), length), _key(deleted, length - 1),
                           _key(inserted.reshape(m, -1), length + 1)], axis=1)


def _by_length(words: list[str], cells: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words of equal length together: their places and code points, at most about ``cells`` of these at a time."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for length, same in by.items():
        step = max(1, cells // (length + 1))
        for at in range(0, len(same), step):
            rows = same[at:at + step]
            codes = np.frombuffer("".join(words[i] for i in rows).encode("utf-32-le"), "<u4")
            yield pa.array(rows, pa.int64()), codes.reshape(len(rows), length)


def with_reduced_key(words: DataFrame, symbols: int) -> DataFrame:
    """(id, word, n, key) of the vocabulary ``words`` (id, word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, codes in _by_length(batch.column(1).to_pylist(), _CELLS):
                keys = pa.array(reduced_keys(codes, symbols).view(np.int64))
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), keys], ["id", "word", "n", "key"])

    return words.select("id", "word", "n").mapInArrow(run, "id long, word string, n long, key long")


def with_neighbours(words: DataFrame, symbols: int) -> DataFrame:
    """(id, key) of the neighbourhoods of ``words`` (id, word), every key once a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, codes in _by_length(batch.column(1).to_pylist(), _CELLS // (2 * symbols + 1)):
                keys = np.sort(neighbour_keys(codes, symbols), axis=1)
                new = np.ones(keys.shape, bool)
                new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                owner = np.repeat(np.asarray(rows), new.sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), pa.array(keys[new].view(np.int64))], ["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id long, key long")


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(id, near, near_n): the words at exactly one edit from each of ``words`` (id, word, n), from both sides."""
    vocabulary = staged(with_reduced_key(words, symbols), "reduced-words")
    hot = vocabulary.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / HOT).cast("int").alias("parts")).where("parts > 1")
    hot = broadcast_if_small(staged(hot, "hot-reduced-words"))
    parts = F.coalesce("parts", F.lit(1))
    held = (vocabulary.join(hot, "key", "left")
                      .select("key", F.pmod(F.xxhash64("word"), parts).cast("int").alias("part"),
                              F.col("word").alias("near"), F.col("n").alias("near_n")))
    asked = (with_neighbours(words, symbols).join(hot, "key", "left")
             .select("key", "id", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")))
    found = asked.join(held, ["key", "part"]).select("id", "near", "near_n")
    return (found.join(words.select("id", "word"), "id").where(F.levenshtein("word", "near", 1) == 1)
                 .select("id", "near", "near_n"))


def followed(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from every word of ``forms`` (word, form)."""
    up = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = up.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        more = staged(up.join(step, up["root"] == step["_w"], "left")
                        .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")),
                      "roots")
        up = more.drop("_moved")
        if not more.where("_moved").take(1):
            return up


def group_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, every: int = 199, ratio: int = 5,
                   symbols: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of ``docs`` (doc_id, text) with its form and root."""
    counts = staged(word_counts(docs, min_length, min_count, every)
                    .withColumn("id", F.monotonically_increasing_id()), "word-counts")
    symbols = symbols or symbols_for(counts.count(), max(min_length, 1))
    best = near_pairs(counts, symbols).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_n"), "near")).alias("_best"))
    form_n = -F.col("_best._n")
    words = staged(counts.join(best, "id", "left")
                   .withColumn("_close", form_n >= ratio * F.col("n"))
                   .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(F.col("_close"), F.col("_best.near")).alias("form"),
                           F.when(F.col("_close"), form_n).alias("form_n")), "words")
    roots = followed(words.where("form is not null"))
    return (words.join(roots, "word", "left")
                 .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))

"""Bounded memory on repeated phrases and open rows, and orders recomputed by brute force."""
import random
import time
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starforge.llm import op2_quality_resampling as quality
from starforge.llm import op9_decontamination as leaks
from starforge.llm.op5_sharding import shard_documents
from starforge.llm.op8_token_output import CapacityTree, pack_rows, packed_rows, read_segments

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# ---- 9: repeated phrases ----------------------------------------------------

@pytest.mark.parametrize("phrase", ["ha ", "once upon a time ", "x"])
def test_halves_find_what_the_whole_finds(monkeypatch, phrase):
    rng = random.Random(3)
    items = [(1, phrase * (300 // len(phrase))), (2, " ".join(f"w{rng.randrange(99)}" for _ in range(60)))]
    index = leaks.Index.of(items)
    texts = [phrase * (4000 // len(phrase)), items[1][1] + " tail " + phrase * 40 + items[1][1], "nothing " * 300, "", None]
    whole = sorted(leaks.text_matches(index, texts))
    monkeypatch.setattr(leaks, "PAIRS", 2000)
    halves = sorted(leaks.text_matches(index, texts))
    # the same segments with the same edits; of equally good places another may come first
    assert [(i, m[:2], m[4]) for i, m in halves] == [(i, m[:2], m[4]) for i, m in whole]
    assert {i for i, _ in whole} == {0, 1}


def test_a_long_repeated_phrase_takes_bounded_lists(monkeypatch):
    """No list of equal q-grams exceeds the bound, however long the text."""
    index = leaks.Index.of([(1, "ha " * 100)])
    text = "ha " * 12_000
    sizes, real = [], leaks.Index.shared

    def shared(self, points, hits):
        sizes.append(int(hits[2].sum()))
        return real(self, points, hits)
    monkeypatch.setattr(leaks.Index, "shared", shared)
    start = time.time()
    found = list(leaks.text_matches(index, [text]))
    assert found and {m[4] for _, m in found} == {0} and max(sizes) <= leaks.PAIRS and len(sizes) > 4
    assert time.time() - start < 300


def test_a_benchmark_of_several_blocks(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(40))) for i in range(40)]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in items] + [(99, "clean text " * 30)], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = leaks.matches(docs, benchmark).collect()
    many = leaks.matches(docs, benchmark, block_chars=2000).collect()
    assert len(list(leaks.benchmark_blocks(benchmark, 2000))) > 3
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and {r["doc_id"] for r in one} == set(range(40))


# ---- 8: open rows -----------------------------------------------------------

def test_open_rows_are_bounded_and_nothing_is_lost(spark):
    """Documents of three quarters of a row never fill one; with few open rows allowed, all ids still come out."""
    docs = spark.createDataFrame([(i, f"tok{i} " + "a b " * 23) for i in range(400)], "doc_id long, text string").repartition(1)
    rows = packed_rows(docs, RANKS, PATTERN, capacity=64, buffer_tokens=1000, open_rows=5)
    segments = read_segments(rows)
    want = packed_rows(docs, RANKS, PATTERN, capacity=64)
    assert sorted(map(tuple, segments.collect())) == sorted(map(tuple, read_segments(want).collect()))
    assert rows.agg(F.max("n_tokens")).first()[0] <= 64


def test_pack_rows_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(50):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 60))]
        tree = CapacityTree(30)
        full = list(pack_rows([(i, 0, [0] * n) for i, n in enumerate(sizes)], 30, tree))
        rows = full + [r for rs in tree.rows for r in rs]
        got = sorted(sorted(len(p[2]) for p in row) for row in rows)
        bins = []
        for n in sorted(sizes, reverse=True):
            fits = [b for b in bins if sum(b) + n <= 30]
            if fits:
                max(fits, key=sum).append(n)
            else:
                bins.append([n])
        # rows of one residual are interchangeable: as many rows, as full
        assert sorted(map(sum, got)) == sorted(map(sum, bins))


# ---- 5: the interleaved order -----------------------------------------------

def test_shards_follow_the_fractional_ranks(spark, corpus):
    docs, shards = corpus[0], 7
    rows = docs.select("doc_id", "source", F.xxhash64(F.lit(17), "doc_id").alias("h"),
                       F.crc32(F.col("text").cast("binary")).alias("crc"), F.octet_length("text").alias("size")).collect()
    strata = defaultdict(list)
    for r in rows:
        strata[r["source"]].append(r)
    order = []
    for members in strata.values():
        members.sort(key=lambda r: r["h"])
        order += [((k + 0.5) / len(members), r["h"], r["doc_id"]) for k, r in enumerate(members)]
    order.sort()
    got = shard_documents(docs, shards).orderBy("shard", "slot").collect()
    assert [r["doc_id"] for r in got] == [d for _, _, d in order]
    assert [r["shard"] for r in got] == [i * shards // len(order) for i in range(len(order))]


# ---- 2: Gumbel top-k --------------------------------------------------------

def test_top_k_of_the_gumbel_keys(spark):
    """Keys and selection recomputed; equal texts differ by their noise alone, equal keys go by id."""
    rng = random.Random(7)
    docs = [(i, "good words here" if i % 5 == 0 else " ".join(rng.choice(["a", "b", "good", "words"]) for _ in range(9)))
            for i in range(120)] + [(None, "good words here"), (500, None), (3, "a b"), (3, "a b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 120, 10)], "doc_id long")
    rows = quality.resample(frame, target, 0.4).collect()
    hashes = {r["doc_id"]: r["h"] for r in frame.select("doc_id", F.xxhash64(F.lit(23), "doc_id").alias("h")).distinct().collect()}
    for r in rows:
        if r["log_weight"] is None:
            assert r["key"] is None and not r["selected"] and r["score"] == 0
            continue
        u = (((hashes[r["doc_id"]] % 2 ** 64) >> 11) + 0.5) / 2 ** 53
        assert r["key"] == pytest.approx(r["log_weight"] - np.log(-np.log(u)))
    k = round(0.4 * len(rows))
    ranked = sorted(rows, key=lambda r: (-(r["key"] if r["key"] is not None else -np.inf), r["doc_id"] is not None, r["doc_id"] or 0))
    assert sum(r["selected"] for r in rows) == k
    assert sorted(r["key"] for r in rows if r["selected"]) == sorted(r["key"] for r in ranked[:k])


def test_mean_weighing_ignores_length(spark):
    docs = spark.createDataFrame([(1, "x y"), (2, "x y " * 50), (3, "p q"), (4, "p q r s")], "doc_id long, text string")
    target = spark.createDataFrame([(1,), (2,)], "doc_id long")
    by = {w: {r["doc_id"]: r["log_weight"] for r in quality.resample(docs, target, 0.5, weigh=w).collect()} for w in ("sum", "mean")}
    assert by["sum"][2] > 10 * by["sum"][1] > 0
    assert by["mean"][2] < 2 * by["mean"][1]

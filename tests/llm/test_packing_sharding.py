"""Packing, token output and sharding: laws, exact round trips and odd input."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starforge.llm.op5_sharding import shard_documents
from starforge.llm.op7_best_fit_packing import pack_documents
from starforge.llm.op8_token_output import CapacityTree, packed_rows, read_segments
from starforge.llm.packing import Limits, vector_best_fit
from starforge.llm.tokens import WordTokenIds, byte_bpe

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def word_ids():
    return WordTokenIds(WORD_FILE)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(list("abc .,'’…İß²　<|>"))), max_size=40))
def test_word_ids_equal_the_tokenizer(word_ids, text):
    assert word_ids.encode(text) == word_ids.whole(text)


def test_special_token_text_goes_through_the_tokenizer(word_ids):
    ids = np.frombuffer(word_ids.encode("a <|endoftext|> b"), "<u4").tolist()
    assert ids == Tokenizer.from_file(WORD_FILE).encode("a <|endoftext|> b", add_special_tokens=False).ids


def place(histogram, runs):
    """All pieces of a plan as (bin, offset, length)."""
    out = []
    for size, _, n, first, each, start in runs:
        out += [(first + i // each, start + i % each * size, size) for i in range(n)]
    assert {s: sum(1 for p in out if p[2] == s) for s in histogram} == histogram
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), min_size=1, max_size=20),
       st.sampled_from(["norm", "dot"]), st.integers(2, 64), st.integers(64 ** 2, 3 * 64 ** 2))
def test_plan_keeps_every_capacity(histogram, rule, documents, attention):
    bins = defaultdict(list)
    for b, offset, size in place(histogram, vector_best_fit(histogram, Limits(64, documents, attention), rule)):
        bins[b].append((offset, size))
    for pieces in bins.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 64 and len(pieces) <= documents and sum(s * s for _, s in pieces) <= attention


def first_fit_decreasing(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, used in enumerate(bins) if used + s <= capacity]
        if fits:
            best = max(fits, key=lambda i: bins[i])
            bins[best] += s
        else:
            bins.append(s)
    return len(bins)


def test_plan_is_as_dense_as_best_fit_one_by_one():
    rng = random.Random(1)
    for _ in range(20):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 400))]
        histogram = {s: sizes.count(s) for s in set(sizes)}
        bins = {p[0] for p in place(histogram, vector_best_fit(histogram, Limits(100, 10 ** 6, 10 ** 9)))}
        assert len(bins) <= first_fit_decreasing(sizes, 100)


def test_pack_documents_laws(spark, corpus, odd_documents, word_ids):
    for docs in (corpus[0], odd_documents):
        rows = pack_documents(docs, WORD_FILE, 64, with_ids=False).collect()
        expected = defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            ids = word_ids.whole(r["text"] or "") + (1).to_bytes(4, "little")
            for k, at in enumerate(range(0, len(ids), 256)):
                expected[r["doc_id"]].append((k, at // 4, len(ids[at:at + 256]) // 4, zlib.crc32(ids[at:at + 256])))
        got, sequences = defaultdict(list), defaultdict(list)
        for r in rows:
            got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 64
        total = sum(r["length"] for r in rows)
        assert len(sequences) <= -(-total // 64) * 1.05 + 1


def test_pack_empty_table(no_documents):
    assert pack_documents(no_documents, WORD_FILE, 64).count() == 0


def test_pack_with_ids(corpus, word_ids):
    docs = corpus[0].limit(5)
    rows = pack_documents(docs, WORD_FILE, 32, with_ids=True).collect()
    whole = defaultdict(list)
    for r in rows:
        whole[r["doc_id"]].append((r["piece"], bytes(r["ids"])))
    for r in docs.collect():
        assert b"".join(ids for _, ids in sorted(whole[r["doc_id"]])) == word_ids.whole(r["text"]) + b"\1\0\0\0"


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 50))
def test_capacity_tree_finds_the_tightest(residuals, size):
    tree = CapacityTree(50)
    for i, r in enumerate(residuals):
        tree.push(r, i)
    open_rows = sorted(residuals)
    while True:
        want = next((r for r in open_rows if r >= size), None)
        got = tree.pop_best(size)
        assert (got[0] if got else None) == want
        if got is None:
            break
        open_rows.remove(want)


@pytest.mark.parametrize("buffer_tokens", [100, 1_000_000])
def test_token_rows_round_trip(spark, odd_documents, corpus, buffer_tokens):
    encode = byte_bpe(BYTE_FILE, public_tokenizers.PATTERN)
    for docs in (corpus[0], odd_documents.where("doc_id is null or doc_id != 8")):
        rows = packed_rows(docs, BYTE_FILE, public_tokenizers.PATTERN, capacity=128, buffer_tokens=buffer_tokens)
        parts = defaultdict(list)
        for r in read_segments(rows).collect():
            assert r["length"] * 2 == len(r["ids"])
            parts[r["doc_id"]].append((r["start"], bytes(r["ids"])))
        for r in docs.select("doc_id", "text").collect():
            if r["text"]:
                ids = np.frombuffer(b"".join(p for _, p in sorted(parts[r["doc_id"]])), "<u2")
                assert ids[-1] == 50256 and encode.decode(ids[:-1].tolist()) == r["text"]
        for r in rows.collect():
            cu, positions = r["cu_seqlens"], np.frombuffer(r["position_ids"], "<u2")
            assert cu[0] == 0 and cu[-1] == r["n_tokens"] <= 128 and len(cu) == r["n_segments"] + 1
            assert positions.tolist() == [i for a, b in zip(cu, cu[1:]) for i in range(b - a)]
            assert zlib.crc32(bytes(r["input_ids"])) == r["ids_crc32"]


def test_token_rows_empty(no_documents):
    assert packed_rows(no_documents, BYTE_FILE, public_tokenizers.PATTERN).count() == 0


def test_sharding_laws(corpus, odd_documents, no_documents):
    for docs, shards in ((corpus[0], 24), (corpus[0], 7), (odd_documents, 4)):
        rows = shard_documents(docs, shards).collect()
        source = defaultdict(list)
        by_shard, mixture = defaultdict(list), defaultdict(lambda: [0] * shards)
        for r in docs.select("doc_id", "text", "source").collect():
            raw = (r["text"] or "").encode()
            source[r["doc_id"]].append((len(raw) + 8, zlib.crc32(raw)))
        names = {r["doc_id"]: r["source"] for r in docs.collect()}
        got = defaultdict(list)
        for r in rows:
            got[r["doc_id"]].append((r["size"], r["text_crc32"]))
            by_shard[r["shard"]].append(r["slot"])
            mixture[names[r["doc_id"]]][r["shard"]] += 1
            assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in source.items()}
        sizes = [len(by_shard[s]) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
        assert all(max(m) - min(m) <= 2 for m in mixture.values())
    assert shard_documents(no_documents, 4).count() == 0


def test_sharding_is_stable(corpus):
    docs = corpus[0]
    first = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_documents(docs, 5).collect()}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_documents(docs.repartition(3), 5).collect()}
    assert first == again


def test_packed_ids_of_null_and_repeated_rows(spark):
    rows = [(1, "one text of an id"), (1, "another, longer text of the same id " * 9), (1, "one text of an id"),
            (None, "a text without an id"), (None, None), (2, "word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with_ids = pack_documents(docs, WORD_FILE, 16, with_ids=True).collect()
    assert len(with_ids) == pack_documents(docs, WORD_FILE, 16).count()
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in with_ids)

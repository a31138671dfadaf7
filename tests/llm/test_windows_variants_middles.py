"""Differencing windows, spelling variants and fill-in-middle against brute force and odd input."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starforge.llm import op11_differencing_packing as op11
from starforge.llm import op12_spelling_variants as op12
from starforge.llm import op13_fill_in_middle as op13
from starforge.llm.tokens import byte_bpe_with_end

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# ---- 11: windows ------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list("a 's\n\t"))), max_size=30),
       st.booleans())
def test_ids_equal_the_tokenizer(tokenizer, text, marked):
    if marked:
        text = text + "<|endoftext|>" + text
    ids = np.frombuffer(byte_bpe_with_end(RANKS, PATTERN)(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=40), st.integers(1, 9))
def test_differencing_assigns_every_size(sizes, windows):
    window = op11.differencing(sizes, windows)
    loads = np.bincount(window, sizes, minlength=windows)
    assert len(window) == len(sizes) and loads.sum() == sum(sizes) and len(loads) == windows
    assert loads.max() - loads.min() <= max(sizes)


def test_differencing_by_hand():
    # 8 with 7, 6, 5 and 4 in two windows: the classic run ends with a difference of 2
    loads = np.bincount(op11.differencing([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4])
    assert sorted(loads) == [14, 16]


def test_the_window_count_rises_when_capacity_is_exceeded():
    # three pieces of 6 do not fit two windows of 9
    assert sorted(map(len, op11.windows_of([6, 6, 6], 2, 9))) == [1, 1, 1]
    assert op11.windows_of([], 0, 9) == []


def check_packing(docs, rows, tokenizer, capacity, end_id=0):
    expected = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [end_id], "<u4").tobytes()
        expected[r["doc_id"]].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(expected)
    for doc_id, texts in expected.items():
        assert sum(p[1] for p in pieces[doc_id]) == sum(len(ids) // 4 for ids in texts)
        if len(texts) == 1:
            at = 0
            for start, length, crc, tokens in sorted(pieces[doc_id]):
                assert start == at and tokens == len(texts[0]) // 4
                assert crc == zlib.crc32(texts[0][4 * start:4 * (start + length)])
                at += length
    padding = 0
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding, sum(r["length"] for r in rows)


def test_pack_evenly_laws(spark, corpus, odd_documents, tokenizer):
    for docs, capacity, group in ((corpus[0], 64, 16), (odd_documents, 1024, 64), (corpus[0].repartition(7), 1024, 4)):
        padding, total = check_packing(docs, op11.pack_evenly(docs, RANKS, PATTERN, capacity, group_windows=group).collect(),
                                       tokenizer, capacity)
        assert padding <= 0.02 * total


def test_pack_evenly_empty(no_documents):
    assert op11.pack_evenly(no_documents, RANKS, PATTERN).count() == 0


def test_padded_sequences_hold_all_documents(corpus, tokenizer):
    docs = corpus[0].limit(40)
    pieces = op11.pack_evenly(docs, RANKS, PATTERN, 256, group_windows=4, with_ids=True).cache()
    rows = {r["sequence_id"]: np.frombuffer(bytes(r["input_ids"]), "<u4") for r in op11.padded_sequences(pieces, 256).collect()}
    found = defaultdict(dict)
    for p in pieces.collect():
        found[p["doc_id"]][p["start"]] = rows[p["sequence_id"]][p["offset"]:p["offset"] + p["length"]].tolist()
    for r in docs.collect():
        ids = [i for _, part in sorted(found[r["doc_id"]].items()) for i in part]
        assert ids == tokenizer.encode(r["text"], add_special_tokens=False).ids + [0]
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    for r in used:
        assert len(rows[r["sequence_id"]]) == (r["n"] if r["n"] & (r["n"] - 1) == 0 else 256)


# ---- 12: spelling variants --------------------------------------------------

def variants_by_brute_force(docs, every=199, min_count=5, ratio=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= min_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] < ratio * n:
            best = None
        out[w] = [best, n, len(others), counts.get(best)]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def got_variants(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"]) for r in rows}


@pytest.fixture(scope="module")
def misspelled_docs():
    """Texts with frequent words, edits of them in falling numbers, accents, capitals and long words."""
    rng = random.Random(11)
    letters = "abcdefghinorstuéß"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(25)]
    words = list(stems)
    for w in stems:
        for _ in range(6):
            at, c = rng.randrange(len(w)), rng.choice(letters)
            w = rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at + 1:], w[:at] + c + w[at:]])
            words.append(w)
    words += ["y" * 300, "y" * 299, "y" * 150 + "x" + "y" * 149, "naïveté", "naiveté"]
    docs = []
    for i in range(60):
        picked = [words[min(int(rng.expovariate(1 / 40)), len(words) - 1)] for _ in range(300)]
        docs.append((i, ", ".join(w.capitalize() if rng.random() < 0.2 else w for w in picked)))
    return docs + [(None, "Stones " * 7 + "stone's stonés " * 5), (3, None), (4, ""), (5, "12 §")]


@pytest.mark.parametrize("every,ratio,hot", [(199, 5, 1024), (7, 2, 3)])
def test_variants_equal_brute_force(spark, misspelled_docs, monkeypatch, every, ratio, hot):
    monkeypatch.setattr(op12, "HOT", hot)      # with 3, shared reduced words are dealt into parts
    docs = spark.createDataFrame(misspelled_docs, "doc_id long, text string").repartition(5)
    got = got_variants(op12.group_variants(docs, every=every, ratio=ratio, symbols=2 if hot == 3 else None))
    assert got == variants_by_brute_force(misspelled_docs, every=every, ratio=ratio)
    assert sum(v[0] is not None for v in got.values()) >= 10


def test_chains_are_followed_to_the_end(spark):
    chain = [("abcdef"[:k] + "z" * (6 - k), 5 * 6 ** k) for k in range(7)]     # every step is one letter
    text = " ".join(" ".join([w] * n) for w, n in chain[:5])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = got_variants(op12.group_variants(docs, every=10 ** 9))
    assert {v[4] for v in got.values()} == {"abcdzz"} and len(got) == 5


@settings(max_examples=60, deadline=None)
@given(st.text("abcdeé", min_size=2, max_size=9), st.integers(2, 5), st.data())
def test_neighbourhood_holds_every_edit(word, symbols, data):
    def codes(w):
        return np.frombuffer(w.encode("utf-32-le"), "<u4").reshape(1, len(w))
    keys = set(op12.neighbour_keys(codes(word), symbols)[0].tolist())
    at, c = data.draw(st.integers(0, len(word) - 1)), data.draw(st.sampled_from("xyzß"))
    for other in (word, word[:at] + word[at + 1:], word[:at] + c + word[at + 1:], word[:at] + c + word[at:]):
        assert int(op12.reduced_keys(codes(other), symbols)[0]) in keys


def test_symbols_grow_with_the_vocabulary():
    assert [op12.symbols_for(n, 6) for n in (0, 4096, 4097, 500_000, 7_000_000)] == [4, 4, 5, 9, 14]


def test_variants_odd_input(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert got_variants(op12.group_variants(odd_documents, min_count=1)) == variants_by_brute_force(rows, min_count=1)
    assert op12.group_variants(no_documents).collect() == []


# ---- 13: fill-in-middle -----------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200_000), st.integers(1, 9000), st.sampled_from([1, 2, 3, 40])), min_size=1, max_size=6))
def test_boundary_set_selects_like_an_array(ranges):
    places = np.unique(np.concatenate([np.arange(a, a + n * step, step) for a, n, step in ranges]))
    s = op13.BoundarySet(places)
    assert len(s) == len(places)
    for rank in {0, len(places) - 1, len(places) // 2, len(places) // 3, *range(0, len(places), 997)}:
        assert s.select(rank) == places[rank]
    with pytest.raises(IndexError):
        s.select(len(places))


def test_every_kind_of_container_is_used():
    kinds = [type(op13.container_of(low)).__name__ for low in
             (np.arange(0, 60_000, 97), np.arange(0, 60_000, 3), np.arange(10, 50_000))]
    assert kinds == ["ArrayContainer", "BitmapContainer", "RunContainer"]
    assert len(op13.BoundarySet(np.empty(0, np.int64))) == 0


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
UNITS = {"token": TOKEN.findall, "character": list, "line": lambda t: re.findall(r"[^\n]*\n|[^\n]+", t)}


def middles_by_brute_force(doc_id, text, unit="token", rate=50, spm_rate=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    units = UNITS[unit](text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return doc_id, len(units), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return doc_id, len(units), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \t\n\x0b\r\x1c  ab<PSM>\U0001F600é")),
                                  st.characters(exclude_categories=["Cs"])), max_size=40),
       st.integers(-5, 10 ** 12), st.sampled_from(["token", "line", "character"]))
def test_transformed_as_brute_force(text, doc_id, unit):
    assert op13.transformed(doc_id, text, 42, unit, 100, 80) == middles_by_brute_force(doc_id, text, unit, 100)


def test_fill_in_middle_and_back(spark, corpus, odd_documents):
    dense = spark.createDataFrame([(k, "a b " * 40_000 + "\n" * k) for k in range(20)]
                                  + [(k, "x<M>y " * 3) for k in range(30, 40)], "doc_id long, text string")
    for docs in (corpus[0], odd_documents, dense):
        originals = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        rows = op13.fill_in_middle(docs).withColumn("back", op13.restored_text(F.col("output"), F.col("form"))).collect()
        assert Counter(tuple(r)[:6] for r in rows) == Counter(middles_by_brute_force(*o) for o in originals)
        assert Counter((r["doc_id"], r["back"]) for r in rows) == Counter((d, t or "") for d, t in originals)
    assert {r["form"] for r in op13.fill_in_middle(corpus[0]).select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_fill_in_middle_empty(no_documents):
    assert op13.fill_in_middle(no_documents).count() == 0

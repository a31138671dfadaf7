"""The corpus pipeline against a brute-force version, and its registry entries."""
import random
import re
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from starforge.llm import op7_best_fit_packing
from starforge.llm.common import staged
from starforge.llm.queries import tokenizer_file
from starforge.llm.tokens import WordTokenIds

from .conftest import sentence
from .test_matching import brute_classes


@pytest.fixture(scope="module")
def tables(spark, corpus, tmp_path_factory):
    docs, labels = corpus
    rng = random.Random(11)
    items = [(i, sentence(rng, "en", 40)) for i in range(4)]
    rows = {r["doc_id"]: r for r in docs.collect()}
    out = []
    for i, r in rows.items():
        text = r["text"]
        if i in (4, 8, 30):
            text += "\n" + items[i % 4][1]
        out.append((i, text, r["lang"], r["source"], len(text)))
    out += [(900, "", "en", "s", 0), (901, "12 34", "en", "s", 5), (902, None, None, None, None)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items


def test_pipeline_equals_brute_force(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    insults = re.compile("blockhead|scoundrel|nitwit", re.I)
    kept = {i: t for i, t in texts.items() if t and re.search(r"[^\W\d_]", t) and not insults.search(t)}
    classes = brute_classes(list(kept.items()))
    kept = {i: t for i, t in kept.items() if classes[i] == i}
    kept = {i: t for i, t in kept.items() if not any(item in t for _, item in items)}
    encode = WordTokenIds(tokenizer_file("word_bpe_49k.json"))
    want = set()
    for i, t in kept.items():
        ids = encode.whole(t) + b"\1\0\0\0"
        want |= {(i, k, len(ids[at:at + 4 * 4096]) // 4, zlib.crc32(ids[at:at + 4 * 4096]))
                 for k, at in enumerate(range(0, len(ids), 4 * 4096))}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)


def test_stages_keep_the_columns(spark, tables):
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, folder), f"test-{name}")
        assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_stages_take_odd_and_empty_tables(spark, tables, odd_documents, no_documents):
    folder, _ = tables
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_documents, odd_documents.select(*names), no_documents.select(*names)):
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, docs, folder), f"test-{name}")
            assert name == "packing" or out.columns == docs.columns
            docs = out if name != "packing" else docs


def test_registry_holds_every_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert op7_best_fit_packing.PIECE_SCHEMA.startswith("doc_id long, piece int")

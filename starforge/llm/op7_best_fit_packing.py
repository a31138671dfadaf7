"""Vector best-fit packing of tokenized documents into sequences of bounded length.

Each document is its token ids and an end id; only documents longer than a sequence are
cut, into full pieces and a rest.  Pieces go to sequences by vector best-fit under three
capacities: tokens, number of documents and attention cost (sum of squared lengths); see
``packing``.  With the default capacities only the tokens bind, so the result is as dense
as best-fit decreasing makes it.

Defined results: null text is empty (its piece is the end id alone); null ids, repeated
rows and equal texts are all packed, one row per piece; an empty table gives an empty
result; other columns of the input are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import staged
from starforge.llm.packing import Limits, apply_plan, vector_best_fit
from starforge.llm.tokens import word_token_ids

PIECE_SCHEMA = "doc_id long, piece int, start long, length int, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int, end_id: int = 1,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text); ``with_ids`` adds the ids as ``<u4`` bytes."""
    width = 4 * max_tokens
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_token_ids(tokenizer_path).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), *([pa.binary()] if with_ids else [])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        pieces, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, max_documents: int = 4096,
                   max_attention: int | None = None, rule: str = "norm", with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` with ``sequence_id`` and ``offset``."""
    pieces = token_pieces(docs, tokenizer_path, max_tokens, with_ids=with_ids)
    if with_ids:    # ids and pieces may repeat or be null: a key of the staged row
        pieces = pieces.withColumn("_row", F.monotonically_increasing_id())
    pieces = staged(pieces, "pieces")
    # at most max_tokens rows
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = vector_best_fit(histogram, Limits(max_tokens, max_documents, max_attention or max_tokens ** 2), rule)
    narrow = pieces.drop("ids")
    placed = apply_plan(narrow, runs, ["ids_crc32", "doc_id", "piece"], "pieces-ranked")
    if with_ids:
        placed = placed.join(pieces.select("_row", "ids"), "_row").drop("_row")
    return placed

"""Token-id output: documents as packed id matrices with segment lengths and position resets.

Every task tokenizes its rows and packs them best-fit decreasing into rows of the matrix:
pieces are taken longest first, and a segment tree over residual capacities finds the
fullest open row that still holds the piece in O(log capacity) steps.  Texts longer
than a row are cut into full rows and a rest, and nothing is dropped, so the ids of a document can
be put together again from its segments.

A task works on buffers of ``buffer_tokens`` tokens; rows that are not full stay open for the
next buffer.  Past ``open_rows`` of them the fullest are passed on, which are the least likely to take another
piece; so a task holds one buffer and at most that many rows.
Nothing is shuffled: a lost task is computed again from its input split, with the same rows
and ids.

Defined results: null and empty texts have no ids and no segment; null ids and repeated rows
are packed like others; an empty table gives no rows; other columns of the input are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.tokens import byte_bpe

ROW_SCHEMA = ("sequence_id long, n_tokens int, n_segments int, doc_ids array<long>, starts array<long>, "
              "cu_seqlens array<int>, input_ids binary, position_ids binary, ids_crc32 long")


class CapacityTree:
    """Open rows by residual capacity; finds the smallest residual that is at least a size."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list] = [[] for _ in range(capacity + 1)]

    def push(self, residual: int, row) -> None:
        self.rows[residual].append(row)
        node = residual + self.width
        while node:
            self.count[node] += 1
            node >>= 1

    def pop_best(self, size: int):
        """(residual, row) of the tightest open row holding ``size``, or None."""
        node = size + self.width
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node <<= 1
                if not self.count[node]:
                    node += 1
        residual = node - self.width
        while node:
            self.count[node] -= 1
            node >>= 1
        return residual, self.rows[residual].pop()


def pack_rows(pieces: list[tuple], capacity: int, tree: CapacityTree) -> Iterator[list]:
    """Place ``pieces`` (doc_id, start, ids), longest first; yields the rows that became full."""
    for piece in sorted(pieces, key=lambda p: -len(p[2])):
        size = len(piece[2])
        residual, row = tree.pop_best(size) or (capacity, [])
        row.append(piece)
        if residual == size:
            yield row
        else:
            tree.push(residual - size, row)


def packed_rows(docs: DataFrame, rank_file: str, pattern: str, capacity: int = 2048, end_id: int = 50256,
                buffer_tokens: int = 2_000_000, open_rows: int = 2048) -> DataFrame:
    """Matrix rows of ``docs`` (doc_id, text): one row of at most ``capacity`` ids each.

    ``input_ids`` are ``<u2`` ids, ``cu_seqlens`` the cumulative segment lengths from 0,
    ``position_ids`` ``<u2`` positions that restart at every segment, ``doc_ids`` and
    ``starts`` each segment's document and its place in it.  Each document ends with ``end_id``.
    """

    def as_batch(rows: list[list], first_id: int) -> pa.RecordBatch:
        out = []
        for k, row in enumerate(rows):
            sizes = np.array([len(ids) for _, _, ids in row], np.int32)
            ids = np.concatenate([ids for _, _, ids in row]).astype("<u2")
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            positions = (np.arange(len(ids)) - np.repeat(bounds[:-1], sizes)).astype("<u2")
            raw = ids.tobytes()
            out.append((first_id + k, len(ids), len(row), [d for d, _, _ in row], [s for _, s, _ in row],
                        bounds, raw, positions.tobytes(), zlib.crc32(raw)))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.binary(), pa.binary(), pa.int64()]
        names = [c.split()[0] for c in ROW_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(rank_file, pattern).encode_to_numpy
        tree, done, pieces, held = CapacityTree(capacity), [], [], 0
        next_id = TaskContext.get().partitionId() << 33

        def drain(size: int) -> Iterator[pa.RecordBatch]:
            nonlocal done, next_id
            while len(done) >= size and done:
                part, done = done[:256], done[256:]
                yield as_batch(part, next_id)
                next_id += len(part)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                ids = np.append(encode(text, disallowed_special=()), end_id).astype(np.uint16)
                for at in range(0, len(ids), capacity):
                    pieces.append((doc_id, at, ids[at:at + capacity]))
                held += len(ids)
                if held >= buffer_tokens:
                    done.extend(pack_rows(pieces, capacity, tree))
                    done.extend(tree.pop_best(1)[1] for _ in range(tree.count[1] - open_rows))
                    pieces, held = [], 0
                    yield from drain(256)
        done.extend(pack_rows(pieces, capacity, tree))
        done.extend(row for rows in tree.rows for row in rows)
        yield from drain(1)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, ROW_SCHEMA)


def write_packed(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: binary id and position rows, segment lengths, documents."""
    rows.write.mode("overwrite").parquet(path)


def read_segments(rows: DataFrame) -> DataFrame:
    """Segments of packed rows: (doc_id, start, length, ids as ``<u2`` bytes), to rebuild documents."""
    at = rows.select("input_ids", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "starts")).alias("k", "s"))
    first, last = F.element_at("cu_seqlens", F.col("k") + 1), F.element_at("cu_seqlens", F.col("k") + 2)
    return at.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.starts").alias("start"),
                     (last - first).alias("length"),
                     F.substring("input_ids", first * 2 + 1, (last - first) * 2).alias("ids"))

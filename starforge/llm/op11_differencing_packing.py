"""Packing by Karmarkar-Karp multiway differencing: windows of nearly equal, here full, length.

**Windows.** A document is its token ids and an end id.  Its full windows stand alone; its rest
waits in a group.  A group closes as soon as its rests fill ``group_windows`` windows exactly (the
rest that crosses the border is cut there and goes on in the next group).

**Differencing.** Each piece of a group starts as a partial partition: itself in one window, nothing
in the others.  The two partial partitions with the largest imbalance (fullest less emptiest
window) are merged again and again, the fullest window of one with the emptiest of the other, so that
imbalances oppose each other.  One partition remains, of nearly equal windows.  Should a window of
it exceed the capacity, the window count rises by one and the group is partitioned anew.

**Cuts.** A sixteenth of a group's tokens, taken from its longest rests, is cut into pieces of
a sixteenth of a window and its halves down to single tokens before, which lets differencing close the last gaps; the other rests stay
whole.  Neighbouring pieces of one document that meet in a window are joined again.  What is
left at the end of a task and fills no window becomes sequences of power-of-two length, which
are not padded.

A task holds one group of rests and one batch of texts.  Nothing is shuffled or collected: a lost
task is computed again from its input split.

Defined results: null text is empty (its piece is the end id alone); null ids, repeated rows and
equal texts are all packed; an empty table gives an empty result; other columns of the input
are ignored.
"""
from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.tokens import byte_bpe_with_end

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")
GRAIN_SHARE = 1 / 16      # of a group's tokens; half a window at least


def grains(capacity: int) -> list[int]:
    """A cycle of cut sizes: a sixteenth of a window, halved down to 1, and 1 again."""
    sizes = [max(capacity // 16, 1)]
    while sizes[-1] > 1:
        sizes.append(sizes[-1] // 2)
    return sizes + [1]


def differencing(sizes: list[int], windows: int) -> np.ndarray:
    """The window of every size, by multiway differencing over ``windows`` windows."""
    n = len(sizes)
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    loads: dict[int, np.ndarray] = {}                   # partial partition -> loads, largest first, least is 0
    merges: list[tuple[int, int, np.ndarray]] = []      # (left, right, order) of partial partition n + position

    def take() -> tuple[int, np.ndarray]:
        _, node = heapq.heappop(heap)
        if node >= n:
            return node, loads.pop(node)
        alone = np.zeros(windows, np.int64)
        alone[0] = sizes[node]
        return node, alone

    while len(heap) > 1:
        (a, left), (b, right) = take(), take()
        total = left + right[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]
        node = n + len(merges)
        merges.append((a, b, order))
        loads[node] = total
        heapq.heappush(heap, (-int(total[0]), node))

    window = np.zeros(n, np.int64)
    places = {n + len(merges) - 1: np.arange(windows)}  # partial partition -> final window of each of its loads
    for node in range(n + len(merges) - 1, n - 1, -1):
        a, b, order = merges[node - n]
        place = np.empty(windows, np.int64)
        place[order] = places.pop(node)
        for child, at in ((a, place), (b, place[::-1])):
            if child < n:
                window[child] = at[0]
            else:
                places[child] = at
    return window


def windows_of(sizes: list[int], windows: int, capacity: int) -> list[list[int]]:
    """Sizes (by position) of each window; the window count rises until all hold at most ``capacity``."""
    while sizes:
        window = differencing(sizes, windows)
        if np.bincount(window, sizes, minlength=windows).max() <= capacity:
            out: list[list[int]] = [[] for _ in range(windows)]
            for i, w in enumerate(window):
                out[w].append(i)
            return [members for members in out if members]
        windows += 1
    return []


def grained(pieces: list[tuple[int, int, int]], tokens: float, sizes: list[int]) -> list[tuple[int, int, int]]:
    """``pieces`` (document, start, length), the longest of which, ``tokens`` in sum, are cut into ``sizes``."""
    pieces = sorted(pieces, key=lambda p: p[2])
    small = []
    while pieces and tokens > 0:
        doc, start, length = pieces.pop()
        tokens -= length
        k = 0
        while length:
            size = min(sizes[k % len(sizes)], length)
            small.append((doc, start, size))
            start, length, k = start + size, length - size, k + 1
    return pieces + small


def group_sequences(pieces: list[tuple[int, int, int]], windows: int, capacity: int) -> list[list[tuple]]:
    """Sequences of pieces (document, start, length) for rests that fill ``windows`` windows."""
    parts = grained(pieces, max(GRAIN_SHARE * windows, 0.5) * capacity, grains(capacity)) if windows > 1 else pieces
    out = []
    for members in windows_of([p[2] for p in parts], windows, capacity):
        sequence: list[tuple[int, int, int]] = []
        for doc, start, length in sorted(parts[i] for i in members):
            if sequence and sequence[-1][0] == doc and sequence[-1][1] + sequence[-1][2] == start:
                sequence[-1] = (doc, sequence[-1][1], sequence[-1][2] + length)
            else:
                sequence.append((doc, start, length))
        out.append(sequence)
    return out


def split_at(pieces: list[tuple[int, int, int]], tokens: int) -> tuple[list, list]:
    """``pieces`` in order, cut where ``tokens`` of them are passed."""
    head: list[tuple[int, int, int]] = []
    tail: list[tuple[int, int, int]] = []
    for doc, start, length in pieces:
        first = min(length, max(tokens, 0))
        tokens -= length
        if first:
            head.append((doc, start, first))
        if length > first:
            tail.append((doc, start + first, length - first))
    return head, tail


def last_sequences(pieces: list[tuple[int, int, int]], capacity: int) -> list[list[tuple]]:
    """Sequences of a group that fills no further window: full ones, then powers of two."""
    windows, rest = divmod(sum(p[2] for p in pieces), capacity)
    head, tail = split_at(pieces, windows * capacity)
    out = group_sequences(head, windows, capacity)
    while rest:
        size = 1 << (rest.bit_length() - 1)
        sequence, tail = split_at(tail, size)
        out.append(sequence)
        rest -= size
    return out


def pack_evenly(docs: DataFrame, rank_file: str, pattern: str, capacity: int = 1024, end_id: int = 0,
                group_windows: int = 64, with_ids: bool = False) -> DataFrame:
    """Pieces (PIECE_SCHEMA) of all ``docs`` (doc_id, text); ``with_ids`` adds the ids as ``<u4`` bytes."""
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")] + (["ids"] if with_ids else [])
    types = [pa.int64()] * 7 + ([pa.binary()] if with_ids else [])
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe_with_end(rank_file, pattern)
        rests: dict[int, tuple] = {}                # document number -> (doc_id, tokens, first of the rest, its ids)
        waiting: list[tuple[int, int, int]] = []    # pieces (document number, start, length)
        filled, number, rows = 0, 0, []
        next_id = TaskContext.get().partitionId() << 33

        def emit(doc_id, start: int, ids: bytes, tokens: int, sequence: int, offset: int) -> None:
            rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), tokens, sequence, offset,
                         *([ids] if with_ids else [])))

        def emit_all(sequences: list[list[tuple]]) -> None:
            nonlocal next_id
            for sequence in sequences:
                offset = 0
                for doc, start, length in sequence:
                    doc_id, tokens, first, ids = rests[doc]
                    emit(doc_id, start, ids[4 * (start - first):4 * (start - first + length)], tokens, next_id, offset)
                    offset += length
                next_id += 1

        def batch_of_rows() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(types)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                tokens, first = len(ids) // 4, len(ids) // 4 // capacity * capacity
                for start in range(0, first, capacity):
                    emit(doc_id, start, ids[4 * start:4 * (start + capacity)], tokens, next_id, 0)
                    next_id += 1
                if first < tokens:
                    rests[number] = (doc_id, tokens, first, ids[4 * first:])
                    waiting.append((number, first, tokens - first))
                    filled += tokens - first
                    number += 1
                if filled >= group_windows * capacity:
                    group, waiting = split_at(waiting, group_windows * capacity)
                    emit_all(group_sequences(group, group_windows, capacity))
                    rests = {p[0]: rests[p[0]] for p in waiting}
                    filled -= group_windows * capacity
                if len(rows) >= 4096:
                    yield batch_of_rows()
        emit_all(last_sequences(waiting, capacity))
        if rows:
            yield batch_of_rows()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        pack, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def padded_sequences(pieces: DataFrame, capacity: int = 1024, pad_id: int = 50256) -> DataFrame:
    """Training rows of ``pieces`` with ids: (sequence_id, n_tokens, input_ids as ``<u4`` bytes).

    Rows are padded with ``pad_id`` to ``capacity``, except at a power of two.
    """
    rows = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))
    n = F.col("n_tokens")
    missing = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(capacity - n)
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), missing.cast("int")))
    return rows.select("sequence_id", "n_tokens", F.aggregate(
        "parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]), lambda ids: F.concat(ids, pad)).alias("input_ids"))

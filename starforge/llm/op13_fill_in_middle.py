"""Fill-in-middle transformation with cuts found in a Roaring-style boundary set.

**Boundaries.** The places where a text may be cut (ends of its units, in code points) form a
compressed set: containers of 2**16 places each, stored as a sorted array, a bitmap or runs,
whichever is smallest, beside the cumulative cardinalities of the containers.  The k-th boundary is
found by a binary search for its container and a select inside it: an index into an array, a search
of the cumulative bit counts and then of one word of a bitmap, a search of the cumulative
run lengths.

**Cuts.** Four numbers are drawn from the SHA-256 of ``<seed>:<doc_id>``.  Two of them, modulo the number
of units plus one, say after how many units prefix and middle end; the others choose the form: plain,
``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle), each part behind its mark.  The
result depends on the row alone: no shuffle, no state, and a lost task is computed again.

**Units.** ``token``: a run of visible characters with the white space before it, or white space
at the end of the text (most sets are arrays, those of long texts bitmaps); ``line``: a line with its
end; ``character``: every code point, which gives run containers.

Defined results: null text is empty; an empty text or one that holds a mark stays plain; a null id
draws from the seed and an empty id; rows of one id draw the same numbers; an empty table gives
an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ROW_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
# Rows are passed on when their outputs hold this many characters.
OUTPUT_CHARS = 4_000_000

_CHUNK_BITS = 16
_ARRAY_MOST = 4096
_BITMAP_BYTES = 8192


class ArrayContainer:
    """Sorted 16-bit places."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitmapContainer:
    """One bit for each of the 2**16 places, in 64-bit words."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << _CHUNK_BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, "right")) - 1
        bits = int(self.words[word])
        for _ in range(rank - int(self.before[word])):
            bits &= bits - 1            # drop the lowest bit
        return 64 * word + (bits & -bits).bit_length() - 1


class RunContainer:
    """Runs of consecutive places: first places and cumulative lengths."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.first = low[first]
        self.before = first

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.first[run]) + rank - int(self.before[run])


def container_of(low: np.ndarray):
    """The smallest container of the sorted places ``low`` (0 to 2**16 - 1)."""
    runs = 1 + int((np.diff(low) != 1).sum())
    array = 2 * len(low) if len(low) <= _ARRAY_MOST else _BITMAP_BYTES + 1
    if 2 + 4 * runs < min(array, _BITMAP_BYTES):
        return RunContainer(low)
    return ArrayContainer(low) if array <= _BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """A sorted set of places with ``select``."""

    def __init__(self, places: np.ndarray):
        chunks, first = np.unique(places >> _CHUNK_BITS, return_index=True)
        self.chunks = chunks
        self.before = np.append(first, len(places))         # cumulative cardinalities
        self.containers = [container_of(places[a:b] & ((1 << _CHUNK_BITS) - 1))
                           for a, b in zip(self.before, self.before[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        """The place of rank ``rank`` (from 0)."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.before, rank, "right")) - 1
        return (int(self.chunks[at]) << _CHUNK_BITS) + self.containers[at].select(rank - int(self.before[at]))


def unit_ends(text: str, unit: str) -> np.ndarray:
    """Code-point places behind each unit of ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if unit == "character":
        return np.arange(1, len(codes) + 1)
    if unit == "line":
        ends = codes == 10
    elif unit == "token":
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        ends = ~blank
        ends[:-1] &= blank[1:]
    else:
        raise ValueError(f"unknown unit {unit!r}")
    if len(codes):
        ends[-1] = True
    return np.flatnonzero(ends) + 1


def drawn_numbers(seed: int, doc_id: int | None) -> list[int]:
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id: int | None, text: str, seed: int, unit: str, rate: int, spm_rate: int) -> tuple:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of one document."""
    bounds = BoundarySet(unit_ends(text, unit))
    n = len(bounds)
    h1, h2, h3, h4 = drawn_numbers(seed, doc_id)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return doc_id, n, "plain", None, None, text
    units = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (bounds.select(u - 1) if u else 0 for u in units)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return doc_id, n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 42, unit: str = "token", rate: int = 50,
                   spm_rate: int = 80) -> DataFrame:
    """Transformed ``docs`` (doc_id, text): ROW_SCHEMA, one row a row.

    ``rate`` percent of the documents are transformed, ``spm_rate`` percent of these in suffix-first form.
    """
    fields = [f.split() for f in ROW_SCHEMA.split(", ")]
    types = [pa.string() if kind == "string" else pa.int64() for _, kind in fields]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f for f, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                rows.append(transformed(doc_id.as_py(), text.as_py() or "", seed, unit, rate, spm_rate))
                held += len(rows[-1][-1])
                if held >= OUTPUT_CHARS:
                    yield as_batch(rows)
                    rows, held = [], 0
            if rows:
                yield as_batch(rows)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROW_SCHEMA)


def restored_text(output: Column, form: Column) -> Column:
    """The original text, from the output and its form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.element_at(parts, i) for i in (2, 3, 4))
    return (F.when(form == "plain", output)
             .when(form == "psm", F.concat(first, middle, second))
             .otherwise(F.concat(second, middle, first)))

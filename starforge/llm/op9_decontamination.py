"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared in lower case with every run of other characters than letters, digits
and underscores as one space.  Benchmark items are cut into segments: of ``SEGMENT`` characters one
after the other, and of ``WINDOW`` characters every ``STRIDE``, each with a last one that ends with the
item.  A segment of length n may differ by e = floor(``rate`` * n) edits.  So a passage of an item is
found from any place in it if it has ``WINDOW`` + ``STRIDE`` - 1 = 79 characters, with at most 5 edits.
Shorter passages are found if they are a whole item or hold a whole segment.

1. A text's character q-grams are looked up among those of the items.
2. A match with at most e edits shares at least n + 1 - q (e + 1) q-grams with the segment, and
   their diagonals (place in the text minus place in the segment) lie within e of each
   other.  Shared q-grams are counted in overlapping diagonal bands of width 2 (e + 1), half
   a band apart, so any such match lies whole in one band.  Bands that reach the bound are kept.
   They are counted by item first, where a match lies in two bands side by side, and by
   segment only where an item has as many as one of its segments needs.
3. Each kept region is verified by an edit-distance alignment inside the band.

The benchmark is the stated query set: it goes to all tasks in blocks of at most
``block_chars`` characters, one scan of the texts a block.  Texts are read whole; very long ones in
overlapping slices.

Defined results: null and empty texts and items match nothing; items shorter than a q-gram match
only texts equal to them; repeated rows give one result; null ids are kept as null; an empty
benchmark leaves every text clean; other columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import WORD, mix64

Q = 8
SEGMENT = 128
WINDOW = 64
STRIDE = 16
RATE = 0.08
# About 29 bytes a character in every Python worker: some 120 MB a block.
BLOCK_CHARS = 4_000_000
# Pairs of equal q-grams (a place in the text, one in the items) that are listed at a time.
PAIRS = 2_000_000
SLICE = 1_000_000
BATCH = 400_000
_BASE = 0x100000001B3
_BITS = 22

REGION_SCHEMA = "doc_id long, item_id long, segment int, start long, length int, edits int"


def normalized(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each place (Q = 8: three doublings)."""
    h = points.astype(np.uint64) + np.uint64(1)
    width = 1
    while width < Q:
        h = h[:-width] * np.uint64(pow(_BASE, width, 2 ** 64)) + h[width:] if len(h) > width else h[:0]
        width *= 2
    return mix64(h)


def cuts(n: int) -> list[tuple[int, int, int]]:
    """(family, start, length) of the segments of an item of ``n`` characters; a family's don't overlap."""
    out = [(0, s, SEGMENT) for s in range(0, n - SEGMENT + 1, SEGMENT)] or [(0, 0, n)]
    if n > SEGMENT and n % SEGMENT:
        out.append((1, n - SEGMENT, SEGMENT))
    if n > WINDOW:
        out += [(2 + s // STRIDE % (WINDOW // STRIDE), s, WINDOW) for s in range(0, n - WINDOW + 1, STRIDE)]
        if (n - WINDOW) % STRIDE:
            out.append((2 + WINDOW // STRIDE, n - WINDOW, WINDOW))
    return out


@dataclass
class Index:
    """Segments of a block of items and the items' q-grams."""
    item: np.ndarray            # item id of each segment
    number: np.ndarray          # its place among the item's segments
    flat: np.ndarray            # characters of all items
    begin: np.ndarray           # of each segment in them
    sizes: np.ndarray
    edits: np.ndarray
    need: np.ndarray            # shared q-grams that a match has at least
    families: list[np.ndarray]  # segments that don't overlap, by place
    bounds: np.ndarray          # first character of each item
    item_edits: np.ndarray      # most edits and least need of an item's segments
    item_need: np.ndarray
    grams: np.ndarray           # sorted distinct hashes
    first: np.ndarray           # of each hash in the list below
    place: np.ndarray           # among the characters of all items
    seen: np.ndarray            # by the hashes' top bits
    short: dict[str, list]

    @classmethod
    def of(cls, items: list[tuple], rate: float = RATE) -> Index:
        item, number, owner, begin, sizes, family, bounds, points, short = [], [], [], [], [], [], [], [], {}
        total = 0
        for item_id, text in items:
            p = code_points(normalized(text))
            if 0 < len(p) < Q:
                short.setdefault(normalized(text), []).append(item_id)
            if len(p) < Q:
                continue
            for k, (f, start, size) in enumerate(cuts(len(p))):
                item.append(item_id)
                number.append(k)
                owner.append(len(bounds))
                begin.append(total + start)
                sizes.append(size)
                family.append(f)
            bounds.append(total)
            points.append(p)
            total += len(p)
        begin, sizes, owner, family = (np.array(x, np.int64) for x in (begin, sizes, owner, family))
        edits = np.floor(rate * sizes + 1e-9).astype(np.int64)
        edits = np.minimum(edits, np.maximum((sizes + 1) // Q - 1, 0))     # the bound stays at least 1
        need = sizes + 1 - Q * (edits + 1)
        item_edits = np.zeros(len(bounds), np.int64)
        np.maximum.at(item_edits, owner, edits)
        item_need = np.full(len(bounds), np.iinfo(np.int64).max)
        np.minimum.at(item_need, owner, need)
        hashes = [gram_hashes(p) for p in points]
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        place = np.concatenate([b + np.arange(len(h)) for b, h in zip(bounds, hashes)]) if hashes else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        grams, first = np.unique(flat[order], return_index=True)
        seen = np.zeros(1 << _BITS, bool)
        seen[(grams >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        families = [f[np.argsort(begin[f], kind="stable")] for f in
                    (np.flatnonzero(family == k) for k in np.unique(family))]
        return cls(np.array(item, object), np.array(number, np.int64),
                   np.concatenate(points) if points else np.empty(0, "<u4"), begin, sizes, edits, need, families,
                   np.array(bounds, np.int64), item_edits, item_need, grams, np.append(first, len(flat)), place[order],
                   seen, short)

    @property
    def points(self) -> list[np.ndarray]:
        """Characters of each segment."""
        return [self.flat[b:b + n] for b, n in zip(self.begin, self.sizes)]

    def hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``points``, q-gram, number of its places in the items) of shared q-grams."""
        if not len(self.grams) or len(points) < Q:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        h = gram_hashes(points)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        k = np.searchsorted(self.grams, h[at])
        k[k == len(self.grams)] = 0
        hit = self.grams[k] == h[at]
        at, k = at[hit], k[hit]
        return at, k, self.first[k + 1] - self.first[k]

    def shared(self, points: np.ndarray, hits: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``points``, place in the items) of shared q-grams where an item has enough for a match."""
        at, k, n = hits
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        entry = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, place = np.repeat(at, n), self.place[entry]
        owner = np.searchsorted(self.bounds, place, "right") - 1
        diagonal = at - place + len(self.flat)                              # not negative
        # a match's diagonals, 2 e + 1 at most, lie in two bands side by side
        span = len(points) + len(self.flat) + 2
        key, row, count = np.unique(owner * span + diagonal // (2 * (self.item_edits[owner] + 1)),
                                    return_inverse=True, return_counts=True)
        both = count.copy()
        beside = np.flatnonzero(np.diff(key) == 1)
        both[beside] += count[beside + 1]
        both[beside + 1] = np.maximum(both[beside + 1], count[beside] + count[beside + 1])
        keep = (both >= self.item_need[key // span])[row]
        return at[keep], place[keep]

    def bands(self, points: np.ndarray, hits: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(segment, band) of every diagonal band that holds enough shared q-grams."""
        at, place = self.shared(points, hits)
        segments, bands = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        span = len(points) + 2 * SEGMENT + 2
        for family in self.families:
            k = np.searchsorted(self.begin[family], place, "right") - 1
            seg = family[k]
            inside = (k >= 0) & (place + Q <= self.begin[seg] + self.sizes[seg])
            seg = seg[inside]
            diagonal = at[inside] - place[inside] + self.begin[seg] + SEGMENT       # not negative
            band = diagonal // (self.edits[seg] + 1)
            key = np.concatenate([seg * span + band + 1, seg * span + band])        # each lies in two bands
            key, count = np.unique(key, return_counts=True)
            key = key[count >= self.need[key // span]]
            segments.append(key // span)
            bands.append(key % span)
        return np.concatenate(segments), np.concatenate(bands)

    def regions(self, points: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(segment, start, length, edits) of verified matches in ``points``.

        A text that shares very many q-grams with the items (repeated phrases on both sides) is searched in halves
        that overlap by more than a match, so memory stays bounded; a match in the overlap comes twice.
        """
        parts = [(0, points)]
        while parts:
            first, part = parts.pop()
            hits = self.hits(part)
            if hits[2].sum() > PAIRS and len(part) > 8 * SEGMENT:
                half = len(part) // 2
                parts += [(first + half, part[half:]), (first, part[:half + 2 * SEGMENT])]
                continue
            for seg, start, length, edits in self.regions_of(part, hits):
                yield seg, first + start, length, edits

    def regions_of(self, points: np.ndarray, hits: tuple) -> Iterator[tuple[int, int, int, int]]:
        seg, band = self.bands(points, hits)
        sizes = self.sizes[seg]
        for n in np.unique(sizes):   # equally long segments allow equally many edits
            rows = np.flatnonzero(sizes == n)
            for at in range(0, len(rows), 512):
                part = rows[at:at + 512]
                e = int(self.edits[seg[part[0]]])
                # band b holds the diagonals (b - 1)(e + 1) .. (b + 1)(e + 1) - 1
                low = (band[part] - 1) * (e + 1) - SEGMENT
                patterns = self.flat[self.begin[seg[part]][:, None] + np.arange(n)]
                for row, found in aligned(patterns, points, low, 2 * (e + 1), e):
                    yield int(seg[part[row]]), *found


def aligned(patterns: np.ndarray, points: np.ndarray, low: np.ndarray, width: int,
            limit: int) -> list[tuple[int, tuple]]:
    """(row, (start, length, edits)) of the best alignment of each pattern in its band of diagonals.

    A band starts at diagonal ``low`` and is widened by ``limit`` on both sides; alignments may start
    and end on any of its diagonals.
    """
    n, cols = patterns.shape[1], width + 2 * limit + 1
    base = low - limit
    steps = np.arange(cols)
    cost = np.zeros((len(low), cols), np.int32)
    start = np.broadcast_to(base[:, None] + steps, cost.shape).copy()
    far = np.int32(1 << 20)
    for i in range(n):
        at = base[:, None] + steps + i
        inside = (at >= 0) & (at < len(points))
        same = inside & (points[np.where(inside, at, 0)] == patterns[:, i:i + 1])
        new = cost + np.where(same, 0, 1).astype(np.int32)
        new[~inside] = far
        skip = np.concatenate([cost[:, 1:] + 1, np.full((len(low), 1), far, np.int32)], 1)  # a pattern character missing
        skip_start = np.concatenate([start[:, 1:], start[:, :1]], 1)
        start = np.where(skip < new, skip_start, start)
        new = np.minimum(new, skip)
        flat = np.minimum.accumulate(new - steps, axis=1)                   # extra text characters
        from_col = np.maximum.accumulate(np.where(new - steps == flat, steps, 0), axis=1)
        cost = (flat + steps).astype(np.int32)
        start = np.take_along_axis(start, from_col, 1)
    best = cost.argmin(1)
    out = []
    for c in np.flatnonzero(cost.min(1) <= limit):
        end = int(base[c] + n + best[c])
        begin = max(int(start[c, best[c]]), 0)
        out.append((int(c), (begin, min(end, len(points)) - begin, int(cost[c, best[c]]))))
    return out


def text_matches(index: Index, texts: list) -> Iterator[tuple[int, tuple]]:
    """(place in ``texts``, (item, segment, start, length, edits)), the best match of each segment."""
    gap = np.zeros(SEGMENT * 2, "<u4")
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def search() -> Iterator[tuple[int, tuple]]:
        parts, starts, owners = [], [], []
        total = 0
        for owner, offset, p in held:
            parts += [p, gap]
            starts.append(total)
            owners.append((owner, offset))
            total += len(p) + len(gap)
        best: dict[tuple, tuple] = {}
        for s, at, length, edits in index.regions(np.concatenate(parts)):
            k = int(np.searchsorted(starts, at + length // 2, "right")) - 1
            owner, offset = owners[k]
            found = (edits, at - starts[k] + offset, length)
            best[owner, s] = min(found, best.get((owner, s), found))
        for (owner, s), (edits, at, length) in sorted(best.items()):
            yield owner, (index.item[s], int(index.number[s]), at, length, edits)

    overlap = SEGMENT * 2
    for i, text in enumerate(texts):
        if not text:
            continue
        text = normalized(text)
        for item_id in index.short.get(text, ()):
            yield i, (item_id, 0, 0, len(text), 0)
        p = code_points(text)
        for at in range(0, max(len(p) - overlap, 1), SLICE):
            part = p[at:at + SLICE + overlap]
            held.append((i, at, part))
            size += len(part)
            if size >= BATCH:
                yield from search()
                held, size = [], 0
    if held:
        yield from search()


def benchmark_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[Index]:
    """The items in blocks of about ``block_chars`` characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield Index.of(sorted(((r["item_id"], r["text"]) for r in items.where(part == b).collect()),
                              key=lambda r: (r[0] is None, r)))


def matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """REGION_SCHEMA: verified matches of benchmark segments in ``docs`` (doc_id, text).

    ``start`` and ``length`` are in characters of the normalized text.
    """
    def scan(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[i], *m) for i, m in text_matches(shared.value, batch.column(1).to_pylist())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                     [c.split()[0] for c in REGION_SCHEMA.split(", ")])

        return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, REGION_SCHEMA)

    out = None
    for index in benchmark_blocks(benchmark, block_chars):
        found = scan(index)
        out = found if out is None else out.union(found)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: best segment's edits, place and number of segments."""
    best = F.min(F.struct("edits", "start", "length"))
    return matches(docs, benchmark).groupBy("doc_id", "item_id").agg(
        best.alias("best"), F.countDistinct("segment").cast("int").alias("n_segments")) \
        .select("doc_id", "item_id", "n_segments", "best.edits", "best.start", "best.length")


def clean_conditions(benchmark: DataFrame, text: Column, block_chars: int = BLOCK_CHARS) -> Iterator[Column]:
    """Conditions, one a block of the benchmark, that hold for texts without a match."""
    def condition(index: Index) -> Column:
        shared = benchmark.sparkSession.sparkContext.broadcast(index)

        @F.pandas_udf("boolean")
        def is_clean(texts: pd.Series) -> pd.Series:
            out = np.ones(len(texts), bool)
            for i, _ in text_matches(shared.value, list(texts)):
                out[i] = False
            return pd.Series(out)

        return is_clean(text)

    for index in benchmark_blocks(benchmark, block_chars):
        yield condition(index)

"""Near-duplicate classes by DartMinHash over word shingles.

**Signatures.** A text is the weighted set of its five-word shingles.  Each element owns a region of
width equal to its weight; hashed darts land in it, each with a rank (when it is thrown), a place
in the region and one of k coordinates.  Darts depend on the element alone, so texts that share
an element share its darts up to the smaller weight.  The earliest dart of each coordinate is the
signature: two signatures agree in a coordinate with probability equal to the weighted Jaccard
similarity.  Ranks are drawn in growing intervals until a text's coordinates are all filled, so
a text costs about k log k darts however long it is.  With ``counts`` (the default) an element weighs its
number of occurrences, otherwise 1.

**Classes.** Texts with the same words are one node.  Nodes that agree in all rows of a band are
candidates.  A band's nodes are first verified against its smallest node; verified links merge
nodes into components.  Bands that still hold several components get ``LEADERS`` more leaders, the smallest nodes
by other hashes, which joins what the first one was not near to.  In bands that hold several components even
then, every node outside the band's largest component is compared with all nodes of others, in blocks of bounded size, each
pair in the first band they share.  Every candidate pair is so verified or already linked through others: no
pair is capped or sampled, and no group's pairs are listed.

**Similarity.** A word of a text is shared if a five-word shingle around it occurs in the other text.  The similarity
of two texts is the shared part of their words, of the text with the smaller one; a link takes ``threshold`` (0.8).
A changed word costs five shingles but only itself, so copies with every tenth word changed still link, while the
Jaccard similarity of their shingles is about 0.45.  The bands are laid out for that: 96 bands of 4 rows,
in two layers over 192 coordinates, each of which serves one band of a layer.  Were they independent, they would miss a
pair at Jaccard similarity 0.45 with probability 0.02, at 0.5 with 0.002, at 0.6 with 2e-6; of 400 pairs of texts of 60 to
400 words with every twelfth word changed they miss 2.5 % (48 bands: 8.5 %).  Fewer rows would make candidates of all
texts that share a common passage.  Verification is exact.

**Hot keys.** Texts that very many rows hold, and bands and leaders of very many nodes (more than ``HOT``), are
joined by broadcast of these few (their number is bounded by the rows divided by ``HOT``, and checked in bytes) or
dealt into parts, so that no task gets all rows of one.

Defined results: a text of 1 to 4 words is a single shingle; a text without words (null, empty) is
like no other; rows of one id are one document, linked by any of their texts; a null id
belongs to no class (class_id null, kept); an empty table gives an empty result; other
columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import WORD, WordHashes, hash_words, mix64, staged
from starforge.llm.components import components
from starforge.operators.joins import broadcast_if_small

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES, BANDS, ROWS = 192, 96, 4
LEADERS = 4
BLOCK = 256
# A text, band or leader of more rows than this is hot.
HOT = 512
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)
_MOST_CELLS = 64


def shingles(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the text's five-word shingles, in order, with repeats."""
    words = WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = hash_words(words, cache)
    if len(h) < SHINGLE:
        return mix64(np.array([np.sum(h * _MIX[:len(h)], dtype=np.uint64) + np.uint64(len(h))], np.uint64))
    out = h[:len(h) - SHINGLE + 1] * _MIX[0]
    for j in range(1, SHINGLE):
        out = out + h[j:len(h) - SHINGLE + 1 + j] * _MIX[j]
    return mix64(out)


def weighted(elements: np.ndarray, counts: bool) -> tuple[np.ndarray, np.ndarray]:
    """(distinct elements, weights) of a text."""
    distinct, n = np.unique(elements, return_counts=True)
    return distinct, n.astype(float) if counts else np.ones(len(distinct))


def _intervals() -> Iterator[tuple[float, float, int]]:
    """(first rank, width, number) of equally wide rank intervals, in the fixed order of drawing."""
    yield from ((0.0, 1 / 64, 1), (1 / 64, 3 / 64, 1), (1 / 16, 3 / 16, 1), (1 / 4, 3 / 4, 1), (1.0, 1.0, 1))
    at, n = 2, 2
    while True:
        yield float(at), 1.0, n
        at, n = at + n, min(2 * n, _MOST_CELLS)


def dart_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, owners: int, k: int) -> np.ndarray:
    """(owners, k) signatures of weighted sets; row i holds the elements with ``owner`` i.

    Weights above 1 are split into unit cells of the region; every (element, cell, rank
    interval) draws its own Poisson number of darts.
    """
    cells = np.ceil(weight).astype(np.int64)
    cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    owner, element = np.repeat(owner, cells), np.repeat(element, cells)
    part = np.minimum(np.repeat(weight, cells) - cell, 1.0)    # how much of its unit cell the element has
    element = mix64(element + cell.astype(np.uint64) * _MIX[1])
    empty = np.uint64(2 ** 64 - 1)
    out = np.full(owners * k, empty, np.uint64)
    for low, mean, many in _intervals():
        if not len(owner):
            break
        # one row for every element and interval
        interval = np.tile(np.arange(many, dtype=np.uint64), len(owner))
        who, wide = np.repeat(owner, many), np.repeat(part, many)
        first = np.uint64(int(low * 64) + 1) + interval * np.uint64(64)
        seed = mix64(np.repeat(element, many) ^ (first * _MIX[0]))
        u = (seed >> np.uint64(11)) * (1.0 / 2 ** 53)
        # cumulative Poisson probabilities of an interval's expected number of darts
        cdf, p = [], np.exp(-mean)
        for j in range(12):
            cdf.append((cdf[-1] if cdf else 0.0) + p)
            p *= mean / (j + 1)
        some = np.flatnonzero(u >= cdf[0])
        n = np.searchsorted(cdf, u[some], "right")
        at = np.repeat(some, n)
        number = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        dart = mix64(seed[at] + (number.astype(np.uint64) + np.uint64(1)) * _MIX[2])
        coordinate = (mix64(dart + _MIX[3]) % np.uint64(k)).astype(np.int64)
        place = (mix64(dart + _MIX[4]) >> np.uint64(11)) * (1.0 / 2 ** 53)
        hit = place < wide[at]
        # earliest: by interval, then by a hash that also names the dart
        key = who[at[hit]] * k + coordinate[hit]
        new = np.full(owners * k, empty, np.uint64) if len(key) > owners * k // 8 else None
        rank = (interval[at[hit]] << np.uint64(58)) | (dart[hit] >> np.uint64(6))
        free = out[key] == empty
        key, rank = key[free], rank[free]
        if new is None:
            np.minimum.at(out, key, rank)
        else:
            np.minimum.at(new, key, rank)
            out = np.where(out == empty, new, out)
        open_rows = (out.reshape(owners, k) == empty).any(axis=1)
        live = open_rows[owner]
        owner, element, part = owner[live], element[live], part[live]
    return out.reshape(owners, k)


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(owners, bands) hashes of the bands' coordinates.

    Each layer of ``width`` bands uses every coordinate once, one from each ``width`` wide stretch; the next layer shifts the
    stretches against each other, so that bands of different layers share at most one coordinate.
    """
    width = signatures.shape[1] // rows
    layer, first = np.divmod(np.arange(bands), width)
    out = np.zeros((len(signatures), bands), np.uint64)
    for r in range(rows):
        out = mix64(out * _MIX[0] + signatures[:, r * width + (first + layer * r) % width])
    return mix64(out + np.arange(bands, dtype=np.uint64)).view(np.int64)


def signature_table(docs: DataFrame, counts: bool = True, bands: int = BANDS, rows: int = ROWS,
                    k: int = COORDINATES) -> DataFrame:
    """(doc_id, fp, bands): ``fp`` is a hash of the word sequence; both null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        cache = WordHashes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                fps, elements, weights, owners, here = [], [], [], [], at
                size = 0
                while at < len(texts) and size < 150_000 and at - here < 2000:
                    all_shingles = shingles(texts[at], cache)
                    fps.append(xxhash.xxh3_128_digest(all_shingles.tobytes()) if len(all_shingles) else None)
                    e, w = weighted(all_shingles, True) if counts else (all_shingles, np.ones(len(all_shingles)))
                    elements.append(e)
                    weights.append(w)
                    owners.append(np.full(len(e), at - here))
                    size += len(e)
                    at += 1
                n = at - here
                lists = band_hashes(dart_signatures(np.concatenate(owners), np.concatenate(elements),
                                                    np.concatenate(weights), n, k), bands, rows)
                column = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()),
                                                  pa.array(lists.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[here:at], pa.int64()), batch.column(2).slice(here, n),
                                                  pa.array(fps, pa.binary()), column],
                                                 ["doc_id", "text_hash", "fp", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .withColumn("text_hash", F.xxhash64("text")) \
        .mapInArrow(run, "doc_id long, text_hash long, fp binary, bands array<long>")


def with_texts(rows: DataFrame, node: str, nodes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``rows`` with the text of their node ``node``: that of one of the rows it was taken from."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")) \
        .withColumn("_h", F.xxhash64("_text")).groupBy("_id", "_h").agg(F.first("_text").alias(text))
    source = nodes.select(F.col("node").alias("_node"), F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    return rows.join(source, F.col(node) == F.col("_node")) \
        .join(texts, (F.col("_doc") == F.col("_id")) & (F.col("_hash") == F.col("_h"))) \
        .drop("_node", "_doc", "_hash", "_id", "_h")


def shared_part(own: np.ndarray, other: np.ndarray) -> float:
    """Share of the words behind the shingles ``own`` that lie in a shingle of ``other``."""
    hit = np.isin(own, other)
    if len(own) == 1:
        return float(hit[0])
    edges = np.zeros(len(own) + SHINGLE, np.int64)
    np.add.at(edges, np.flatnonzero(hit), 1)
    np.add.at(edges, np.flatnonzero(hit) + SHINGLE, -1)
    return float((np.cumsum(edges)[:-1] > 0).mean())


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The smaller shared part of two texts, by their shingles."""
    return min(shared_part(a, b), shared_part(b, a))


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of distinct ``pairs`` (a, b) whose texts reach ``threshold``.

    The texts of both ends are joined one after the other; the smaller node, which may be in
    many pairs, last, so that its pairs come sorted by it.  Pairs of a hot node are dealt into parts, each of which
    gets a copy of its text.
    """
    sizes = staged(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HOT).cast("int").alias("parts")), "leader-sizes")
    hot = broadcast_if_small(sizes.where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"))
    leaders = with_texts(sizes, "a", nodes, docs, "text_a").select(
        F.col("a").alias("_a"), "text_a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_part"))
    with_b = with_texts(dealt, "b", nodes, docs, "text_b")
    both = with_b.join(leaders, (F.col("a") == F.col("_a")) & (F.col("part") == F.col("_part"))) \
        .select("a", "b", "text_b", "text_a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        last, last_shingles = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i, (text_b, text_a) in enumerate(zip(batch.column(2), batch.column(3))):
                text_a = text_a.as_py()
                if text_a != last:
                    last, last_shingles = text_a, shingles(text_a, cache)
                keep.append(similarity(last_shingles, shingles(text_b.as_py(), cache)) >= threshold)
            rows = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in rows], pa.int64()),
                                              pa.array([b[i] for i in rows], pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


class SharedParts:
    """Shared parts of several texts, by their shingles, in one other text at a time.

    The places of every shingle are kept together, so that another text costs the places of the shingles it shares,
    not all words of the texts.
    """

    def __init__(self, texts: list[np.ndarray]):
        self.vocabulary, codes = np.unique(np.concatenate(texts), return_inverse=True)
        sizes = np.array([len(t) for t in texts])
        self.words = sizes + SHINGLE - 1
        text = np.repeat(np.arange(len(texts)), sizes)
        # the word at which each shingle begins, all texts one after the other
        place = np.arange(len(text)) + text * (SHINGLE - 1)
        self.text_at = np.repeat(np.arange(len(texts)), self.words)
        self.places = place[np.argsort(codes, kind="stable")]
        self.many = np.bincount(codes, minlength=len(self.vocabulary))
        self.first = np.cumsum(self.many) - self.many

    def within(self, other: np.ndarray) -> np.ndarray:
        """``shared_part`` of every text in ``other``."""
        at = np.minimum(np.searchsorted(self.vocabulary, other), len(self.vocabulary) - 1)
        held = np.unique(at[self.vocabulary[at] == other])
        many = self.many[held]
        if not len(held):
            return np.zeros(len(self.words))
        hit = self.places[np.arange(many.sum()) + np.repeat(self.first[held] - np.cumsum(many) + many, many)]
        if 8 * len(hit) > len(self.text_at):     # many places are put in order by marking them
            marks = np.zeros(len(self.text_at), bool)
            marks[hit] = True
            hit = np.flatnonzero(marks)
        else:
            hit = np.sort(hit)
        # a shingle covers its words up to the next hit; the next text's first one is at least a shingle away
        new = np.minimum(np.diff(hit, append=hit[-1] + SHINGLE), SHINGLE)
        return np.bincount(self.text_at[hit], new, len(self.words)) / self.words


def block_links(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links among the nodes of one block of a band, as a forest of (a, b).

    Compares the band's ``seeker`` nodes with the block's own ones where components differ and no earlier
    band (``bands`` has those of a node) holds both; two seekers meet in the block of the larger one.  A seeker meets all
    own nodes in one pass, and those with a large enough part in it are then compared the other way round.
    """
    cache = WordHashes()
    node, label, seeker = (rows[c].to_numpy() for c in ("node", "label", "seeker"))
    own = np.flatnonzero(~seeker)
    if not len(own):
        return pd.DataFrame([], columns=["a", "b"])
    texts, bands = rows["text"].to_list(), [np.asarray(b, np.int64) for b in rows["bands"]]
    # the earlier bands of the own nodes in order, with the nodes that hold them
    band_at = np.concatenate([bands[j] for j in own])
    holder = np.repeat(np.arange(len(own)), [len(bands[j]) for j in own])[np.argsort(band_at, kind="stable")]
    band_at = np.sort(band_at)
    own_shingles = [shingles(texts[j], cache) for j in own]
    parts = SharedParts(own_shingles)
    outside = np.isin(node[own], node[seeker])

    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i in np.flatnonzero(seeker):
        earlier = np.zeros(len(own), bool)
        first, last = (np.searchsorted(band_at, bands[i], side) for side in ("left", "right"))
        for j in np.flatnonzero(first < last):
            earlier[holder[first[j]:last[j]]] = True
        open_ones = ~earlier & (label[own] != label[i]) & ~(outside & (node[own] < node[i]))
        if not open_ones.any():
            continue
        mine = shingles(texts[i], cache)
        for j in np.flatnonzero(open_ones & (parts.within(mine) >= threshold)):
            r, t = find(label[i]), find(label[own[j]])
            if r != t and shared_part(mine, own_shingles[j]) >= threshold:
                root[t] = r
                links.append((node[i], node[own[j]]))
    return pd.DataFrame(links, columns=["a", "b"])


def join_hot(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (unique in ``key``); rows of the keys of ``hot`` stay where they are."""
    hot = broadcast_if_small(hot.select(key))
    few = broadcast_if_small(table.join(hot, key, "left_semi"))
    return rows.join(few, key).unionByName(rows.join(hot, key, "left_anti").join(table, key, how), allowMissingColumns=True)


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, counts: bool = True) -> DataFrame:
    """(doc_id, class_id, kept), one row per row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest id reachable by links, ``kept`` whether it is the row's own.
    """
    table = staged(signature_table(docs, counts), "signatures")
    # a text is one node, whatever ids hold it
    nodes = staged(table.where("fp is not null and doc_id is not null").groupBy("fp")
                   .agg(F.min(F.struct("doc_id", "text_hash")).alias("_row"), F.first("bands").alias("bands"),
                        F.count(F.lit(1)).alias("rows"))
                   .select("fp", F.col("_row.doc_id").alias("doc"), F.col("_row.text_hash").alias("text_hash"), "bands", "rows",
                           F.monotonically_increasing_id().alias("node")), "nodes")
    # ids whose rows have several texts, or texts with and without words, and links among their nodes
    several = staged(table.where("doc_id is not null").groupBy("doc_id")
                     .agg(F.min("fp").alias("_f"), F.max("fp").alias("_l"), F.count("fp").alias("_n"), F.count(F.lit(1)).alias("_m"))
                     .where("_f != _l or _n between 1 and _m - 1").select("doc_id"), "several-texts")
    held = staged(table.join(several, "doc_id").select("doc_id", "fp").distinct()
                  .join(nodes.select("fp", "node"), "fp").select("doc_id", "node"), "several-nodes")
    ties = held.join(held.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id") \
        .where("node != a").select("a", F.col("node").alias("b"))
    entries = nodes.select("node", F.explode("bands").alias("band"))
    crowded = staged(entries.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1"),
                     "crowded-bands")
    members = staged(join_hot(entries, crowded, "band", crowded.where(F.col("n") > HOT)), "band-members")
    pairs = staged(members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = staged(verified(pairs, nodes, docs, threshold).union(ties), "leader-links")
    roots = components(links, "a", "b")

    def mixed_bands() -> DataFrame:
        """(band, node, label) of bands that still hold several components."""
        labelled = members.select("band", "node").join(roots.distinct(), "node", "left") \
            .withColumn("label", F.coalesce("root", "node")).drop("root")
        mixed = labelled.groupBy("band").agg(F.min("label").alias("_l"), F.max("label").alias("_h"),
                                             F.count(F.lit(1)).alias("_n")).where("_l != _h and _n > 2")
        return staged(labelled.join(mixed.select("band"), "band"), "mixed-bands")

    rest = mixed_bands()
    if rest.take(1):
        ahead = [F.min(F.struct(F.xxhash64(F.lit(s), "node").alias("h"), "node", "label")) for s in range(LEADERS)]
        leaders = rest.groupBy("band").agg(F.array(*ahead).alias("l")).select("band", F.explode("l").alias("l"))
        pairs = rest.join(leaders, "band").where(F.col("label") != F.col("l.label")) \
            .select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct()
        links = staged(links.union(verified(staged(pairs, "more-pairs"), nodes, docs, threshold)), "more-links")
        roots = components(links, "a", "b")
        rest = mixed_bands()
    if rest.take(1):
        sizes = rest.groupBy("band", "label").agg(F.count(F.lit(1)).alias("_m")).groupBy("band").agg(
            F.max(F.struct("_m", "label")).alias("_top"), F.sum("_m").alias("_n"))
        # Of a node's bands only these still matter: in the others its pairs are linked or compared.  A row carries
        # those before its own band, in the order of the hashes, and not all bands of the node.
        known = with_texts(rest.groupBy("node").agg(F.collect_list("band").alias("bands")), "node", nodes, docs, "text")
        blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
        dealt = rest.join(sizes, "band").join(known, "node") \
            .withColumn("bands", F.filter("bands", lambda band: band < F.col("band")))
        columns = ["band", "block", "node", "label", "seeker", "bands", "text"]
        own = dealt.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("seeker", F.lit(False))
        seekers = dealt.where(F.col("label") != F.col("_top.label")) \
            .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("seeker", F.lit(True))
        more = own.select(*columns).union(seekers.select(*columns)).groupBy("band", "block").applyInPandas(
            lambda rows: block_links(rows, threshold), "a long, b long")
        links = staged(links.union(more), "all-links")
        roots = components(links, "a", "b")

    rooted = nodes.select("node", "doc").join(roots.distinct(), "node")
    least = rooted.groupBy("root").agg(F.min("doc").alias("least"))
    merged = staged(rooted.join(least, "root").select("node", "least"), "merged-nodes")
    classes = nodes.select("fp", "node", "doc").join(merged, "node", "left") \
        .select("fp", F.coalesce("least", "doc").alias("class_id"))
    # rows without words of ids that have others
    own = held.join(nodes.select("node", "doc"), "node").join(merged, "node", "left") \
        .groupBy("doc_id").agg(F.min(F.coalesce("least", "doc")).alias("own"))
    texts = join_hot(table.where("fp is not null").select("doc_id", "fp"), staged(classes, "classes"), "fp",
                     nodes.where(F.col("rows") > HOT), "left")
    without = table.where("fp is null").select("doc_id", "fp").withColumn("class_id", F.lit(None).cast("long"))
    joined = texts.unionByName(without).join(broadcast_if_small(staged(own, "own-classes")), "doc_id", "left") \
        .withColumn("class_id", F.coalesce("class_id", "own", "doc_id"))
    return joined.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")) \
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("class_id")))


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of ``docs`` of the kept documents, one row per id; rows without an id stay."""
    kept = classes.where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi").dropDuplicates(["doc_id"])
    return named.union(docs.where("doc_id is null"))

"""Language identification by a byte convolutional network.

The lower-cased UTF-8 bytes of a text are cut into windows of ``WINDOW`` bytes.  A window's
bytes are embedded; filters of several widths slide over it, each keeps its largest
response (max pooling), and a softmax over the pooled responses gives the window's
language probabilities.  A text's probabilities are the mean over its windows, weighted by
their bytes, so whole texts count at any length.

The network is trained here in numpy on windows of labelled rows: at most ``max_rows`` rows
of each language (by a hash of the id), at most ``WINDOWS_PER_ROW`` windows of each row.
For prediction the first layer is turned into tables indexed by byte pairs, and windows
are read position by position with a running maximum.

Defined results: null text and text without a letter give ``und`` with score 0; without any
labelled row every text does; rows are neither merged nor dropped, so repeated rows and
null ids are predicted like others; other columns of the input are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import id_remainder

WINDOW = 128
WINDOWS_PER_ROW = 3
WIDTHS = (2, 3, 4)
FILTERS = 10
DIM = 8
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def windows_of(text: str) -> np.ndarray:
    """The text's bytes as rows of WINDOW bytes; the last row ends with zeros."""
    raw = text.lower().encode("utf-8")
    raw += b"\0" * (-len(raw) % WINDOW)
    return np.frombuffer(raw, np.uint8).reshape(-1, WINDOW)


class ByteCnn:
    """Embedding, convolutions, max pooling and softmax; trained with Adam."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"emb": rng.normal(0, 0.5, (256, DIM)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, (2 / (w * DIM)) ** 0.5, (w * DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["v"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.p["c"] = np.zeros(len(classes), np.float32)
        self.p["emb"][0] = 0

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        p, n = self.p, len(x)
        e = p["emb"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            patches = np.concatenate([e[:, j:WINDOW - w + 1 + j] for j in range(w)], axis=2)
            h = patches @ p[f"w{w}"] + p[f"b{w}"]
            at = h.argmax(axis=1)
            top = np.take_along_axis(h, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            kept.append((patches, at, top > 0))
        f = np.concatenate(pooled, axis=1)
        z = f @ p["v"] + p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        dz = q
        dz[np.arange(n), y] -= 1
        dz /= n
        g = {"v": f.T @ dz, "c": dz.sum(0), "emb": np.zeros_like(p["emb"])}
        df = dz @ p["v"].T
        for k, w in enumerate(WIDTHS):
            patches, at, live = kept[k]
            d = df[:, k * FILTERS:(k + 1) * FILTERS] * live
            best = np.take_along_axis(patches, at[:, :, None], 1)          # (n, FILTERS, w * DIM)
            g[f"w{w}"] = np.einsum("nf,nfd->df", d, best)
            g[f"b{w}"] = d.sum(0)
            back = (d[:, :, None] * p[f"w{w}"].T[None]).reshape(n, FILTERS, w, DIM)
            for j in range(w):
                np.add.at(g["emb"], np.take_along_axis(x, at + j, 1), back[:, :, j])
        g["emb"][0] = 0
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 4e-3) -> ByteCnn:
        rng = np.random.default_rng(11)
        m, v, step = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2)), None, 0
        m, v = m
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                part = x[rows].copy()
                for i in np.flatnonzero(rng.random(len(rows)) < 0.3):   # short texts
                    part[i, rng.integers(12, WINDOW):] = 0
                g, step = self.gradients(part, y[rows]), step + 1
                lr = rate * (1 - epoch / epochs)
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """First-layer responses by byte pair: of the pair a filter starts with, and of the pair two on."""
        e = self.p["emb"]

        def pair(w: int, j: int) -> np.ndarray:
            k = self.p[f"w{w}"]
            first, second = e @ k[j * DIM:(j + 1) * DIM], e @ k[(j + 1) * DIM:(j + 2) * DIM]
            return (first[:, None] + second[None]).reshape(65536, -1)

        single = np.repeat(e @ self.p["w3"][2 * DIM:], 256, axis=0)
        return (np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0)], 1).astype(np.float32),
                np.concatenate([single, pair(4, 2)], 1).astype(np.float32))

    def probabilities(self, x: np.ndarray, tables) -> np.ndarray:
        start, later = tables
        codes = np.ascontiguousarray(x.T).astype(np.intp)
        codes = codes[:-1] * 256 + codes[1:]                                # (WINDOW - 1, n)
        n, f = len(x), FILTERS
        top = np.full((n, 3 * f), -np.inf, np.float32)
        here, ahead = np.empty((n, 3 * f), np.float32), np.empty((n, 2 * f), np.float32)
        for i in range(WINDOW - 1):
            np.take(start, codes[i], axis=0, out=here, mode="clip")
            if i + 2 < WINDOW - 1:
                np.take(later, codes[i + 2], axis=0, out=ahead, mode="clip")
                here[:, f:] += ahead
                np.maximum(top, here, out=top)
            elif i + 2 < WINDOW:  # the last place of the width-3 filters
                here[:, f:2 * f] += start_of_single(later, codes[i + 1], f)
                np.maximum(top[:, :2 * f], here[:, :2 * f], out=top[:, :2 * f])
            else:
                np.maximum(top[:, :f], here[:, :f], out=top[:, :f])
        bias = np.concatenate([self.p[f"b{w}"] for w in WIDTHS])
        z = np.maximum(top + bias, 0) @ self.p["v"] + self.p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        return q / q.sum(1, keepdims=True)


def start_of_single(later: np.ndarray, codes: np.ndarray, f: int) -> np.ndarray:
    """The width-3 filters' last byte as the second byte of the pair ``codes``."""
    return later[(codes % 256) * 256, :f]


def labelled_windows(rows: DataFrame, max_rows: int) -> DataFrame:
    """(lang, window) of at most about ``max_rows`` rows of each language, chosen by a hash of the id."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = {r["lang"]: min(1.0, max_rows / r["count"]) for r in rows.groupBy("lang").count().collect()}
    if not share:
        return rows.sparkSession.createDataFrame([], "lang string, window binary")
    limits = F.create_map(*[F.lit(v) for k in sorted(share) for v in (k, share[k])])
    u = F.pmod(F.xxhash64(F.lit(5), "doc_id", F.length("text")), F.lit(1_000_000)) / 1_000_000
    chosen = rows.where(u < F.element_at(limits, F.col("lang")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if _LETTER.search(text):
                    all_windows = windows_of(text)
                    for i in sorted({0, len(all_windows) // 2, len(all_windows) * 3 // 4})[:WINDOWS_PER_ROW]:
                        out.append((lang, all_windows[i].tobytes()))
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary())],
                                             ["lang", "window"])

    return chosen.select("lang", "text").mapInArrow(cut, "lang string, window binary")


def fit(docs: DataFrame, max_rows: int = 1500) -> ByteCnn | None:
    """Network trained on the labelled rows of ``docs`` (doc_id, text, lang); None without any."""
    sample = labelled_windows(docs, max_rows).collect()  # bounded: max_rows * WINDOWS_PER_ROW windows a language
    if not sample:
        return None
    sample.sort()  # independent of the order in which tasks end
    classes = sorted({r["lang"] for r in sample})
    x = np.frombuffer(b"".join(bytes(r["window"]) for r in sample), np.uint8).reshape(-1, WINDOW)
    y = np.array([classes.index(r["lang"]) for r in sample])
    return ByteCnn(classes).train(x, y)


def text_languages(model: ByteCnn, tables, texts: list, group: int = 2048) -> tuple[list[str], list[float]]:
    """Language and score of every text."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    sums = np.zeros((len(texts), len(model.classes)))
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush() -> None:
        if held:
            x = np.concatenate(held)
            q = np.concatenate([model.probabilities(x[i:i + group], tables) for i in range(0, len(x), group)])
            np.add.at(sums, np.concatenate(owners), q * (x != 0).sum(1, keepdims=True))
        held.clear()
        owners.clear()

    known, size = [i for i, t in enumerate(texts) if t and _LETTER.search(t)], 0
    for i in known:
        w = windows_of(texts[i])
        for at in range(0, len(w), 8 * group):  # a very long text takes several turns
            held.append(w[at:at + 8 * group])
            owners.append(np.full(len(held[-1]), i))
            size += len(held[-1])
            if size >= 8 * group:
                flush()
                size = 0
    flush()
    total = sums.sum(1)
    for i in known:
        best = int(sums[i].argmax())
        langs[i], scores[i] = model.classes[best], float(sums[i, best] / max(total[i], 1e-12))
    return langs, scores


def predict(docs: DataFrame, model: ByteCnn | None, columns: list[str]) -> DataFrame:
    """``columns`` of every row of ``docs`` with ``lang_pred`` and ``score``."""
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else None
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            langs, scores = text_languages(model, tables, texts) if model else \
                ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], names)

    return docs.select(*columns, F.col("text").alias("_text")).mapInArrow(run, schema)


def with_known_language(docs: DataFrame, min_score: float, held_out: int = 2, modulus: int = 4) -> DataFrame:
    """Rows of ``docs`` whose text has a language with at least ``min_score``, with the columns of ``docs``.

    Without any labelled row nothing can be told and all rows stay.
    """
    model = fit(docs.where(id_remainder(F.col("doc_id"), modulus) != held_out))
    if model is None:
        return docs

    @F.pandas_udf("boolean")
    def is_known(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = model.tables()
        for part in texts:
            langs, scores = text_languages(model, tables, list(part))
            yield pd.Series([lang != UNKNOWN and score >= min_score for lang, score in zip(langs, scores)], dtype=bool)

    return docs.where(is_known(F.col("text").cast("string")))


def identify_languages(docs: DataFrame, held_out: int = 2, modulus: int = 4) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from rows outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"),
                       (id_remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows, model, ["doc_id", "held_out"])

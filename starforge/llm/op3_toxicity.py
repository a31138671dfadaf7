"""Toxicity: a fuzzy lexicon matched by Levenshtein automata, read in context.

**Lexicon.** Words and word stems that mark toxic rows are learned from the distinct texts of
labelled rows: an entry is a word, or a stem of at least ``MIN_STEM`` letters, found in enough toxic
rows and far more often there than in clean ones.  Entries are taken by evidence.  A weak one is
taken only if it explains toxic rows that hold fewer than ``EXPLAINED`` entries so far; so the chance
words of copied toxic texts, which their real marks explain, stay out.  A mark in almost no clean row
with at least ``STRONG`` of the mean evidence of the entries beside it is always taken.

**Matching.** The entries form a trie.  Levenshtein automata of all entries run over it
together: a state is the set of (trie node, edits so far) still alive, and the transitions
met are remembered, so a token costs one table lookup a letter until no entry is left.
Words of 5 letters take one edit, of 9 two; stems of 7 letters one.

**Context.** Each hit is weighed by the ``CONTEXT`` tokens on either side: whether quotation marks
enclose it, whether reporting words introduce it, whether it addresses someone.  A hit that is
quoted or reported counts less than abuse.

**Score.** A logistic model over hits by entry and edits and over the context counts, fitted
to labelled rows with a penalty towards the values a lexicon would have by itself, so that
entries and contexts not seen in training still count.

Learning uses at most ``max_rows`` labelled rows (chosen by a hash of the id); scoring reads every
text whole.  Labels, lang, source and id are no inputs of a score.

Defined results: null and empty texts get the score of a text without hits; without usable labels
every score is 0; an id labelled twice counts as toxic if any label says so; null labels and
labels of unknown ids are ignored; repeated rows and null ids are scored like others; other
columns of the input are ignored.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import WORD, id_remainder, staged

MIN_STEM, MAX_STEM = 4, 8
CONTEXT = 8
EXPLAINED = 2
STRONG, ALMOST_NONE = 0.25, 0.01
# FIXED VALUES: quotation marks, and words that report or address, in the languages at hand.
QUOTES = re.compile("[\"“”„«»‹›]")
REPORTING = frozenset("said says wrote called calling quote quoted term word meaning sagte sagt schrieb nannte genannt "
                      "wort begriff dit écrit appelé appelle mot terme dijo dice escribió llamó palabra término".split())
ADDRESS = frozenset("you your youre u du dich dir dein ihr euch tu toi te ton vous votre tú ti usted vosotros".split())
PIECES = re.compile(r"\w+|[\"“”„«»‹›]")


class FuzzyLexicon:
    """Levenshtein automata of all entries over their trie, made deterministic as needed."""

    MAX_STATES = 100_000

    def __init__(self, entries: list[tuple[str, bool]]):
        """``entries``: (letters, is_stem)."""
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]        # entries ending at a node
        self.reach = [0]                          # most edits any entry below a node allows
        self.entries = entries
        self.edits = [self.allowed(letters, stem) for letters, stem in entries]
        for i, (letters, _) in enumerate(entries):
            node = 0
            self.reach[0] = max(self.reach[0], self.edits[i])
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], self.edits[i])
            self.ends[node].append(i)
        self.forget()

    @staticmethod
    def allowed(letters: str, stem: bool) -> int:
        if stem:
            return 1 if len(letters) >= 7 else 0
        return 2 if len(letters) >= 9 else 1 if len(letters) >= 5 else 0

    def forget(self) -> None:
        start, _ = self.close({0: 0}, {})
        self.ids = {(start, ()): 0}
        self.sets = [(dict(start), {})]
        self.moves: list[dict[str, int]] = [{}]
        self.found: list = [None]
        self.words: dict[str, tuple | None] = {}

    def close(self, alive: dict[int, int], stems: dict[int, int]):
        """Add what skipping entry letters reaches, and stems that are complete."""
        todo = list(alive.items())
        while todo:
            node, e = todo.pop()
            if alive.get(node, 99) < e:
                continue
            for i in self.ends[node]:
                if self.entries[i][1] and e <= self.edits[i]:
                    stems[i] = min(e, stems.get(i, 99))
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and e + 1 < alive.get(child, 99):
                    alive[child] = e + 1
                    todo.append((child, e + 1))
        return tuple(sorted(alive.items())), tuple(sorted(stems.items()))

    def step(self, state: int, c: str) -> int:
        alive, stems = self.sets[state]
        new: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] and e < new.get(node, 99):
                new[node] = e

        for node, e in alive.items():
            put(node, e + 1)                                     # a letter too many
            for letter, child in self.children[node].items():
                put(child, e + (letter != c))
        key = self.close(new, dict(stems))
        if not key[0] and not key[1]:
            nxt = -1
        elif key in self.ids:
            nxt = self.ids[key]
        else:
            nxt = self.ids[key] = len(self.sets)
            alive, stems = dict(key[0]), dict(key[1])
            self.sets.append((alive, stems))
            self.moves.append({})
            hits = [(e, -len(self.entries[i][0]), i) for i, e in stems.items()]
            hits += [(e, -len(self.entries[i][0]), i) for node, e in alive.items() for i in self.ends[node]
                     if e <= self.edits[i]]
            self.found.append((min(hits)[2], min(hits)[0]) if hits else None)
        self.moves[state][c] = nxt
        return nxt

    def match(self, token: str) -> tuple | None:
        """(entry, edits) of the nearest entry, or None."""
        if token in self.words:
            return self.words[token]
        if len(self.sets) > self.MAX_STATES or len(self.words) > 500_000:
            self.forget()
        state = 0
        for c in token:
            nxt = self.moves[state].get(c)
            state = self.step(state, c) if nxt is None else nxt
            if state < 0:
                break
        hit = self.words[token] = self.found[state] if state >= 0 else None
        return hit


class TextHits:
    """Hits of a text, looked up by white-space chunk and only read closely where there is one."""

    def __init__(self, lexicon: FuzzyLexicon):
        self.lexicon = lexicon
        self.chunks: dict[str, bool] = {}

    def any_hit(self, chunk: str) -> bool:
        if len(self.chunks) > 500_000:
            self.chunks.clear()
        r = self.chunks[chunk] = any(self.lexicon.match(w) for w in WORD.findall(chunk))
        return r

    def features(self, text: str | None) -> Counter:
        """Counts by (entry, edits), and of quoted, reported and addressing hits."""
        out: Counter = Counter()
        if not text:
            return out
        text = text.lower()
        known, any_hit = self.chunks, self.any_hit
        if not any([known[c] if c in known else any_hit(c) for c in text.split()]):
            return out
        tokens = PIECES.findall(text)
        match = self.lexicon.match
        for i, token in enumerate(tokens):
            hit = match(token)
            if hit:
                before, after = tokens[max(0, i - CONTEXT):i], tokens[i + 1:i + 1 + CONTEXT]
                out[hit] += 1
                out["hits"] += 1
                out["quoted"] += sum(map(_is_quote, before)) % 2 == 1 and any(map(_is_quote, after))
                out["reported"] += not REPORTING.isdisjoint(before)
                out["address"] += not (ADDRESS.isdisjoint(before) and ADDRESS.isdisjoint(after))
        return out


def _is_quote(token: str) -> bool:
    return QUOTES.match(token) is not None


def candidates_of(text: str) -> set[str]:
    """Words of a text and their stems (marked by ``*``), each once."""
    words = set(WORD.findall(text.lower()))
    out = {w for w in words if len(w) >= 3 and not w.isdigit()}
    for k in range(MIN_STEM, MAX_STEM + 1):
        out.update(w[:k] + "*" for w in words if len(w) > k)
    return out


def row_counts(rows: DataFrame, only: set[str] | None) -> DataFrame:
    """(entry, n): in how many texts of ``rows`` each candidate (of ``only``) occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c: Counter = Counter()
            for text in batch.column(0).to_pylist():
                found = candidates_of(text)
                c.update(found if only is None else found & only)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                             ["entry", "n"])

    return rows.select("text").mapInArrow(count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int, min_ratio: float = 6.0,
                  min_evidence: float = 30.0) -> list[tuple[str, bool, float]]:
    """(letters, is_stem, log ratio) of the entries learned from labelled rows (text, toxic).

    A candidate is ``min_ratio`` times as frequent in toxic rows, and the log-likelihood ratio of
    the difference reaches ``min_evidence``.  Of entries that continue each other the one with most
    evidence is kept, a longer one besides only if it is far more telling, a shorter one only if
    it is found in clearly more toxic rows.  Weak candidates have to explain ``support`` rows anew.
    """
    support = max(3, math.ceil(0.01 * n_toxic))
    # bounded: a candidate is in at least 1 % of the toxic rows of a bounded sample
    toxic = {r["entry"]: r["n"] for r in
             row_counts(sample.where("toxic = 1"), None).where(F.col("n") >= support).collect()}
    if not toxic:
        return []
    clean = {r["entry"]: r["n"] for r in row_counts(sample.where("toxic = 0"), set(toxic)).collect()}

    def ratio(e: str) -> float:
        return ((toxic[e] + 0.5) / (n_toxic + 1)) / ((clean.get(e, 0) + 0.5) / (n_clean + 1))

    def evidence(e: str) -> float:
        n1, n0 = toxic[e], clean.get(e, 0)
        share = (n1 + n0) / (n_toxic + n_clean)
        return 2 * sum(n * math.log(n / (share * m)) for n, m in ((n1, n_toxic), (n0, n_clean)) if n)

    strength = {e: evidence(e) for e in toxic if ratio(e) >= min_ratio}
    strong = sorted((e for e in strength if strength[e] >= min_evidence),
                    key=lambda e: (-round(strength[e], 6), e.endswith("*"), -len(e), e))
    holders: dict[str, list[int]] = {e: [] for e in strong}
    for row, held in enumerate(row_entries(sample.where("toxic = 1"), set(strong))):
        for e in held:
            holders[e].append(row)
    kept: list[str] = []
    beside: list[list[float]] = [[] for _ in range(n_toxic)]     # evidence of the entries kept so far in each row
    for e in strong:
        word = e.rstrip("*")
        shorter = [k for k in kept if k.endswith("*") and word.startswith(k[:-1])]
        longer = [k for k in kept if e.endswith("*") and k.startswith(word)]
        others = [beside[row] for row in holders[e] if len(beside[row]) >= EXPLAINED]
        new = len(holders[e]) - len(others) >= support
        if not new and clean.get(e, 0) <= ALMOST_NONE * toxic[e]:
            by = [x for row in others for x in row]
            new = strength[e] >= STRONG * math.fsum(by) / len(by)
        if new and all(ratio(e) >= 3 * ratio(k) for k in shorter) \
                and all(toxic[e] >= 1.3 * toxic[k] for k in longer):
            kept.append(e)
            for row in holders[e]:
                beside[row].append(strength[e])
    return [(e.rstrip("*"), e.endswith("*"), min(5.0, math.log(ratio(e)))) for e in kept]


def row_entries(rows: DataFrame, only: set[str]) -> list[list[str]]:
    """Which of ``only`` each row of the (bounded) sample holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(candidates_of(t) & only) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["entries"])

    return sorted(r["entries"] for r in rows.select("text").mapInArrow(run, "entries array<string>").collect())


class ToxicityModel:
    """Lexicon and logistic weights; ``features`` are (entry, edits) pairs and context names."""

    def __init__(self, entries: list[tuple[str, bool, float]]):
        self.entries = entries
        self.lexicon = FuzzyLexicon([(letters, stem) for letters, stem, _ in entries])
        self.names = [(i, e) for i in range(len(entries)) for e in range(self.lexicon.edits[i] + 1)]
        self.names += ["hits", "quoted", "reported", "address"]
        self.index = {n: k for k, n in enumerate(self.names)}
        self.weights = np.array([(1.0, 0.6, 0.4)[n[1]] * entries[n[0]][2] if isinstance(n, tuple) else
                                 {"hits": 0.5, "quoted": -2.0, "reported": -1.0, "address": 0.5}[n]
                                 for n in self.names])
        self.bias = -3.0

    def __getstate__(self):
        return {"entries": self.entries, "weights": self.weights, "bias": self.bias}

    def __setstate__(self, state):
        self.__init__(state["entries"])
        self.weights, self.bias = state["weights"], state["bias"]

    def fit(self, rows: list[tuple[dict, int]], penalty: float = 0.5, rounds: int = 25) -> ToxicityModel:
        """Damped Newton steps on (features, label), penalized towards the starting weights."""
        x = np.zeros((len(rows), len(self.names) + 1))
        x[:, -1] = 1
        for i, (features, _) in enumerate(rows):
            for k, v in features.items():
                x[i, k] = math.log1p(v)
        y = np.array([label for _, label in rows], float)
        prior = np.append(self.weights, self.bias)
        pull = np.append(np.full(len(self.names), penalty), 0.05)

        def loss(w: np.ndarray) -> float:
            z = x @ w
            return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(pull * (w - prior) ** 2))

        w, now = prior.copy(), loss(prior)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(pull)
            step, size = np.linalg.solve(h, x.T @ (p - y) + pull * (w - prior)), 1.0
            while size > 1e-4 and loss(w - size * step) > now:
                size /= 2
            before, w = now, w - size * step
            now = loss(w)
            if before - now < 1e-6:
                break
        self.weights, self.bias = w[:-1], float(w[-1])
        return self

    def score(self, features: Counter) -> float:
        z = self.bias + sum(self.weights[self.index[k]] * math.log1p(v) for k, v in features.items() if v)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def sparse_features(sample: DataFrame, model: ToxicityModel) -> list[tuple[dict, int]]:
    """Features and labels of the (bounded) sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TextHits(model.lexicon)
        for batch in batches:
            ks, vs = [], []
            for text in batch.column(0).to_pylist():
                f = {model.index[k]: v for k, v in reader.features(text).items() if v}
                ks.append(list(f))
                vs.append(list(f.values()))
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.list_(pa.int32())), pa.array(vs, pa.list_(pa.int32())),
                                              batch.column(1)], ["k", "v", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(run, "k array<int>, v array<int>, toxic int").collect()
    return sorted(((dict(zip(r["k"], r["v"])), r["toxic"]) for r in rows), key=lambda r: (sorted(r[0].items()), r[1]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> ToxicityModel | None:
    """Model from ``labels`` (doc_id, toxic) and their texts in ``docs``; None without labels."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
                   .where("_id is not null and toxic in (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic")))
    n = marks.count()
    if not n:
        return None
    u = F.pmod(F.xxhash64(F.lit(3), "_id"), F.lit(1_000_000)) / 1_000_000
    # at most about max_rows rows of an id and a flag
    marks = F.broadcast(marks.where(u < min(1.0, max_rows / n)))
    sample = staged(docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
                        .where("text is not null").join(marks, "_id").select("text", "toxic")
                    .groupBy("text").agg(F.max("toxic").alias("toxic")), "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes:
        return None
    model = ToxicityModel(learn_lexicon(sample, sizes.get(1, 0), sizes.get(0, 0)))
    return model.fit(sparse_features(sample, model))


def predict(docs: DataFrame, model: ToxicityModel | None, columns: list[str]) -> DataFrame:
    """``columns`` of every row of ``docs`` with ``score`` and ``predicted``."""
    schema = docs.select(*columns).schema.add("score", "double").add("predicted", "integer")
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = TextHits(model.lexicon) if model else None
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            scores = [model.score(reader.features(t)) for t in texts] if model else [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32())], names)

    return docs.select(*columns, F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: int = 0, modulus: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned from labels outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"),
                       (id_remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    model = fit(rows, labels.where(id_remainder(F.col("doc_id"), modulus) != held_out))
    return predict(rows, model, ["doc_id", "held_out"])


def without_toxic(docs: DataFrame, labels: DataFrame, held_out: int = 0, modulus: int = 5) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic, with the columns of ``docs``."""
    model = fit(docs, labels.where(id_remainder(F.col("doc_id"), modulus) != held_out))
    if model is None:
        return docs

    @F.pandas_udf("boolean")
    def is_clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = TextHits(model.lexicon)
        for part in texts:
            yield pd.Series([model.score(reader.features(t)) < 0.5 for t in part], dtype=bool)

    return docs.where(is_clean(F.col("text").cast("string")))

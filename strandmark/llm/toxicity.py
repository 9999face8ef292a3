"""Operator 5: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities and counts of a lexicon, how near its words stand to the second person, capitals,
punctuation, obfuscation (digits and symbols inside words, stretched letters). The lexicon is a fixed list and what
the labelled training rows show: words and word beginnings of 4 to 6 letters that are far more frequent in rows marked
toxic (log-likelihood ratio beyond what chance gives among so many terms). Learning takes a bounded sample, the ``SAMPLE_ROWS`` labelled rows
of smallest key hash; distinct texts count once. Rows are learned from in folds: a row's features come from the lexicon
of the other folds, its score for the calibration from the trees of the other folds.

Scoring is one pass over whole texts; documents are never shuffled, the model (a few thousand terms at most and 50
small trees) goes along with the code.

Edge cases: null and empty texts have all features zero and get a score like any other; labels that are null or for
ids without a document teach nothing; without both classes among the training rows the score is their mean (0.5
without any); repeated ids are scored as rows of their own, and learned from once for each text; an empty table gives
an empty table; further columns don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

#: Labelled rows that are learned from at most.
SAMPLE_ROWS = 16_000
FOLDS, TREES, DEPTH, RATE, BINS = 4, 50, 3, 0.2, 32
MIN_TOXIC_ROWS = 3
THRESHOLD = 0.3

# Insults that count without having been learned.
INSULTS = ["clown", "disgusting", "dumb", "hate", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless"]
# Second person in English, German, French and Spanish.
SECOND_PERSON = ["you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "euch", "tu", "toi", "te", "ton", "ta", "tes", "vous", "votre", "vos", "ti", "tus", "usted", "ustedes", "vosotros"]
# Symbols and digits that stand for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_PLAIN = str.maketrans(STAND_INS)
_MIXED = re.compile(r"(?<=[a-z])[0-9@$!*]+(?=[a-z])")
_STRETCHED = re.compile(r"([a-z])\1\1+")
_SECOND = frozenset(SECOND_PERSON)
_EDGES = ".,;:!?\"'()[]{}<>%&$*#-_=+/\\|~`^"
PREFIXES = (4, 5, 6)
NAMES = ["log_words", "word_density", "prefix_density", "log_hits", "distinct_hits", "weight_sum", "weight_max", "fixed_density", "nearness", "second_density", "capitals", "shouted", "exclaims", "asks", "symbols", "mixed", "stretched"]


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]


def plain(word: str) -> str:
    """The word without disguise: stand-ins inside it become letters, stretched letters short."""
    if word.isalpha() and not _STRETCHED.search(word):
        return word
    return _STRETCHED.sub(r"\1", word.translate(_PLAIN).replace("*", "")) if any(c.isalpha() for c in word) else word


def terms_of(words: list[str]) -> set[str]:
    found = set()
    for w in {plain(w) for w in words}:
        if len(w) > 2:
            found.add(w)
        for n in PREFIXES:
            if len(w) > n:
                found.add(w[:n] + "*")
    return found


@dataclass
class Lexicon:
    weight: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.screen = frozenset(t.removesuffix("*")[:4] for t in [*self.weight, *INSULTS])
        self.fixed = frozenset(INSULTS)

    def look_up(self, word: str) -> tuple[float, bool, bool]:
        """(weight, whether it is the whole word, whether it is on the fixed list)"""
        w = plain(word)
        whole, fixed = self.weight.get(w, 0.0), w in self.fixed
        part = max([self.weight.get(w[:n] + "*", 0.0) for n in PREFIXES if len(w) > n], default=0.0)
        return max(whole, part, 1.0 * fixed), whole >= part or fixed, fixed


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    if not text:
        return [0.0] * len(NAMES)
    raw = text.split()
    n = len(raw) or 1
    lower = text.lower()
    words = lower.split()
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum() // 2))
    size = max(1, int(counts.sum()))
    bare = counts[48:58].sum() + counts[[33, 36, 42, 64]].sum()
    mixed = len(_MIXED.findall(lower)) if bare else 0
    shouted = sum(map(str.isupper, raw)) if counts[65:91].sum() > n else 0
    second = sum(map(_SECOND.__contains__, words))
    hits, parts, fixed, weights, seen, near = 0, 0, 0, 0.0, {}, 0.0
    screen = lexicon.screen
    stretched = len(_STRETCHED.findall(lower))
    stripped = {w: w.strip(_EDGES) or w for w in set(words)}
    # a word without disguise is its own plain form; what look_up finds begins as some term does
    if stretched:
        candidates = {w: s for w, s in stripped.items() if plain(s)[:4] in screen}
    elif bare:
        candidates = {w: s for w, s in stripped.items() if (s if s.isalpha() else plain(s))[:4] in screen}
    else:
        candidates = {w: s for w, s in stripped.items() if s[:4] in screen}
    if candidates:
        places = []
        memo = {w: lexicon.look_up(s) for w, s in candidates.items()}
        for k, w in enumerate(words):
            got = memo.get(w)
            if got and got[0] > 0:
                hits += got[1]
                parts += not got[1]
                fixed += got[2]
                weights += got[0]
                seen[w.strip(_EDGES)] = got[0]
                places.append(k)
        if places and second:
            at = np.array([k for k, w in enumerate(words) if w in _SECOND])
            k = np.searchsorted(at, places)
            p = np.array(places)
            gap = np.minimum(np.abs(at[np.minimum(k, len(at) - 1)] - p), np.abs(at[np.maximum(k - 1, 0)] - p))
            near = float(1 / (1 + gap.min()))
    return [
        math.log1p(n), hits / n, parts / n, math.log1p(hits + parts), float(len(seen)), math.log1p(weights), max(seen.values(), default=0.0), fixed / n, near,
        second / n, counts[65:91].sum() / letters, shouted / n, counts[33] / size, counts[63] / size, float(counts[35:39].sum() + counts[42] + counts[64]) / size, mixed / n,
        stretched / n,
    ]


def learn_lexicon(counts: dict[str, tuple[int, int]], toxic: int, clean: int, terms: int) -> Lexicon:
    """From rows by term (toxic, clean): those of all ``terms`` that stand out among toxic rows by G2, with log odds as weights."""
    scored, all_ = [], toxic + clean
    least = 2 * math.log(max(100, terms))
    for term, (t, c) in counts.items():
        if t < MIN_TOXIC_ROWS or t * clean <= c * toxic:
            continue
        g2 = 2 * sum(o * math.log(o * all_ / (r * k)) for o, r, k in ((t, t + c, toxic), (c, t + c, clean)) if o)
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if g2 >= least and odds > 1.5:
            scored.append((g2, term, odds))
    scored.sort(key=lambda x: (-x[0], x[1]))
    return Lexicon({term: round(odds, 6) for _, term, odds in scored})


@dataclass
class Trees:
    """Boosted trees of logistic loss over binned features; a tree is arrays of its inner nodes and leaves."""

    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        # zero or not is worth a cut whatever the quantiles say
        cuts = [np.unique(np.append(c, [0.0, *np.quantile(x[x[:, j] > 0, j], [0.1, 0.5, 0.9])])) if (x[:, j] > 0).any() else c for j, c in enumerate(cuts)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        width = max(len(c) for c in cuts) + 1
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = math.log(p / (1 - p))
        score = np.full(len(y), self.start)
        flat = binned + np.arange(x.shape[1]) * width
        for _ in range(TREES):
            prob = 1 / (1 + np.exp(-score))
            g, h = y - prob, prob * (1 - prob)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
            for depth in range(DEPTH):
                for k in range(2**depth):
                    at, rows = 2**depth - 1 + k, np.flatnonzero(node == k)
                    if len(rows) >= 10:
                        index = flat[rows].ravel()
                        sums = [np.bincount(index, np.repeat(v[rows], x.shape[1]), x.shape[1] * width).reshape(-1, width) for v in (g, h)]
                        gl, hl = sums[0].cumsum(1)[:, :-1], sums[1].cumsum(1)[:, :-1]
                        gt, ht = g[rows].sum(), h[rows].sum()
                        gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                        gain[(hl < 0.05) | (ht - hl < 0.05)] = 0
                        j, b = np.unravel_index(int(gain.argmax()), gain.shape)
                        if gain[j, b] > 1e-6 and b < len(cuts[j]):
                            feature[at], cut[at] = j, cuts[j][b]
                node = 2 * node + (x[np.arange(len(x)), feature[2**depth - 1 + node]] > cut[2**depth - 1 + node])
            size = 2**DEPTH
            leaf = RATE * np.bincount(node, g, size) / (np.bincount(node, h, size) + 1)
            score += leaf[node]
            self.trees.append((feature, cut, leaf))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for depth in range(DEPTH):
                at = 2**depth - 1 + node
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            out += leaf[node]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: (raw, probability) knots, both ascending."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # mean, rows, least raw, largest raw
    for r, t in zip(raw[order], y[order]):
        blocks.append([float(t), 1.0, r, r])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            m, n, _, high = blocks.pop()
            a = blocks[-1]
            a[0], a[1], a[3] = (a[0] * a[1] + m * n) / (a[1] + n), a[1] + n, high
    knots_x = np.array([v for b in blocks for v in (b[2], b[3])])
    # a block of few rows isn't taken for certain
    knots_y = np.array([v for b in blocks for v in [(b[0] * b[1] + 0.5 * y.mean()) / (b[1] + 0.5)] * 2])
    return knots_x, np.maximum.accumulate(knots_y)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    mean: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.mean)
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(len(texts), len(NAMES))
        return np.interp(self.trees.raw(x), *self.knots)


def train(docs: DataFrame, labels: DataFrame, allowed, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most ``sample_rows`` labelled rows for which ``allowed`` (a condition on doc_id) holds.

    Terms are counted and features computed on the executors; the driver gets a row a promising term and a row a
    sampled text.
    """
    pick = labels.where(allowed & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    pick = pick.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = docs.where(allowed).select("doc_id", "text").join(F.broadcast(pick), "doc_id").where(F.length("text") > 0)
    # of rows that share an id one, so that the sample is bounded by rows
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text")).alias("r")).select("doc_id", "toxic", "r.text")
    texts = chosen.groupBy("text").agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "toxic")).alias("m"))
    rows = base.written(texts.select("text", F.col("m.h").alias("h"), F.col("m.toxic").alias("toxic"), F.pmod("m.h", F.lit(FOLDS)).cast("int").alias("fold")), "labelled")
    size = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    total = [sum(n for (_, t), n in size.items() if t == k) for k in (0, 1)]
    mean = total[1] / sum(total) if sum(total) else 0.5
    if min(total) < 1 or sum(total) < 2 * FOLDS:
        return Model(Lexicon(), None, None, mean)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            found: Counter = Counter()
            for text, toxic, fold in zip(*(c.to_pylist() for c in batch.columns)):
                found.update((term, fold, toxic) for term in terms_of(words_of(text)))
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([2 * k[1] + k[2] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())], ["term", "cell", "n"])

    cells = rows.select("text", "toxic", "fold").mapInArrow(count, "term string, cell int, n long")
    by_cell = [F.sum(F.when(F.col("cell") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(2 * FOLDS)]
    wide = cells.groupBy("term").agg(*by_cell)
    n1, n0 = sum(F.col(f"c{2 * k + 1}") for k in range(FOLDS)), sum(F.col(f"c{2 * k}") for k in range(FOLDS))
    wide = wide.withColumns({"n1": n1, "n0": n0}).where(F.col("n1") >= MIN_TOXIC_ROWS)
    terms = wide.agg(F.count("*")).first()[0]
    # a term whose odds are low over all rows doesn't stand out in a fold's complement either
    promising = wide.where((F.col("n1") + 0.5) / (total[1] + 1) > 2 * (F.col("n0") + 0.5) / (total[0] + 1) * 0.9).select("term", *[f"c{k}" for k in range(2 * FOLDS)])
    table = {r[0]: r[1:] for r in promising.collect()}

    def lexicon(without: int | None) -> Lexicon:
        kept = [k for k in range(FOLDS) if k != without]
        counts = {t: (sum(c[2 * k + 1] for k in kept), sum(c[2 * k] for k in kept)) for t, c in table.items()}
        return learn_lexicon(counts, max(1, sum(size.get((k, 1), 0) for k in kept)), max(1, sum(size.get((k, 0), 0) for k in kept)), terms)

    of_fold = [lexicon(k) for k in range(FOLDS)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            x = [np.array(features(t, of_fold[f])).tobytes() for t, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(x, pa.binary())], ["fold", "toxic", "h", "x"])

    got = sorted((r["h"], r["toxic"], r["fold"], bytes(r["x"])) for r in rows.select("text", "fold", "toxic", "h").mapInArrow(measure, "fold int, toxic int, h long, x binary").collect())
    x = np.array([np.frombuffer(r[3]) for r in got])
    y, fold = np.array([r[1] for r in got], float), np.array([r[2] for r in got])
    held = np.full(len(y), math.log(mean / (1 - mean)))
    for f in range(FOLDS):
        own = y[fold != f]
        if len(own) and own.min() < own.max():
            held[fold == f] = Trees().fit(x[fold != f], own).raw(x[fold == f])
    return Model(lexicon(None), Trees().fit(x, y), isotonic(held, y), mean)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with ``score`` and ``predicted`` (replaced, if there are such columns)."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    at = rest.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            score = model.score(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*rest, "score", "predicted"])

    return docs.select(*rest).mapInArrow(run, f"{schema}, score double, predicted int")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs, labels, ~held_out())
    return scored(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")

"""Operator 6: language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, everything but letters becomes one blank, and its 1-, 2- and 3-grams fall into ``BUCKETS``
hashed buckets. Document frequencies are counted over all rows that may be learned from, in one pass with a partial
sum a partition. The weights are learned from a bounded sample (the ``SAMPLE_ROWS`` such rows of smallest key hash) by
follow-the-regularised-leader with L1 and L2 penalties, per coordinate; four fifths of the sample train, the rest sets
the temperature that the logits are divided by. Prediction is one pass over whole texts without a shuffle.

Edge cases: a text that is null or has no letters is ``und`` with score 0; null languages teach nothing; without any
row to learn from everything is ``und``; one language only is predicted with score 1; repeated rows are predicted
each; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

BUCKETS = 1 << 14
#: Rows that weights are learned from at most.
SAMPLE_ROWS = 5_000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.002, 0.0005
UNDETERMINED = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the text's n-grams."""
    clean = f" {_NO_LETTERS.sub(' ', text.lower()).strip()} "
    c = np.frombuffer(clean.encode("utf-32-le"), np.uint32)
    h = (c + np.uint32(1)) * _MULTIPLIERS[0]
    grams = [h]
    for n in (1, 2):
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _MULTIPLIERS[n] + (c[n:] + np.uint32(1)) * _MULTIPLIERS[0]
        grams.append(h)
    h = np.concatenate(grams)
    h = (h ^ (h >> np.uint32(16))) * _MULTIPLIERS[1]
    all_ = np.bincount(h >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    found = np.flatnonzero(all_)
    return found, all_[found]


def weighed(found: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(n)) * idf[found]
    return v / max(np.sqrt(v @ v), 1e-12)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # BUCKETS + 1 (bias) rows
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        found, n = counts(text)
        return weighed(found, n, self.idf) @ self.weights[found] + self.weights[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [], np.zeros(len(texts))
        for k, t in enumerate(texts):
            if not self.langs or not has_letters(t):
                langs.append(UNDETERMINED)
                continue
            p = softmax(self.logits(t) / self.temperature)
            best = int(p.argmax())
            langs.append(self.langs[best])
            scores[k] = p[best]
        return langs, scores


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Per-coordinate FTRL-proximal; the last row is the bias, which has no L1 penalty."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    l1 = np.full((BUCKETS + 1, 1), L1)
    l1[-1] = 0

    def weights(at) -> np.ndarray:
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for found, v, label in rows:
            at, x = np.append(found, BUCKETS), np.append(v, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    return weights(slice(None))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Of least negative log likelihood, by golden-section search of its logarithm."""
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean()
    a, b, ratio = -1.5, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents by bucket, and documents, over all rows of docs(text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            base.forget()
            for t in batch.column(0):
                if has_letters(t.as_py()):
                    total[counts(t.as_py())[0]] += 1
                    rows += 1
        total[BUCKETS] = rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out[:BUCKETS], int(out[BUCKETS])


def train(docs: DataFrame, allowed, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from docs(doc_id, text, lang) where ``allowed`` (a condition on doc_id) holds."""
    usable = docs.where(allowed & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    df, n = document_frequencies(usable)
    idf = np.log((1 + n) / (1 + df)) + 1
    ids = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            kept = [(h, lang, *counts(t)) for h, lang, t in zip(*(c.to_pylist() for c in batch.columns)) if has_letters(t)]
            columns = [pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.string())] + [pa.array([k[j].astype(np.int32).tobytes() for k in kept], pa.binary()) for j in (2, 3)]
            yield pa.RecordBatch.from_arrays(columns, ["h", "lang", "found", "n"])

    # of rows that share an id one, so that the sample is bounded by rows
    one = usable.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("lang", "text").alias("t"), "lang", "text")).alias("r"))
    chosen = one.select(F.xxhash64("doc_id").alias("h"), "r.lang", "r.text").mapInArrow(run, "h long, lang string, found binary, n binary")
    rows = sorted(((r["h"], r["lang"], bytes(r["found"]), bytes(r["n"])) for r in chosen.toLocalIterator()))
    langs = sorted({r[1] for r in rows})
    ready = []
    for _, lang, found, number in rows:
        at = np.frombuffer(found, np.int32)
        ready.append((at, weighed(at, np.frombuffer(number, np.int32), idf), langs.index(lang)))
    if len(langs) < 2:
        return Model(langs, idf, np.zeros((BUCKETS + 1, max(1, len(langs)))), 1.0)
    fit, held = [r for k, r in enumerate(ready) if k % 5 or len(ready) < 20], ready[::5]
    weights = ftrl(fit, len(langs))
    logits = np.array([v @ weights[at] + weights[-1] for at, v, _ in held])
    return Model(langs, idf, weights, temperature(logits, np.array([r[2] for r in held])))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """docs with ``lang_pred`` and ``score`` (replaced, if there are such columns)."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = rest.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base.forget()
            langs, scores = model.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)], [*rest, "lang_pred", "score"])

    return docs.select(*rest).mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.select("doc_id", "text", "lang"), ~held_out())
    return identified(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")

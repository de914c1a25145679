"""Toxicity classifier with a counterfactual regulariser.

Features are the distinct words of a text (runs of letters, lower-cased) and
word beginnings of four to six letters, which carry over to other endings.
Those that best tell the labelled sample apart get a weight in a logistic
regression.  Texts of the sample that name a group get a counterfactual, the
same text with each identity term swapped for another of its kind, and the
squared change of the score between the two is part of the loss, so that the
mention of a group by itself does not move a score.

Fitted on a bounded sample of labelled rows: ``sample_rows`` (the rows whose
hashed ids are smallest).  Scoring reads every whole text and nothing else.
Null and empty texts get the score of no words.  Rows of labels with a null
label do not train; rows that repeat a ``doc_id`` are scored one by one.  With
no labelled rows every score is 0.5 less a hair.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, write_shared

#: Terms of one kind; a counterfactual puts the next of its kind in a term's place.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("black", "white", "asian", "latino", "indigenous"), ("africans", "europeans", "asians", "americans"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("immigrant", "native"), ("immigrants", "natives"),
    ("disabled", "blind", "deaf"), ("old", "young"), ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
SAMPLE_ROWS = 30_000
FEATURES = 4_096
LEAST_ROWS = 4  # rows of the sample that hold a feature
WORD_CACHE = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """Feature names of a word: itself and its beginnings."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) >= n)]


def words_of(text: str) -> set[str]:
    return set(_LETTERS.findall(text.lower()))


def swapped(words: set[str], terms=IDENTITY_TERMS) -> set[str]:
    """The words with each identity term replaced by the next of its kind."""
    turn = {t: kind[(i + 1) % len(kind)] for kind in terms for i, t in enumerate(kind)}
    return {turn.get(w, w) for w in words}


@dataclass
class ToxicityModel:
    """Weights of features, and the constant."""

    weights: dict[str, float]
    constant: float
    _known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def score(self, text: str) -> float:
        """0 to 1; higher is likelier toxic."""
        found: set[str] = set()
        known = self._known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in words_of(text):
            own = known.get(w)
            if own is None:
                own = known[w] = tuple(f for f in features_of(w) if f in self.weights)
            if own:
                found.update(own)
        z = self.constant + math.fsum(self.weights[f] for f in found)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _fit(rows: list[np.ndarray], label: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], size: int,
         l2: float, counterfactual: float, steps: int = 400, rate: float = 0.1) -> np.ndarray:
    """Weights and, last, the constant: Adam on the whole sample."""
    n = max(1, len(label))
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    idx = np.concatenate(rows).astype(np.int64) if rows else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(rows)), np.diff(at))
    # each counterfactual as signed features
    gain = [np.concatenate([a, b]) for a, b in swaps]
    c_idx = np.concatenate(gain).astype(np.int64) if gain else np.empty(0, np.int64)
    c_sign = np.concatenate([np.concatenate([np.ones(len(a)), -np.ones(len(b))]) for a, b in swaps]) if gain else np.empty(0)
    c_of = np.repeat(np.arange(len(gain)), [len(g) for g in gain]) if gain else np.empty(0, np.int64)
    w, m, v = (np.zeros(size + 1) for _ in range(3))
    for t in range(1, steps + 1):
        z = w[size] + np.bincount(of, w[idx], len(rows))
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        g = np.append(np.bincount(idx, err[of], size), err.sum()) / n
        g[:size] += l2 * w[:size]
        if gain:
            change = np.bincount(c_of, w[c_idx] * c_sign, len(gain))
            g[:size] += counterfactual / len(gain) * 2 * np.bincount(c_idx, change[c_of] * c_sign, size)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, features: int = FEATURES,
          terms=IDENTITY_TERMS, l2: float = 1e-4, counterfactual: float = 1.0) -> ToxicityModel:
    """A model from texts of ``docs`` labelled in ``labels`` (doc_id and 0/1); both by ``doc_id``.

    What comes to the driver is bounded by ``sample_rows`` and ``features``.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_text().alias("text"))
    sample = write_shared(texts.join(chosen, "doc_id"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen[int(y == 1)].update({f for w in words_of(text) for f in features_of(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()),
                                              "clean": pa.array([seen[0][f] for f in names], pa.int64()),
                                              "bad": pa.array([seen[1][f] for f in names], pa.int64())})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                names = {f for w in words for f in features_of(w)}
                own.append(sorted(position[f] for f in names if f in position))
                changed = swapped(words, terms)
                names = {f for w in changed for f in features_of(w)} if changed != words else names
                other.append(sorted(position[f] for f in names if f in position) if changed != words else None)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(own, kind), pa.array(other, kind)],
                                             ["label", "own", "other"])

    sums = sample.agg(F.sum((F.col("label") == 1).cast("long")), F.sum((F.col("label") != 1).cast("long"))).first()
    bad, clean = (sums[0] or 0), (sums[1] or 0)
    if not bad or not clean:
        return ToxicityModel({}, 20.0 if bad else -1e-9 if not clean else -20.0)
    counted = (sample.mapInArrow(count, "feature string, clean long, bad long").groupBy("feature")
               .agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where(F.col("clean") + F.col("bad") >= LEAST_ROWS))
    p, q = (F.col("bad") + 0.5) / (bad + 1.0), (F.col("clean") + 0.5) / (clean + 1.0)
    spread = F.sqrt(p * (1 - p) / bad + q * (1 - q) / clean)
    named = [t for kind in terms for t in kind]
    best = counted.orderBy(F.col("feature").isin(named).desc(), F.abs((p - q) / spread).desc(), "feature").limit(features)
    names = [r["feature"] for r in best.select("feature").collect()]
    position = {f: i for i, f in enumerate(names)}
    # features stay in Arrow's arrays: as Python numbers they would take some ten times the memory
    rows = sample.select("text", "label").mapInArrow(gather, "label int, own array<int>, other array<int>").toArrow().combine_chunks()
    own, other = _lists(rows.column("own")), _lists(rows.column("other"))
    changed = rows.column("other").is_valid().to_numpy()
    swaps = [(np.setdiff1d(own[i], other[i]), np.setdiff1d(other[i], own[i])) for i in np.flatnonzero(changed)]
    w = _fit(own, (rows.column("label").to_numpy() == 1).astype(float), [s for s in swaps if len(s[0]) or len(s[1])], len(names),
             l2, counterfactual)
    return ToxicityModel(dict(zip(names, w[:-1].tolist())), float(w[-1]))


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its numbers; null as empty."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(chunk).fill_null(0).to_numpy())])
        out += np.split(chunk.flatten().to_numpy(), ends[1:-1]) if len(chunk) else []
    return out


def scorer(model: ToxicityModel):
    """A column function: the score of a text column (null as empty)."""
    weights, constant = model.weights, model.constant

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ToxicityModel(weights, constant)
        for texts in parts:
            yield pd.Series([own.score(t or "") for t in texts], dtype="float64")

    return run


def is_held_out(doc_id="doc_id"):
    """A fifth of the ids, whose labels are not learnt; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels.where(~is_held_out()), **options)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model)("text").alias("score"))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

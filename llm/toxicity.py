"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over a text's words and word beginnings. For each labelled text that names a group of people, a
second version swaps the identity terms for others of their kind; the loss adds the squared difference of the two scores'
logits, so that the score can't rest on which group is named, and neutral mentions stay unsuspicious.

Labels are learned from a bounded sample of the labelled rows (`sample`, the least by a hash of the id, so the same rows
on any cluster). Its features are counted in Spark, the most telling (`features`) are kept, and only those of the sample
reach the driver. Every text is scored whole. Null and empty texts have no features and get the score of the intercept.
Without rows of both labels the intercept alone is learned. Repeated rows count as often as they occur, rows with a null
id or label teach nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.batches import map_texts
from llm.tables import stage
from llm.wordhash import mix, word_parts

#: Terms for groups of people; those in a line are swapped for one another.
IDENTITIES = (
    ("men", "women"), ("man", "woman"), ("boys", "girls"), ("boy", "girl"), ("male", "female"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("african", "american", "chinese", "mexican", "german", "french", "russian", "indian", "arab"), ("immigrants", "citizens"), ("old", "young"), ("blind", "deaf", "disabled"),
)

_DENSE = 150


@dataclass(frozen=True)
class Training:
    """sample: labelled rows learned from, at most; features: kept of them; seen: texts a feature must be in; prefixes:
    bytes of a word's beginnings; ridge and swap: weights of the squared coefficients and of the counterfactual term."""

    sample: int = 12_000
    features: int = 8192
    seen: int = 4
    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    ridge: float = 1e-3
    swap: float = 1.0
    steps: int = 250
    identities: tuple[tuple[str, ...], ...] = field(default=IDENTITIES)


@dataclass(frozen=True)
class Model:
    """The kept features (hashes, sorted), a weight for each, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float
    prefixes: tuple[int, ...]


def features(texts: list[str | None], prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 32-bit hashes of what each text has, one text after another, and bounds: lower-case words, beginnings of
    words, and once more those of either that are frequent in it (twice at least, and one in _DENSE words)."""
    words, starts, at = word_parts([(t or "").lower() for t in texts], prefixes)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    kinds = [words, *(mix(x + np.uint64(k)) for k, x in zip(prefixes, starts))]
    keys = np.concatenate(kinds) >> np.uint64(32)
    keys, n = np.unique(np.tile(owner, len(kinds)).astype(np.uint64) << np.uint64(32) | keys, return_counts=True)
    often = keys[(n >= 2) & (n * _DENSE >= np.diff(at)[(keys >> np.uint64(32)).astype(np.int64)])]
    own = often & np.uint64(0xFFFFFFFF00000000)
    keys = np.unique(np.concatenate((keys, own | mix(often ^ own) >> np.uint64(32))))
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), np.searchsorted(keys >> np.uint64(32), np.arange(len(texts) + 1))


def swapped(text: str | None, identities: tuple[tuple[str, ...], ...]) -> str | None:
    """The text with each identity term replaced by the next of its kind, or None if it names none."""
    after = {a: b for group in identities for a, b in zip(group, group[1:] + group[:1])}
    if not text or not after:
        return None
    out, n = re.subn(r"\b(" + "|".join(map(re.escape, after)) + r")\b", lambda m: after[m[0].lower()], text, flags=re.IGNORECASE)
    return out if n else None


def _chosen(texts: list[str | None], known: np.ndarray, prefixes: tuple[int, ...]) -> list[np.ndarray]:
    """Places in `known` of the features of each text."""
    found, at = features(texts, prefixes)
    spot = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
    hit = known[spot] == found if len(known) else np.zeros(len(found), dtype=bool)
    return [spot[a:b][hit[a:b]] for a, b in zip(at[:-1], at[1:])]


def _rows_times(places: list[np.ndarray], size: int):
    """Functions x -> X x and r -> X' r of the 0/1 matrix with ones at `places`."""
    row = np.repeat(np.arange(len(places)), [len(p) for p in places])
    column = np.concatenate(places) if places else np.zeros(0, np.int64)
    return (
        lambda x: np.bincount(row, weights=x[column], minlength=len(places)),
        lambda r: np.bincount(column, weights=r[row], minlength=size),
    )


def fit_weights(places: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[int, np.ndarray]], size: int, how: Training) -> tuple[np.ndarray, float]:
    """Weights and intercept; `pairs` has, for some texts by number, the places of their swapped version."""
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.05
    weights, intercept = np.zeros(size), float(np.log(share / (1 - share)))
    if not size or not 0 < labels.sum() < len(labels):
        return weights, intercept
    times, back = _rows_times(places, size)
    times_1, back_1 = _rows_times([places[i] for i, _ in pairs], size)
    times_2, back_2 = _rows_times([p for _, p in pairs], size)
    first, second, rate = np.zeros(size + 1), np.zeros(size + 1), 0.05
    for step in range(1, how.steps + 1):
        miss = (1 / (1 + np.exp(-(times(weights) + intercept))) - labels) / len(labels)
        slope = np.append(back(miss) + how.ridge * weights, miss.sum())
        if pairs:
            gap = 2 * how.swap * (times_1(weights) - times_2(weights)) / len(pairs)
            slope[:-1] += back_1(gap) - back_2(gap)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, intercept = weights - move[:-1], intercept - move[-1]
    return weights, float(intercept)


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Learns `toxic` of `labels` (doc_id, toxic) from the texts of `docs` (doc_id, text)."""
    known = labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("label"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.sample)
    rows = stage(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"), "labelled")  # `sample` rows at most

    def count(texts: list[str | None], batch: pa.RecordBatch) -> dict:
        toxic = batch.column("label").to_numpy() > 0
        found, at = features(texts, how.prefixes)
        feature, place = np.unique(found, return_inverse=True)
        of = toxic[np.repeat(np.arange(len(texts)), np.diff(at))]
        return {"feature": feature, "n1": np.bincount(place[of], minlength=len(feature)), "n0": np.bincount(place[~of], minlength=len(feature))}

    total = rows.agg(F.count_if(F.col("label") > 0).alias("n1"), F.count_if(F.col("label") <= 0).alias("n0")).first()
    counts = map_texts(rows, count, "feature long, n1 long, n0 long").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    n1, n0 = max(total.n1, 1), max(total.n0, 1)
    both = (F.col("n1") + F.col("n0")) / (n1 + n0)
    telling = F.abs(F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(both * (1 - both) + 1e-9)
    best = counts.where(F.col("n1") + F.col("n0") >= how.seen).orderBy(telling.desc(), "feature").limit(how.features).select("feature")
    chosen = np.sort(best.toArrow().column("feature").to_numpy())

    def places(texts: list[str | None], batch: pa.RecordBatch) -> dict:
        other = [swapped(t, how.identities) for t in texts]
        own, changed = _chosen(texts, chosen, how.prefixes), _chosen(other, chosen, how.prefixes)
        return {"label": batch.column("label"), "own": [x.tolist() for x in own], "changed": [None if t is None else x.tolist() for t, x in zip(other, changed)]}

    table = map_texts(rows, places, "label int, own array<int>, changed array<int>").toArrow()
    own = [np.array(x, dtype=np.int64) for x in table.column("own").to_pylist()]
    pairs = [(i, np.array(x, dtype=np.int64)) for i, x in enumerate(table.column("changed").to_pylist()) if x is not None]
    weights, intercept = fit_weights(own, (table.column("label").to_numpy() > 0).astype(float), pairs, len(chosen), how)
    return Model(chosen, weights, intercept, how.prefixes)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (1 from the threshold on) for each row of `docs` (doc_id, text)."""

    def block(texts: list[str | None], rows: pa.RecordBatch) -> dict:
        logits = np.array([model.weights[p].sum() for p in _chosen(texts, model.features, model.prefixes)]) + model.intercept
        scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
        return {"doc_id": rows.column("doc_id"), "score": scores, "predicted": (scores >= threshold).astype(np.int32)}

    return map_texts(docs.select("doc_id", "text"), block, "doc_id long, score double, predicted int")

"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector binds (multiplies) the
vectors of its letters, each permuted (rotated) by its place; a text's vector bundles (adds) those of its n-grams. A
language's prototype bundles the n-grams of all its training texts. The language predicted is the one whose prototype
has the largest cosine with the text's vector, ties to the smaller name.

N-grams run over lower-case letters, with one mark for whatever lies between words. Null texts and texts without a
letter are `und` with score 0. Without training rows everything is `und`. Rows with a null id are predicted like others
and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.batches import map_texts

UNKNOWN = "und"


@dataclass(frozen=True)
class Profile:
    """Length of an n-gram, and of the vectors."""

    n: int = 3
    size: int = 512


#: For each code point met so far: 1 a letter, 2 none.
_KIND = np.zeros(0x110000, dtype=np.int8)


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-case text, a 0 for each run of other characters and at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _KIND[points]
    if not kind.all():
        for point in np.unique(points[kind == 0]).tolist():
            _KIND[point] = 1 if chr(point).isalpha() else 2
        kind = _KIND[points]
    points = np.concatenate(([0], np.where(kind == 1, points, 0), [0]))
    return points[np.concatenate(([True], (points[1:] != 0) | (points[:-1] != 0)))].astype(np.uint64)


def grams(text: str | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text's letters as numbers (21 bits a letter), and their counts."""
    points = _letters(text) if text else np.zeros(0, np.uint64)
    if not points.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    points = np.concatenate((points, np.zeros(max(n - len(points), 0), np.uint64)))
    codes = np.zeros(len(points) - n + 1, dtype=np.uint64)
    for k in range(n):
        codes = codes << np.uint64(21) | points[k : len(points) - n + 1 + k]
    return np.unique(codes, return_counts=True)


class Vectors:
    """The vectors of n-grams, remembered while there are not too many."""

    most = 60_000

    def __init__(self, profile: Profile):
        self.profile, self.letter, self.row = profile, {}, {}
        self.table = np.zeros((0, profile.size), dtype=np.int8)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letter:
            bits = np.random.Generator(np.random.Philox(key=point + 1)).integers(0, 2, self.profile.size)
            self.letter[point] = (2 * bits - 1).astype(np.int8)
        return self.letter[point]

    def _gram(self, code: int) -> np.ndarray:
        out = np.ones(self.profile.size, dtype=np.int8)
        for k in range(self.profile.n):
            out = out * np.roll(self._letter(code >> 21 * k & 0x1FFFFF), k)
        return out

    def rows(self, codes: Iterable[int]) -> list[int]:
        """Places of n-grams in the table; those that are new get one."""
        if len(self.row) > self.most:
            self.row, self.table = {}, self.table[:0]
        new = [c for c in codes if c not in self.row]
        if new:
            self.row |= {c: len(self.row) + i for i, c in enumerate(new)}
            if len(self.row) > len(self.table):
                grown = np.zeros((max(2 * len(self.table), len(self.row), 4096), self.profile.size), dtype=np.int8)
                grown[: len(self.table)] = self.table
                self.table = grown
            for c in new:
                self.table[self.row[c]] = self._gram(c)
        return [self.row[c] for c in codes]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(self.profile.size)
        for start in range(0, len(codes), self.most // 4):
            at = self.rows(codes[start : start + self.most // 4].tolist())
            out += counts[start : start + self.most // 4].astype(np.float32) @ self.table[at].astype(np.float32)
        return out


_VECTORS: dict[Profile, Vectors] = {}


def _vectors(profile: Profile) -> Vectors:
    return _VECTORS.setdefault(profile, Vectors(profile))


def prototypes(docs: DataFrame, profile: Profile = Profile()) -> dict[str, np.ndarray]:
    """A unit vector for each `lang` of `docs` (text, lang), from all its rows; null languages teach nothing.

    A task adds up each language's vectors over its rows; only sums of a few numbers per language are shuffled.
    """

    def block(texts: list[str | None], rows: pa.RecordBatch) -> dict | None:
        langs = rows.column("lang").to_pylist()
        names, sums = sorted({x for x in langs if x is not None}), []
        for name in names:
            found = [grams(t, profile.n) for t, x in zip(texts, langs) if x == name]
            codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([k for _, k in found]), minlength=len(codes))
            sums.append(_vectors(profile).bundle(codes, counts))
        return {"lang": names, "vector": [x.tolist() for x in sums]} if names else None

    parts = map_texts(docs.select("text", "lang").where("lang is not null"), block, "lang string, vector array<double>")
    total = [F.sum(F.col("vector")[i]).alias(f"v{i}") for i in range(profile.size)]
    out = {}
    for row in parts.groupBy("lang").agg(F.array(*total).alias("vector")).collect():  # a row for each language
        vector = np.array(row.vector)
        if norm := np.linalg.norm(vector):
            out[row.lang] = vector / norm
    return dict(sorted(out.items()))


def identify(docs: DataFrame, learned: dict[str, np.ndarray], profile: Profile = Profile()) -> DataFrame:
    """doc_id, lang_pred, score for each row of `docs` (doc_id, text); the score is the cosine, 0 at least."""
    names, table = list(learned), np.array(list(learned.values())).reshape(-1, profile.size)

    def block(texts: list[str | None], rows: pa.RecordBatch) -> dict:
        langs, scores = [], []
        for text in texts:
            codes, counts = grams(text, profile.n)
            vector = _vectors(profile).bundle(codes, counts)
            norm = np.linalg.norm(vector)
            if norm and names:
                cosines = table @ vector / norm
                langs.append(names[int(np.argmax(cosines))])
                scores.append(float(min(max(cosines.max(), 0.0), 1.0)))
            else:
                langs.append(names[0] if names and len(codes) else UNKNOWN)
                scores.append(0.0)
        return {"doc_id": rows.column("doc_id"), "lang_pred": langs, "score": scores}

    return map_texts(docs.select("doc_id", "text"), block, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))

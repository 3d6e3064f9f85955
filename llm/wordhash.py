"""Word and shingle hashes of whole texts with numpy, a batch of texts at a time.

A word is a maximal run outside the bytes 0x09-0x0D and 0x20. Its hash is a polynomial over its bytes modulo 2**64
with a random value per byte and an odd base, read off prefix sums, so that no Python object per word is made.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

_RANDOM = np.random.default_rng(20240501)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_GRAM = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]
#: Bytes of text handled at once; bounds the memory of the arrays, not the length of a text.
BLOCK = 4 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    step, have = base, 1
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(step)
        step, have = step * step % 2**64, have + take
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(texts: Sequence[str | None], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges (from, to) of texts of about `size` characters together; a longer text has a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and held + n > size:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


class _Sums:
    """Texts joined by line feeds, and prefix sums from which the hash of any run of their bytes follows."""

    def __init__(self, raw: list[bytes], separators: np.ndarray):
        joined = np.frombuffer(b"\n".join([*raw, b""]) if raw else b"", dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in raw], dtype=np.int64)
        space = separators[joined]
        self.first = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if len(joined) else np.empty(0, np.int64)
        self.last = np.flatnonzero(space & np.concatenate(([False], ~space[:-1]))) if len(joined) else np.empty(0, np.int64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[joined] * _powers(_BASE, len(joined)), dtype=np.uint64)))
        self.inverse = _powers(_INVERSE, len(joined) + 1)[self.first]
        self.bounds = np.concatenate(([0], np.searchsorted(self.first, ends)))

    def hashes(self, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last] - self.sums[self.first]) * self.inverse + (last - self.first).astype(np.uint64))


def word_hashes(texts: Iterable[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts one after another, and the text bounds in them (one more than texts).

    A null text has no words. With `lower`, A-Z count as a-z.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sums = _Sums([t.lower() for t in raw] if lower else raw, _SPACE)
    return sums.hashes(sums.last), sums.bounds


def word_parts(texts: Iterable[str], lengths: Iterable[int]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hashes of all words, here runs of letters and other than ASCII characters; of their first bytes, an array for
    each of `lengths`; and the text bounds in them."""
    sums = _Sums([t.encode("utf-8", "surrogatepass") for t in texts], _NO_LETTER)
    return sums.hashes(sums.last), [sums.hashes(np.minimum(sums.first + k, sums.last)) for k in lengths], sums.bounds


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each place on; the last n - 1 places have none."""
    m = max(len(words) - n + 1, 0)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out += words[k : k + m] * np.uint64(_GRAM[k % 5]) ** np.uint64(1 + k // 5)
        out = mix(out)
    return out


def shingle_sets(texts: Sequence[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text, one after another, and the text bounds in them.

    Words count in lower case (A-Z). A text with fewer than n words has its whole word sequence as its one shingle;
    one without words has none.
    """
    words, at = word_hashes(texts, lower=True)
    counts = np.diff(at)
    grams = gram_hashes(words, n)
    keep = np.ones(len(grams), dtype=bool)
    for k in range(1, n):  # grams that start in a text and end beyond it
        cut = at[1:] - k
        cut = cut[(cut >= 0) & (cut < len(grams))]
        keep[cut] = False
    places = np.flatnonzero(keep)
    owner = np.searchsorted(at, places, side="right") - 1
    keep = places + n <= at[owner + 1]
    places, owner = places[keep], owner[keep]
    grams = grams[places]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            has = counts[short] > k
            part = np.where(has, words[np.minimum(at[short] + k, len(words) - 1)] * np.uint64(_GRAM[k % 5]), np.uint64(0))
            whole = np.where(has, mix(whole + part), whole)
        grams = np.concatenate((grams, mix(whole + np.uint64(0x5851F42D4C957F2D))))
        owner = np.concatenate((owner, short))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(counts) + 1))

"""Packing that keeps the documents' order, by dynamic programming over the places where a sequence may end.

Each task lays the tokens of its documents end to end, as they come, and cuts this line into sequences. A sequence may
end after a document, for nothing; after a sentence, for a penalty; and, where no sentence ends for `stride` tokens
and among the last tokens of a task's line, at other tokens, for a larger one. A sequence of L tokens costs `capacity - L`
of padding, or nothing where L is a power of two. Of all ways to cut, one with the least sum is taken, and of these one
with the fewest sequences.

The cheapest cost up to a place is a minimum over the places in the window of `capacity` tokens before it. As the padding
is linear in L, that minimum is the front of a monotone queue, so each place is put in and taken out once; the powers of
two are single places looked up beside it. The recursion goes on from block to block of documents. What the
cheapest ways to all places of the last window have in common can't change any more: it is written, and the ids before
it are forgotten, so memory doesn't grow with a task's line. Nothing is shuffled.

Null texts count as empty: the end id alone. Repeated rows and null ids are packed like others. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from llm.packing import encoder
from llm.wordhash import blocks

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Signs that end a sentence.
_STOPS = ".!?…。！？"
_FEWER = 1 << 24  # a unit of cost, in sequences: the number of sequences only breaks ties


@dataclass(frozen=True)
class Windows:
    """tokenizer: path of a tokenizers file, the same on all machines; capacity: tokens of a sequence, a power of two; end: id put after
    each document; sentence and inside: what a cut after a sentence, or inside one, costs, in tokens of padding; stride: tokens without an end of a sentence
    after which a sentence may be cut; with_ids: whether pieces carry their ids (little-endian 32 bits)."""

    tokenizer: str
    capacity: int = 4096
    end: int = 2
    sentence: int = 32
    inside: int = 128
    stride: int = 256
    with_ids: bool = False


class Line:
    """A line of tokens that grows, the cheapest cuts to its places, and what of them is final.

    `at` are the places (tokens before them, from the first one that isn't final), `cost` the least cost up to each and
    `back` the number of the place before it on the way there.
    """

    def __init__(self, how: Windows):
        self.how, self.powers = how, 1 << np.arange(how.capacity.bit_length())
        self.at, self.cost, self.back = [0], [0], [-1]
        self.queue: deque[int] = deque([0])

    def extend(self, places: np.ndarray, penalties: np.ndarray) -> None:
        """Adds places, rising, none more than `capacity` after the one before it."""
        old, capacity = len(self.at), self.how.capacity
        shift = bisect.bisect_left(self.at, int(places[0]) - capacity)
        every = np.concatenate((np.array(self.at[shift:], dtype=np.int64), places))
        # the places a power of two before each, as pairs in the order of the later place
        later, earlier = [], []
        for power in self.powers.tolist():
            found = np.searchsorted(every, places - power)
            hit = np.flatnonzero(every[found] == places - power)
            later.append(hit)
            earlier.append(found[hit] + shift)
        later, earlier = np.concatenate(later), np.concatenate(earlier)
        order = np.argsort(later, kind="stable")
        bounds = np.searchsorted(later[order], np.arange(len(places) + 1)).tolist()
        earlier = earlier[order].tolist()
        at, cost, back, queue = self.at, self.cost, self.back, self.queue
        for j, (place, penalty) in enumerate(zip(places.tolist(), penalties.tolist())):
            low = place - capacity
            while at[queue[0]] < low:
                queue.popleft()
            best = queue[0]
            value = cost[best] + (capacity - place + at[best]) * _FEWER
            for i in earlier[bounds[j] : bounds[j + 1]]:
                if cost[i] < value or (cost[i] == value and at[i] < at[best]):
                    best, value = i, cost[i]
            value += penalty * _FEWER + 1
            here = old + j
            at.append(place)
            cost.append(value)
            back.append(best)
            key = value + place * _FEWER
            while queue and cost[queue[-1]] + at[queue[-1]] * _FEWER > key:
                queue.pop()
            queue.append(here)

    def path(self, last: int) -> list[int]:
        """Numbers of the places on the cheapest way to a place, the first one left out."""
        out = []
        while last > 0:
            out.append(last)
            last = self.back[last]
        return out[::-1]

    def settled(self) -> list[int]:
        """Places where sequences end whatever comes; they are final then, and the line begins after the last of them."""
        low, live = self.at[-1] - self.how.capacity, set()
        i = len(self.at) - 1
        while i >= 0 and self.at[i] >= low:
            live.add(i)
            i -= 1
        while len(live) > 1:  # the latest can't lie on a way to the others
            latest = max(live)
            live.remove(latest)
            live.add(max(self.back[latest], 0))
        (root,) = live
        ends = [self.at[i] for i in self.path(root)]
        if root:
            base, paid = self.at[root], self.cost[root]
            self.queue = deque(i - root for i in self.queue if i >= root)
            self.at = [x - base for x in self.at[root:]]
            self.cost = [x - paid for x in self.cost[root:]]
            self.back = [-1] + [x - root for x in self.back[root + 1 :]]
        return ends


def ending(tokens: dict[str, int], mark: str) -> np.ndarray:
    """Which ids end a sentence: words of signs alone, a stop among them."""
    out = np.zeros(max(tokens.values()) + 1, dtype=bool)
    for token, i in tokens.items():
        word = token.removesuffix(mark) if mark else token
        out[i] = (not mark or token.endswith(mark)) and any(c in _STOPS for c in word) and not any(c.isalnum() for c in word)
    return out


def places_of(ids: np.ndarray, stops: np.ndarray, how: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Where sequences may end in a document, its end included, and what that costs."""
    stop = np.flatnonzero(stops[np.minimum(ids[:-1], len(stops) - 1)]) + 1
    ends = np.append(stop, len(ids))
    gaps = np.diff(ends, prepend=0)
    penalties = np.full(len(ends), how.sentence, dtype=np.int64)
    penalties[-1] = 0
    far = np.flatnonzero(gaps > how.stride)
    if not len(far):
        return ends, penalties
    more = np.concatenate([np.arange(end - gap + how.stride, end, how.stride) for end, gap in zip(ends[far].tolist(), gaps[far].tolist())])
    ends, penalties = np.append(ends, more), np.append(penalties, np.full(len(more), how.inside))
    order = np.argsort(ends, kind="stable")
    return ends[order], penalties[order]


class Packer:
    """Pieces of one task's documents."""

    def __init__(self, how: Windows, stops: np.ndarray, first_sequence: int):
        self.how, self.stops, self.line, self.sequence = how, stops, Line(how), first_sequence
        self.docs: deque[tuple[int | None, bytes, int]] = deque()  # documents not yet written, and how far they are
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.length = 0  # tokens on the line

    def add(self, doc_id: int | None, data: bytes) -> None:
        ids = np.frombuffer(data, dtype="<u4")
        places, penalties = places_of(ids, self.stops, self.how)
        self.pending.append((places + self.length, penalties))
        self.docs.append((doc_id, data, 0))
        self.length += len(ids)

    def block(self, last: bool = False) -> list[tuple]:
        """Puts what was added on the line, and returns the pieces that are final; with `last`, all."""
        if not self.pending:
            return []
        places, penalties = (np.concatenate(x) for x in zip(*self.pending))
        self.pending = []
        if not last:
            # the tail waits: at a task's end it may be cut at any token
            ready = int(np.searchsorted(places, self.length - self.how.capacity, side="right"))
            self.pending = [(places[ready:], penalties[ready:])]
            places, penalties = places[:ready], penalties[:ready]
        else:
            begin = max(self.length - self.how.capacity, self.line.at[-1] + 1)
            free = np.setdiff1d(np.arange(begin, self.length), places)
            places, penalties = np.append(places, free), np.append(penalties, np.full(len(free), self.how.inside))
            order = np.argsort(places, kind="stable")
            places, penalties = places[order], penalties[order]
        if len(places):
            self.line.extend(places, penalties)
        if last:
            ends = [self.line.at[i] for i in self.line.path(len(self.line.at) - 1)]
        else:
            ends = self.line.settled()
            moved = ends[-1] if ends else 0
            self.length -= moved
            self.pending = [(p - moved, c) for p, c in self.pending]
        return self.write(ends)

    def write(self, ends: list[int]) -> list[tuple]:
        rows, at = [], 0
        for end in ends:
            offset = 0
            while at < end:
                doc_id, data, done = self.docs[0]
                n = min(end - at, len(data) // 4 - done)
                piece = data[4 * done : 4 * (done + n)]
                rows.append((doc_id, done, n, zlib.crc32(piece), len(data) // 4, self.sequence, offset, *[piece] * self.how.with_ids))
                at, offset, done = at + n, offset + n, done + n
                if 4 * done == len(data):
                    self.docs.popleft()
                else:
                    self.docs[0] = (doc_id, data, done)
            self.sequence += 1
        return rows


def pack_windows(docs: DataFrame, how: Windows) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).
    `docs` has doc_id and text."""
    if how.capacity < 1 or how.capacity & (how.capacity - 1) or not 1 <= how.stride <= how.capacity:
        raise ValueError("capacity must be a power of two, and stride between 1 and it")
    schema = SCHEMA + (", ids binary" if how.with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(how.tokenizer), how.end.to_bytes(4, "little")
        packer = Packer(how, ending(encode.tokenizer.get_vocab(), encode.mark), TaskContext.get().partitionId() << 40)

        def rows_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
            return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, past in blocks(texts):
                for doc_id, data in zip(ids[first:past], encode(texts[first:past])):
                    packer.add(doc_id, data + end)
                if rows := packer.block():
                    yield rows_of(rows)
        if rows := packer.block(last=True):
            yield rows_of(rows)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)

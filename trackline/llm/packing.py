"""Best-fit packing of tokenised documents by exact-complement hashing.

Only the histogram of piece lengths (at most ``capacity`` numbers, whatever the
input) reaches the driver.  There, sequences are planned in bulk: for a length,
the sums of one, two or three other available lengths are looked up for one
that fills the gap exactly, and as many sequences as the counts allow are made
of that combination; what is left is packed by best fit, longest first.  Pieces
get their places on the executors from their rank among pieces of one length.

Null text counts as empty (its only id is the end id).  Rows that repeat a
``doc_id`` are packed like any other rows.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_text, slices_by_bytes, write_shared
from .token_file import TEXT_SLICE
from .tokens import encoder

#: A plan: (sequences made alike, lengths in them as (length, times) in order).
Plan = list[tuple[int, list[tuple[int, int]]]]


def _complement(counts: np.ndarray, pairs: np.ndarray, length: int, gap: int) -> list[int] | None:
    """One, two or three available lengths, none over ``length``, that add up to ``gap``; the longest first."""
    def free(x: int, taken: list[int]) -> bool:
        return counts[x] > taken.count(x)

    own = [length]
    if gap <= length and free(gap, own):
        return [gap]

    def two(total: int, most: int, taken: list[int]) -> list[int] | None:
        lo, hi = -(-total // 2), min(total - 1, most)
        if hi < lo:
            return None
        a = np.arange(hi, lo - 1, -1)
        for x in a[(counts[a] > 0) & (counts[total - a] > 0)].tolist():
            if free(x, taken) and free(total - x, [*taken, x]):
                return [x, total - x]
        return None

    if found := two(gap, length, own):
        return found
    lo, hi = -(-gap // 3), min(gap - 2, length)
    if hi < lo:
        return None
    a = np.arange(hi, lo - 1, -1)
    for x in a[(counts[a] > 0) & pairs[gap - a]].tolist():
        if free(x, own) and (found := two(gap - x, x, [*own, x])):
            return [x, *found]
    return None


def plan_sequences(histogram: dict[int, int], capacity: int) -> Plan:
    """Sequences of at most ``capacity`` for pieces counted by length.

    Exact complements can strand lengths that best fit alone would have paired, on small inputs above all;
    so the plan without complements is made too, and the one with fewer sequences stands.
    """
    return min((_plan(histogram, capacity, exact) for exact in (True, False)), key=lambda p: sum(t for t, _ in p))


def _plan(histogram: dict[int, int], capacity: int, exact: bool) -> Plan:
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        if not 0 < n <= capacity:
            raise ValueError(f"a piece of {n} ids does not fit in {capacity}")
        counts[n] = c
    has = (counts > 0).astype(np.float64)
    size = 2 * (capacity + 1)
    sums = np.fft.irfft(np.fft.rfft(has, size) ** 2, size)
    pairs = sums[:capacity + 1] > 0.5  # sums that two lengths made at the start
    plan: Plan = []
    for n in range(capacity, 0, -1):
        while exact and counts[n] > 0:
            rest = [] if n == capacity else _complement(counts, pairs, n, capacity - n)
            if rest is None:
                break
            need = Counter([n, *rest])
            times = min(int(counts[x]) // k for x, k in need.items())
            for x, k in need.items():
                counts[x] -= times * k
            plan.append((times, sorted(need.items(), reverse=True)))
    # best fit, longest first: open sequences are kept by gap, alike ones as one group
    gaps: list[int] = []
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(gap: int, times: int, items: list[tuple[int, int]]) -> None:
        if gap not in groups:
            groups[gap] = []
            insort(gaps, gap)
        groups[gap].append((times, items))

    for n in range(capacity, 0, -1):
        left = int(counts[n])
        while left:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                each = min(capacity // n, left)
                times, gap, items = left // each, capacity, []
            else:
                gap = gaps[at]
                times, items = groups[gap].pop()
                if not groups[gap]:
                    del groups[gap], gaps[at]
                each = min(gap // n, left)
                used = min(times, left // each)
                if used < times:
                    put(gap, times - used, items)
                times = used
            left -= times * each
            put(gap - each * n, times, [*items, (n, each)])
    return plan + [g for own in groups.values() for g in own]


class Places:
    """Sequence and offset of the r-th piece of each length under a plan."""

    def __init__(self, plan: Plan):
        segments: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: Counter = Counter()
        sequence = 0
        for times, items in plan:
            offset = 0
            for n, each in items:
                segments.setdefault(n, []).append((ranks[n], sequence, each, offset))
                ranks[n] += times * each
                offset += n * each
            sequence += times
        self.sequences = sequence
        self.segments = {n: np.array(s, np.int64).T for n, s in segments.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            first, base, each, at = self.segments[n]
            k = np.searchsorted(first, rank[own], "right") - 1
            j = rank[own] - first[k]
            sequence[own] = base[k] + j // each[k]
            offset[own] = at[k] + j % each[k] * n
        return sequence, offset


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Encoded documents cut into pieces: doc_id, piece, start, length, ids_crc32[, ids], part, nth.

    Only documents over ``capacity`` ids are cut.  ``nth`` numbers the pieces of one length within a task
    (``part``); ``ids`` holds little-endian unsigned 32-bit ids and is made on request.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
            for lo, hi in slices_by_bytes([len(t) for t in texts], TEXT_SLICE):
                ids, at = encoder(tokenizer).encode(texts[lo:hi], end_id)
                total = np.diff(at)
                cuts = -(-total // capacity)
                doc = np.repeat(np.arange(len(total)), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(total[doc] - start, capacity)
                begin = at[:-1][doc] + start
                order = np.argsort(length, kind="stable")
                by = length[order]
                new = np.flatnonzero(np.diff(by, prepend=-1))
                run = np.diff(np.append(new, len(by)))
                nth = np.empty(len(by), np.int64)
                nth[order] = np.arange(len(by)) - np.repeat(new, run) + seen[by]
                seen[by[new]] += run
                data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                own = [data[4 * a:4 * (a + n)] for a, n in zip(begin.tolist(), length.tolist())]
                cols = {"doc_id": keys.slice(lo, hi - lo).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start), "length": pa.array(length),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64())}
                if keep_ids:
                    cols["ids"] = pa.array([bytes(x) for x in own], pa.binary())
                cols |= {"part": pa.array(np.full(len(doc), part), pa.int32()), "nth": pa.array(nth)}
                yield pa.RecordBatch.from_pydict(cols)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_text().alias("text"))
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * keep_ids
              + "part int, nth long")
    return rows.mapInArrow(encode, schema)


def pack(pieces_: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to a *written* table of pieces (part, nth, length and any other columns)."""
    counts = pieces_.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = write_shared(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity
    places = Places(plan_sequences(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sequence, offset = places.of(f["length"].to_numpy(), (f["base"] + f["nth"]).to_numpy())
            yield f.drop(columns=["base", "nth", "part"]).assign(sequence_id=sequence, offset=offset)

    kept = [f for f in pieces_.schema if f.name not in ("part", "nth")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    return pieces_.join(bases, ["part", "length"]).select(*pieces_.columns, "base").mapInPandas(place, schema)

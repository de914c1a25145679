"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Rows are dealt into blocks.  In a block every dimension has a posting list in
order of the quantised component (``LEVELS`` levels); posting segments of a query
are processed by descending impact, the most they can add to a score.  After
each round the lower bound of the k-th best and the upper bounds of all rows
tell which rows can still be members.  Processing stops when that proves enough
rows out; the possible members are rescored exactly.  Every row of the block is
covered by a bound, so the result is exact.

Every part of the index, as read from its files, meets every part of the queries
in a task of its own; the queries are not sent through the driver nor copied for
each shuffle partition.  The best rows a task has found for a query raise the bar
for its later blocks and are all that it returns.

Components become ``floor(1024 * x)``; sums of products must fit 64 bits.  Null
vectors and those with null or non-finite components take no part.  Shorter
vectors are filled up with zeros.  Of equal scores the smaller vec_id is
better; rows with the query's own vec_id are not its candidates.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_shared

SCALE = 1024
LEVELS = 64
BLOCK_ROWS = 4_096
QUERY_ROWS = 256
ROUNDS = (0.5, 0.3, 0.15, 0.05, 0.0)  # impacts down to this share of the largest
RESCORE_SHARE = 0.25  # of a block: few enough to rescore
QUERY_PARTS = 16  # at most, so tasks are in proportion to the index
HELD_QUERIES = 100_000  # whose best rows a task holds at a time
NONE = np.empty(0, np.int64), np.empty(0, np.int64)


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and v, the integer components of usable vectors."""
    usable = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"))


def _packed(matrix: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold all of them."""
    kinds = (np.int8, np.int16, np.int32, np.int64)
    return matrix.astype(next(t for t in kinds if np.iinfo(t).min <= matrix.min() and matrix.max() <= np.iinfo(t).max)).tobytes()


def _unpacked(data: pa.Buffer, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"i{data.size // (rows * dims)}").reshape(rows, dims).astype(np.int64)


def _blocks(rows: DataFrame, size: int, dims: int) -> DataFrame:
    """Rows packed into blocks: block, ids (64-bit integers) and matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            lists = batch.column("v")
            at = lists.offsets.to_numpy().astype(np.int64)
            grid = np.zeros((len(ids), dims), np.int64)
            n = np.diff(at)
            grid[np.repeat(np.arange(len(ids)), n), np.arange(n.sum()) - np.repeat(at[:-1] - at[0], n)] = lists.values.to_numpy()[at[0]:at[-1]]
            for i in range(0, len(ids), size):
                yield pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + seq], pa.int64()),
                                                  "ids": pa.array([ids[i:i + size].tobytes()], pa.binary()),
                                                  "matrix": pa.array([_packed(grid[i:i + size])], pa.binary())})
                seq += 1

    return rows.mapInArrow(run, "block long, ids binary, matrix binary")


class BlockIndex:
    """Posting lists of one block: for each dimension, rows by descending level."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, levels: int = LEVELS):
        self.ids, self.matrix = ids, matrix
        self.low, self.high = matrix.min(axis=0), matrix.max(axis=0)
        self.step = np.maximum(1, -(-(self.high - self.low + 1) // levels))
        level = (matrix - self.low) // self.step
        self.levels = levels
        self.grid = level.T.astype(np.min_scalar_type(levels), order="C")  # (dims, rows)
        self.rows = np.argsort(-level, axis=0, kind="stable").T.copy()  # (dims, rows)
        self.level = np.take_along_axis(self.grid, self.rows, axis=1)
        # postings of dimension d at level l or above: the first starts[d, l]
        self.starts = np.stack([(level >= l).sum(axis=0) for l in range(levels + 1)], axis=1)

    def search(self, q: np.ndarray, own: int, k: int, bar: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows (scores, ids) of the block that can reach ``bar``; all that tie are weighed by id."""
        n, dims = self.matrix.shape
        size = np.abs(q)
        up = q > 0
        # scores count from the least a row can have: q times the low end, or the high end for negative q
        floor = int((q * np.where(up, self.low, self.low + self.step * self.levels - 1)).sum())
        unit = size * self.step
        top = unit * self.levels  # the largest impact of a dimension's segments
        exact = np.float64 if top.sum(dtype=np.float64) < 2 ** 53 else np.int64  # adds numbers of this size without loss
        bound = np.zeros(n, np.int64)  # proven score over the floor
        cut = np.zeros(dims, np.int64)  # segments of each dimension processed so far
        possible = np.arange(n)
        each, live = np.arange(dims), np.flatnonzero(size)
        for share in ROUNDS:
            least = share * float(top.max())
            # segment s (from 0) of a dimension adds unit * (levels - s) at most
            want = cut.copy()
            want[live] = np.maximum(cut[live], np.clip(np.ceil(self.levels - least / unit[live]), 0, self.levels).astype(np.int64) if share else self.levels)
            # from the highest level down, or from the lowest up for negative q
            start = self.starts[each, np.where(up, self.levels - cut, want)]
            stop = self.starts[each, np.where(up, self.levels - want, cut)]
            for d, i, j, of, rising in zip(each.tolist(), start.tolist(), stop.tolist(), unit.tolist(), up.tolist()):
                if i < j:
                    steps = self.level[d, i:j].astype(np.int64)
                    np.add.at(bound, self.rows[d, i:j], of * (steps if rising else self.levels - 1 - steps))
            cut = want
            rest = unit * (self.levels - cut)  # most that an unprocessed posting adds; a processed one, unit over its bound
            sure = floor + bound
            sure[self.ids == own] = np.iinfo(np.int64).min
            kth = int(np.partition(sure, n - k)[n - k]) if n > k else None
            best = max((x for x in (kth, bar) if x is not None), default=None)
            slack = (rest - unit).astype(exact)
            left = np.where(up, n - self.starts[each, self.levels - cut], self.starts[each, cut])  # unprocessed postings
            if share and best is not None and floor + int(unit.sum()) + (float(bound.sum()) + float(slack @ left)) / n > best:
                continue  # the mean upper bound reaches the best, so few rows are out
            edge = np.where(up, self.levels - cut, cut).astype(self.grid.dtype)
            unprocessed = (self.grid < edge[:, None]) ^ ~up[:, None]
            most = floor + int(unit.sum()) + bound + (slack @ unprocessed).astype(np.int64)
            possible = np.flatnonzero(most >= best) if best is not None else np.arange(n)
            if len(possible) <= max(k, RESCORE_SHARE * n):
                break
        possible = possible[self.ids[possible] != own]
        score, ids = self.matrix[possible] @ q, self.ids[possible]
        order = np.lexsort((ids, -score))[:k]
        return score[order], ids[order]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of every row for each row that ``is_query`` marks."""
    rows = write_shared(quantised(vectors), "vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    index = write_shared(_blocks(rows.repartition(F.xxhash64("vec_id")), BLOCK_ROWS, dims), "index")
    asked = write_shared(_blocks(rows.where(is_query).hint("rebalance"), QUERY_ROWS, dims), "queries")
    sent = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix")).repartition(
        max(1, min(QUERY_PARTS, -(-asked.count() // 2))))  # of two blocks or more, since every part builds the index anew

    names = ["block", "ids", "matrix", "q_block", "q_ids", "q_matrix"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        best: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}  # vec_id of the query, its best scores and their ids

        def so_far() -> pa.RecordBatch:
            query = np.repeat(np.array([x[0] for x in best.values()], np.int64), [len(x[1]) for x in best.values()])
            score, ids = (np.concatenate([np.empty(0, np.int64), *(x[i] for x in best.values())]) for i in (1, 2))
            best.clear()
            return pa.RecordBatch.from_pydict({"query_id": query, "vec_id": ids, "score": score})

        for batch in batches:
            for r in range(batch.num_rows):
                block, ids, matrix, q_block, q_ids, q_matrix = (batch.column(c)[r] for c in names)
                if block.as_py() != held:
                    ids = np.frombuffer(ids.as_buffer(), np.int64).copy()
                    held, own = block.as_py(), BlockIndex(ids, _unpacked(matrix.as_buffer(), len(ids), dims))
                if len(best) > HELD_QUERIES:
                    yield so_far()
                q_ids = np.frombuffer(q_ids.as_buffer(), np.int64)
                for i, (q_id, q) in enumerate(zip(q_ids.tolist(), _unpacked(q_matrix.as_buffer(), len(q_ids), dims))):
                    at = q_block.as_py(), i
                    _, known, of = best.get(at, (q_id, *NONE))
                    score, near = own.search(q, q_id, k, int(known[-1]) if len(known) == k else None)
                    score, near = np.concatenate([known, score]), np.concatenate([of, near])
                    first = np.lexsort((near, -score))[:k]
                    best[at] = q_id, score[first], near[first]
        yield so_far()

    found = index.crossJoin(sent.hint("shuffle_replicate_nl")).mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

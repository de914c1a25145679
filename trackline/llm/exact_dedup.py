"""Exact de-duplication by content-defined chunk recipes.

A text is cut where a rolling hash of its bytes says so, each chunk is replaced
by an identifier, and texts are equal when their ordered identifier lists are.
Identifiers are verified: all distinct chunk contents behind a digest are
compared, and if two differ the recipes are made again with the next, stronger
digest.  Contents are shuffled once, one copy per map task; documents themselves
only as lists of identifiers.

Null counts as empty text (an empty recipe).  Of equal texts the row with the
largest ``doc_id`` stays; a null ``doc_id`` sorts below every other.  Rows that
repeat both text and ``doc_id`` have the same verdict.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, write_shared

MIN_CHUNK, MAX_CHUNK, MASK_BITS = 2_048, 65_536, 12


def _xxh128(data) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(data)


def _sha256(data) -> bytes:
    return hashlib.sha256(data).digest()


#: Digests of chunks, weaker first.
DIGESTS: tuple[Callable, ...] = (_xxh128, _sha256)
_GEAR = np.random.default_rng(20).integers(0, 2 ** 32, 256, np.uint32)


def cut_points(data: bytes, least: int = MIN_CHUNK, most: int = MAX_CHUNK, bits: int = MASK_BITS) -> list[int]:
    """Ends of the chunks of ``data``; they depend on the content only, so equal texts are cut alike."""
    size = len(data)
    if size <= least:
        return [size] if size else []
    # gear hash of the last 32 bytes at every place, by doubling the window
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for width in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h = longer
    marks = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    out, last, i = [], 0, 0
    while size - last > least:
        i = int(np.searchsorted(marks, last + least))
        end = min(last + most, int(marks[i]) if i < len(marks) else size, size)
        out.append(end)
        last = end
    if last < size:
        out.append(size)
    return out


def _cut(docs: DataFrame, digest: Callable, contents: bool, sizes: tuple[int, int, int]) -> DataFrame:
    """Recipes of documents, or with ``contents`` the chunks themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("data")
            recipes, chunks = [], {}
            for value in raw:
                data = memoryview(value.as_buffer()) if value.is_valid else b""
                lo, own = 0, []
                for hi in cut_points(bytes(data), *sizes) if len(data) > sizes[0] else [len(data)] * bool(len(data)):
                    own.append(d := digest(data[lo:hi]))
                    if contents:
                        chunks[d, bytes(data[lo:hi])] = None
                    lo = hi
                recipes.append(own)
            if contents:
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in chunks], pa.binary()),
                                                  pa.array([c for _, c in chunks], pa.binary())], ["digest", "content"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_sha256"),
                                                  pa.array(recipes, pa.list_(pa.binary()))],
                                                 ["doc_id", "text_sha256", "recipe"])

    if contents:
        return docs.select("data").mapInArrow(run, "digest binary, content binary")
    return docs.select("doc_id", "data", F.sha2("data", 256).alias("text_sha256")).mapInArrow(
        run, "doc_id long, text_sha256 string, recipe array<binary>")


def recipes(docs: DataFrame, sizes: tuple[int, int, int] = (MIN_CHUNK, MAX_CHUNK, MASK_BITS),
            digests: tuple[Callable, ...] = DIGESTS) -> DataFrame:
    """doc_id, text_sha256 and the verified recipe of every row (a written table)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_text().cast("binary").alias("data"))
    for digest in digests:
        distinct = _cut(rows, digest, True, sizes).distinct()
        clash = distinct.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if clash.isEmpty():
            return write_shared(_cut(rows, digest, False, sizes), "recipes")
    raise RuntimeError("two different chunks share the strongest digest")


def exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    made = recipes(docs, **options)
    groups = made.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return made.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")

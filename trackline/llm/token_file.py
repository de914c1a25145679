"""Token-id files with bit-plane shuffling.

Documents are encoded and laid out in ascending ``doc_id`` order.  The files are
Parquet tables whose rows are the chunk index: a chunk holds whole documents of
about ``CHUNK_IDS`` ids, cut into fixed-size blocks.  Each block is transposed
into byte planes (or bit planes), every plane is compressed by itself with
zstandard, and a plane of zeros is stored as no bytes.  A chunk decodes alone,
so readers prune and run in parallel, and Spark's commit protocol makes a write
survive a lost executor on any file system Spark can write.

Null text counts as empty (its only id is the end id), null ids of documents
come first, rows that repeat a ``doc_id`` stand side by side in the order of
their texts, and an empty table gives an empty file.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_text, slices_by_bytes
from .tokens import encoder

BLOCK_IDS = 16_384
CHUNK_IDS = 65_536
TEXT_SLICE = 8_000_000  # bytes of text encoded at once
FILE_SCHEMA = ("shard int, chunk long, shard_start long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
               "layout string, block_ids int, planes array<binary>")
_FILE_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("shard_start", pa.int64()), ("n_ids", pa.int64()),
                         ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("layout", pa.string()),
                         ("block_ids", pa.int32()), ("planes", pa.list_(pa.binary()))])


def to_planes(ids: np.ndarray, layout: str) -> list[bytes]:
    """The uncompressed planes of one block: 4 of bytes or 32 of bits, lowest first."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if layout == "byte":
        return [p.tobytes() for p in octets.T]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(bits.T, axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, layout: str) -> np.ndarray:
    """The ids of one block; the inverse of :func:`to_planes`."""
    grid = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
    if layout == "byte":
        return np.ascontiguousarray(grid.T).view("<u4").ravel()
    bits = np.unpackbits(grid, axis=1, count=n, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u4").ravel()


def compress_ids(ids: np.ndarray, layout: str = "byte", block_ids: int = BLOCK_IDS, level: int = 1) -> list[bytes]:
    """Planes of all blocks of a chunk, one after another; zero planes as empty bytes."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
    return [pack(p) if p.count(0) < len(p) else b"" for i in range(0, len(ids), block_ids) for p in to_planes(ids[i:i + block_ids], layout)]


def decompress_ids(planes: list[bytes], n: int, layout: str = "byte", block_ids: int = BLOCK_IDS) -> np.ndarray:
    """The ids of a chunk."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    per, out = (4 if layout == "byte" else 32), []
    for k, i in enumerate(range(0, n, block_ids)):
        m = min(block_ids, n - i)
        width = m if layout == "byte" else -(-m // 8)
        own = [unpack(p) if p else bytes(width) for p in planes[k * per:(k + 1) * per]]
        out.append(from_planes(own, m, layout))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def token_chunks(docs: DataFrame, tokenizer: str, end_id: int = 0, layout: str = "byte", block_ids: int = BLOCK_IDS,
                 chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """The rows of a token file (``FILE_SCHEMA``); write them with any Spark writer.

    One shuffle: documents go by range of ``doc_id``, so that shard numbers follow the order.
    """
    if layout not in ("byte", "bit"):
        raise ValueError(f"layout {layout!r}: byte or bit")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, written = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        names: list = []
        counts: list[int] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal chunk, written, size
            ids = np.concatenate(held)
            row = pa.RecordBatch.from_pylist([{
                "shard": shard, "chunk": chunk, "shard_start": written, "n_ids": len(ids), "doc_ids": list(names),
                "doc_tokens": list(counts), "layout": layout, "block_ids": block_ids,
                "planes": compress_ids(ids, layout, block_ids)}], _FILE_ARROW)
            chunk, written, size = chunk + 1, written + len(ids), 0
            held.clear(), names.clear(), counts.clear()
            return row

        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for lo, hi in slices_by_bytes([len(t) for t in texts], TEXT_SLICE):
                ids, at = encoder(tokenizer).encode(texts[lo:hi], end_id)
                first = 0
                lens = np.diff(at).tolist()
                for i, n in enumerate(lens):
                    names.append(keys[lo + i])
                    counts.append(n)
                    size += n
                    if size >= chunk_ids:
                        held.append(ids[at[first]:at[i + 1]])
                        first = i + 1
                        yield close()
                if first < len(lens):
                    held.append(ids[at[first]:])
        if counts:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_text().alias("text"))
    return (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
            .mapInArrow(encode, FILE_SCHEMA))


def read_tokens(chunks: DataFrame) -> DataFrame:
    """Documents of a token file: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian
    unsigned 32-bit).

    Only the shard totals (one row per writing task) are summed up in order; chunks decode where they are read.
    """
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                raw = decompress_ids(row["planes"], row["n_ids"], row["layout"], row["block_ids"]).tobytes()
                offsets = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32))
                if len(raw) >= 2 ** 31:
                    raise ValueError("a chunk of 2 GB: write with a smaller chunk_ids or cut the document")
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, offsets, pa.py_buffer(raw)])
                start = row["base"] + row["shard_start"] + ends - counts
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(counts), ids],
                                                 ["doc_id", "start", "n_tokens", "ids"])

    return chunks.join(bases, "shard").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))

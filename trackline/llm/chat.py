"""Chat formatting by columnar byte assembly.

A turn is written as ``### role:``, a line break, the text, a line break and
``</turn>``.  Inside roles and texts the control strings ``###`` and ``</turn>``,
the backslash (and in roles the colon) get a backslash before them, so that a
formatted conversation reads back exactly.  For a batch of turns the segment
lengths, their cumulative offsets and the source of every byte are computed in
numpy, and headers and contents are gathered into one preallocated Arrow buffer.

A conversation is laid out in pieces of whole turns, about ``PIECE_BYTES`` each, in
order of (part, seq), so a conversation of any length is formatted by many tasks.
``loss`` holds the byte ranges (UTF-8, within the piece) of the assistant's texts.

Turns come in order of turn, ties by role and text, nulls first.  Null roles
and texts count as empty; a null conv_id is a conversation of its own; rows that
repeat are turns of their own.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices_by_bytes

PIECE_BYTES = 32_768
SLICE_BYTES = 4_000_000
SHUT = b"\n</turn>\n"
PIECE_SCHEMA = ("conv_id long, part int, seq long, n_turns long, formatted string, "
                "loss array<struct<begin: int, end: int>>")
_TURN = re.compile(rb"### ((?:[^\\:]++|\\\\|\\:|\\###|\\</turn>)*+):\n((?:[^\\<]++|\\\\|\\###|\\</turn>|<(?!/turn>))*+)</turn>\n")
_ESCAPED = re.compile(rb"\\(\\|:|###|</turn>)")


def escape(texts: pa.Array, role: bool = False) -> pa.Array:
    for mark in ("\\", "###", "</turn>", *([":"] if role else [])):
        texts = pc.replace_substring(texts, mark, "\\" + mark)
    return texts


def unescape(data: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", data) if b"\\" in data else data


def parse(data: bytes) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    out, at = [], 0
    while at < len(data):
        m = _TURN.match(data, at)
        if m is None:
            raise ValueError(f"not a formatted turn at byte {at}")
        out.append((unescape(m[1]).decode(), unescape(m[2][:-1]).decode()))
        at = m.end()
    return out


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large_string array without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns: (bytes, begin of each turn and the end, begin and end of each content)."""
    n = len(texts)
    named = escape(roles, True).dictionary_encode()
    heads = [b"### " + r.encode() + b":\n" for r in named.dictionary.to_pylist()]
    head_len = np.array([len(h) for h in heads], np.int64)
    head_at = np.cumsum(head_len) - head_len
    fixed = np.frombuffer(b"".join(heads) + SHUT, np.uint8)
    text_at, text = _bytes_of(escape(texts))
    pool = np.concatenate([fixed, text])
    kind = named.indices.to_numpy()
    source, length = np.empty((n, 3), np.int64), np.empty((n, 3), np.int64)
    source[:, 0], length[:, 0] = head_at[kind], head_len[kind]
    source[:, 1], length[:, 1] = text_at[:-1] + len(fixed), np.diff(text_at)
    source[:, 2], length[:, 2] = head_len.sum(), len(SHUT)
    ends = np.cumsum(length.ravel())
    begins = ends - length.ravel()
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)  # the Arrow buffer
    np.take(pool, np.repeat(source.ravel() - begins, length.ravel()) + np.arange(len(out)), out=out)
    begins, ends = begins.reshape(n, 3), ends.reshape(n, 3)
    return out, np.append(begins[:, 0], len(out)), begins[:, 1], ends[:, 1]


def format_chats(turns: DataFrame) -> DataFrame:
    """Pieces of formatted conversations (``PIECE_SCHEMA``) of rows (conv_id, turn, role, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            roles = batch.column("role").cast(pa.large_string())
            texts = batch.column("text").cast(pa.large_string())
            sizes = pc.binary_length(texts).to_pylist()
            for lo, hi in slices_by_bytes(sizes, SLICE_BYTES):
                data, at, begin, end = assemble(roles.slice(lo, hi - lo), texts.slice(lo, hi - lo))
                conv = batch.column("conv_id").slice(lo, hi - lo)
                key = conv.fill_null(0).to_numpy()
                empty = conv.is_null().to_numpy(zero_copy_only=False)
                new = np.ones(hi - lo, bool)
                new[1:] = (key[1:] != key[:-1]) | (empty[1:] != empty[:-1]) | (at[1:-1] // PIECE_BYTES != at[:-2] // PIECE_BYTES)
                first = np.flatnonzero(new)
                last = np.append(first[1:], hi - lo)
                offsets = at[np.append(first, hi - lo)].astype(np.int32)
                formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data))
                spoken = pc.equal(roles.slice(lo, hi - lo), "assistant").to_numpy(zero_copy_only=False)
                piece = np.cumsum(new) - 1
                own = np.flatnonzero(spoken)
                base = at[first][piece[own]]
                spans = pa.StructArray.from_arrays([pa.array((begin[own] - base).astype(np.int32)),
                                                    pa.array((end[own] - base).astype(np.int32))], ["begin", "end"])
                span_at = np.searchsorted(piece[own], np.arange(len(first) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [conv.take(pa.array(first)), pa.array(np.full(len(first), part, np.int32)), pa.array(seq + np.arange(len(first))),
                     pa.array(last - first), formatted, pa.ListArray.from_arrays(pa.array(span_at), spans)],
                    ["conv_id", "part", "seq", "n_turns", "formatted", "loss"])
                seq += len(first)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
            .drop("turn").mapInArrow(run, PIECE_SCHEMA))


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, parsed from its pieces: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Pieces stream through in order; only the running digests of one conversation are held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None

        def row() -> pa.RecordBatch:
            n, turns_, chars, loss, all_chars = state
            return pa.RecordBatch.from_pylist([{"conv_id": current, "n_turns": n, "turns_sha256": turns_.hexdigest(), "loss_chars": chars,
                                                "loss_sha256": loss.hexdigest(), "formatted_chars": all_chars}], schema)

        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            for conv, text, spans in zip(batch.column("conv_id").to_pylist(), batch.column("formatted"), batch.column("loss").to_pylist()):
                if conv != current:
                    if state is not None:
                        yield row()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                data = text.as_buffer().to_pybytes()
                for role, said in parse(data):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for s in spans:
                    said = unescape(data[s["begin"]:s["end"]])
                    state[2] += len(said.decode())
                    state[3].update(said)
                state[4] += len(data.decode())
        if state is not None:
            yield row()

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").select("conv_id", "formatted", "loss")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                   "formatted_chars long")

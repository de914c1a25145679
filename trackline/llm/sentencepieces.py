"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into units at places no piece of the vocabulary spans.  For every
distinct unit its substrings of up to the longest piece's length are exploded
and equi-joined to the piece table; the Viterbi path of the largest score is
folded over the edges, place by place for many units at once, as they pass.  A
character without a piece is an edge of its UTF-8 byte pieces, scored as the
library scores an unknown one.

The path maximises the sum of piece scores, as the library does for a unigram
model with these pieces and scores (tested against it; in double precision, where
the library's single precision blurs what follows an unknown character).  The public file holds
a model of the BPE kind, for which the library merges pairs instead: its ids
can differ, while both decode to the same text.

Units that are frequent in a bounded sample of documents (``HEAD``) are encoded
first and sent to every task; all others are encoded once for each chunk of a
task's texts, in front of the texts.  The choice moves work only, never a result.

Decoding looks up the bytes of every id in a small array, row by row.

A space becomes ``▁`` and a text gets one in front, as the model asks.  Null and
empty texts have no pieces.  Rows that repeat are encoded one by one.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from struct import Struct
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import doc_text, slices_by_bytes, write_shared

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
HEAD = 200_000  # rows sent to every task, of 64 characters at most
DECODED_IDS = 500_000  # decoded or put together at a time
HEAD_ROWS = 8_000  # documents of the sample that names the head
CHUNK, UNIT_ROWS = 4_000_000, 10_000  # units of the texts that a task takes together (one batch at least), rows of units at once
STRETCH = 1_024  # characters of a unit cut out at once
TEXT = Struct("<iqq")  # in front of a text's codes: doc_id is null, row, doc_id
FOLDED = 200_000, 2 ** 25  # edges or bytes folded together (one unit at least)


@dataclass(frozen=True)
class Pieces:
    """The vocabulary as a small table, fixed by the model file."""

    table: pd.DataFrame  # piece, id, score
    longest: int
    unknown_score: float
    first_byte: int  # id of <0x00>; the other bytes follow
    alone: str  # characters that stand in no longer piece
    letters_apart: bool  # no piece has a letter next to another character, but for spaces in front

    @staticmethod
    def load(path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        table = pd.DataFrame({"piece": [model.id_to_piece(i) for i in plain], "id": plain, "score": [model.get_score(i) for i in plain]})
        first = model.piece_to_id("<0x00>")
        if [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)] != list(range(first, first + 256)):
            raise ValueError("the model has no run of byte pieces")
        inner = table["piece"].str.replace(f"^{SPACE}+", "", regex=True)
        if inner.str.contains(SPACE).any():
            raise ValueError("a piece spans two words")
        kinds = inner.map(lambda p: {category(c)[0] == "L" for c in p})
        longer = set("".join(p for p in table["piece"] if len(p) > 1))
        return Pieces(table, int(table["piece"].str.len().max()), float(table["score"].min()) - UNKNOWN_PENALTY, first,
                      "".join(c for c in "\n\t0123456789" if c not in longer), bool((kinds.map(len) < 2).all()))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.table, "piece string, id int, score double")


def _cut(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, row (unique to a row) and units, the units of the text in its order."""
    text = F.when(doc_text() == "", "").otherwise(F.concat(F.lit(SPACE), F.replace(doc_text(), F.lit(" "), F.lit(SPACE))))
    alone = pieces.alone.replace("\n", "\\n").replace("\t", "\\t")
    kinds = [r"\p{L}", rf"[^{SPACE}\p{{L}}{alone}]"] if pieces.letters_apart else [f"[^{SPACE}{alone}]"]
    pattern = "|".join([*(f"{SPACE}*{k}+" for k in kinds), f"{SPACE}+", *([f"[{alone}]"] if alone else [])])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("units"))


def units(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, row (unique to a row), pos and unit; a text without units gives one row with null pos."""
    # numbered before the explode, which would otherwise come first
    return _cut(docs, pieces).select("doc_id", "row", F.posexplode_outer("units").alias("pos", "unit"))


def _folded(batch: pa.RecordBatch, along: list[str], first_byte: int) -> pa.RecordBatch:
    """unit, the columns ``along`` and ids (null for a row without a unit), one row per unit from whole units' edges.

    The fold over the places, of all units at once: the best path into a place has the largest sum of scores, of equal ones
    the one with the longest last edge.
    """
    uid, n, id_, score = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "n", "id", "score"))
    end = batch.column("end").fill_null(0).to_numpy()
    new = np.diff(uid, prepend=uid[0] - 1) != 0
    firsts, unit = np.flatnonzero(new), np.cumsum(new) - 1
    size = end[np.append(firsts[1:], len(uid)) - 1]
    base = np.cumsum(size + 1) - size - 1  # of a unit's places, from its start on
    best, chosen = np.zeros(int((size + 1).sum())), np.zeros(int((size + 1).sum()), np.int64)
    order = np.argsort(end, kind="stable")
    bounds = np.searchsorted(end[order], np.arange(1, int(size.max()) + 2))
    for place in range(1, int(size.max()) + 1):
        edge = order[bounds[place - 1]:bounds[place]]
        of, length = unit[edge], n[edge].astype(np.int64)
        total = best[base[of] + place - length] + score[edge]
        group = np.flatnonzero(np.diff(of, prepend=-1))
        top = np.maximum.reduceat(total, group)
        is_top = total == np.repeat(top, np.diff(np.append(group, len(edge))))
        longest = np.minimum.reduceat(np.where(is_top, np.arange(len(edge)), len(edge)), group)  # edges come longest first
        best[base[of[group]] + place], chosen[base[of[group]] + place] = top, edge[longest]
    on_path, left, at = np.zeros(len(uid), bool), np.flatnonzero(size), size.astype(np.int64)
    while len(left):
        edge = chosen[base[left] + at[left]]
        on_path[edge] = True
        at[left] -= n[edge].astype(np.int64)
        left = left[at[left] > 0]
    path = np.flatnonzero(on_path)
    of, ids = unit[path], id_[path].astype(np.int32)
    words, unknown = batch.column("unit").take(pa.array(firsts)), np.flatnonzero(ids < 0)
    count = np.ones(len(path), np.int64)
    if len(unknown):
        texts = {u: words[int(u)].as_py() for u in np.unique(of[unknown])}
        spelled = [texts[u][e - 1].encode() for u, e in zip(of[unknown].tolist(), end[path[unknown]].tolist())]
        count[unknown] = [len(x) for x in spelled]
        octet = np.repeat(ids < 0, count)
        ids = np.repeat(ids, count)
        ids[octet] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int32) + first_byte
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, count, len(firsts)).astype(np.int64))])
    paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(size == 0))
    return pa.RecordBatch.from_arrays([words, *(batch.column(c).take(pa.array(firsts)) for c in along), paths], ["unit", *along, "ids"])


def _paths(edges: Iterator[pa.RecordBatch], along: list[str], first_byte: int) -> Iterator[pa.RecordBatch]:
    """``_folded`` over edges that follow each other, unit by unit and place by place."""
    held: list[pa.RecordBatch] = []  # batches of edges; the last unit may go on in the next one
    rows, enough, before = 0, FOLDED[0], -1
    for batch in edges:
        if not batch.num_rows:
            continue
        uid = batch.column("uid").to_numpy()
        if uid[0] < before or (np.diff(uid) < 0).any():
            raise ValueError("edges of a unit do not follow each other")
        before = int(uid[-1])
        held.append(batch)
        rows += batch.num_rows
        if rows >= enough or sum(b.nbytes for b in held) >= FOLDED[1]:
            whole = pa.concat_batches(held)
            last = int(np.searchsorted(whole.column("uid").to_numpy(), before))  # where the last unit starts
            if last:
                yield _folded(whole.slice(0, last), along, first_byte)
            held, rows = [whole.slice(last)], whole.num_rows - last
            enough = max(FOLDED[0], 2 * rows)  # a long unit is not put together anew with every batch
    if held:
        yield _folded(pa.concat_batches(held), along, first_byte)


def encode_units(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """unit and ids, the best path of each distinct unit, and the other columns of ``distinct``.

    The edges of a unit come out of the explode one after the other and are folded as they pass, without
    a shuffle or sort of all edges, which are thirty times as many as the units.  The rows keep their order;
    those without a unit (null) pass with null ids.
    """
    along = [c for c in distinct.columns if c != "unit"]
    table = F.broadcast(pieces.frame(distinct.sparkSession))  # as many rows as the vocabulary has
    # a long unit in stretches, each with what a piece can reach back into, so that no substring is looked for far from the start
    numbered = distinct.select("unit", *along, F.monotonically_increasing_id().alias("uid"))
    stretch = numbered.select("unit", *along, "uid", F.explode_outer(
        F.expr(f"sequence(0, cast((length(unit) - 1) div {STRETCH} as int))")).alias("k")).select(
        "uid", *along, F.when(F.col("k") == 0, F.col("unit")).alias("unit"), F.length("unit").alias("size"), "k",
        F.greatest(F.col("k") * STRETCH - (pieces.longest - 1), F.lit(0)).alias("from"), F.expr(
            f"substring(unit, greatest(k * {STRETCH} - {pieces.longest - 1}, 0) + 1, {STRETCH + pieces.longest})").alias("part"))
    ends = stretch.select("*", F.explode_outer(F.sequence(F.col("k") * STRETCH + 1, F.least("size", (F.col("k") + 1) * STRETCH))).alias("end"))
    spans = ends.select("*", F.explode_outer(F.when(
        F.col("end").isNotNull(), F.sequence(F.least(F.lit(pieces.longest), "end"), F.lit(1), F.lit(-1)))).alias("n"))
    edges = spans.withColumn("piece", F.substring("part", F.col("end") - F.col("from") - F.col("n") + 1, F.col("n"))).join(
        table, "piece", "left").where("id is not null or n = 1 or n is null").select(
        "uid", *along, F.when(F.col("end") == 1, F.col("unit")).alias("unit"), "end", "n", F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("score", F.lit(pieces.unknown_score)).alias("score"))
    schema = StructType([*(StructField(f.name, f.dataType) for f in distinct.select("unit", *along).schema),
                         StructField("ids", ArrayType(IntegerType()))])
    first_byte = pieces.first_byte
    return edges.mapInArrow(lambda batches: _paths(batches, along, first_byte), schema)


def _head(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """unit and ids of the units that are frequent in a sample of ``docs``; written."""
    picked = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(HEAD_ROWS)
    sample = docs.join(F.broadcast(picked), "doc_id", "left_semi").select("doc_id", F.substring("text", 1, 20_000).alias("text"))
    common = (units(sample, pieces).where("unit is not null").groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "unit").limit(HEAD).select("unit").where(F.length("unit") <= 64))
    return write_shared(encode_units(common.repartition("unit"), pieces), "pieces-head")  # HEAD short rows at most


def _numbered(texts: Iterator[pa.RecordBatch], head: pa.Array) -> Iterator[pa.RecordBatch]:
    """A chunk of texts at a time: first its distinct units that are not in ``head``, then its texts as codes of their units,
    which are places in ``head`` or, behind those, among the chunk's units.

    A text is one packed column (row, doc_id, codes), empty for a chunk's first unit: the code that Spark makes for
    the steps that all units pass stays short enough to be compiled.
    """
    def chunk(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.concat_arrays([b.column("units").flatten() for b in batches]).dictionary_encode()
        distinct = words.dictionary
        code = pc.index_in(distinct, value_set=head).fill_null(-1).to_numpy().copy()
        rare = np.flatnonzero(code < 0)
        code[rare] = len(head) + np.arange(len(rare))
        for start in range(0, len(rare), UNIT_ROWS):
            nth = rare[start:start + UNIT_ROWS]
            mark = pa.array([b"" if start + i == 0 else None for i in range(len(nth))], pa.binary())
            yield pa.RecordBatch.from_arrays([distinct.take(pa.array(nth)), mark], ["unit", "packed"])
        codes, before = code[words.indices.to_numpy()].astype(np.int32), 0
        for batch in batches:
            packed = []
            for row, doc_id, size in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(),
                                         pc.list_value_length(batch.column("units")).fill_null(0).to_pylist()):
                packed.append(TEXT.pack(doc_id is None, row, doc_id or 0) + codes[before:before + size].tobytes())
                before += size
            yield pa.RecordBatch.from_arrays([pa.nulls(len(packed), pa.string()), pa.array(packed, pa.binary())], ["unit", "packed"])

    held, n = [], 0
    for batch in texts:
        held.append(batch)
        n += len(batch.column("units").flatten())
        if n >= CHUNK:
            yield from chunk(held)
            held, n = [], 0
    if held:
        yield from chunk(held)


def _filled(found: Iterator[pa.RecordBatch], head: pa.Array) -> Iterator[pa.RecordBatch]:
    """row, doc_id and ids of the texts: the ids of their codes, ``head``'s and those of the chunk's units in front of them."""
    heads, head_size = head.flatten().to_numpy(), pc.list_value_length(head).to_numpy()
    flat, size, start = heads, head_size, np.cumsum(head_size) - head_size
    more: list[pa.Array] = []  # paths of the chunk's units, not yet put behind the head
    for batch in found:
        length = pc.binary_length(batch.column("packed")).fill_null(-1).to_numpy()
        is_text = length > 0
        cuts = np.unique([0, *(np.flatnonzero(np.diff(is_text)) + 1), *np.flatnonzero(length == 0), batch.num_rows])
        for a, b in zip(cuts[:-1], cuts[1:]):  # runs of units and of texts
            part = batch.slice(a, b - a)
            if not is_text[a]:
                more = [part.column("ids")] if length[a] == 0 else [*more, part.column("ids")]
                size = None
                continue
            if size is None:
                size = np.concatenate([head_size, *(pc.list_value_length(m).to_numpy() for m in more)])
                flat, start = np.concatenate([heads, *(m.flatten().to_numpy() for m in more)]), np.cumsum(size) - size
            counts = (length[a:b] - TEXT.size) // 4
            for c, d in slices_by_bytes(counts.tolist(), DECODED_IDS):
                some = part.column("packed").slice(c, d - c).to_pylist()
                names = [TEXT.unpack_from(x) for x in some]
                code = np.concatenate([np.frombuffer(x, np.int32, offset=TEXT.size) for x in some])
                if len(code) and code.max() >= len(size):
                    raise ValueError("a text has other units than paths")
                ends = np.cumsum(size[code])
                to = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[code] - ends + size[code], size[code])
                of_row = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts[c:d])])]
                ids = pa.ListArray.from_arrays(pa.array(of_row, pa.int32()), pa.array(flat[to], pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([row for _, row, _ in names], pa.int64()),
                                                  pa.array([None if null else i for null, _, i in names], pa.int64()), ids], ["row", "doc_id", "ids"])


def encode(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """row (unique to a row), doc_id and ids of every text.

    A task takes a chunk of its texts at a time.  The chunk's distinct units that are not in the head go through the
    lattice in front of its texts, which then take the ids of all their units; nothing is shuffled.
    """
    head = _head(docs, pieces).toArrow()  # HEAD short rows at most
    words, paths = (pa.chunked_array(head.column(c).chunks, t).combine_chunks() for c, t in (("unit", pa.string()), ("ids", pa.list_(pa.int32()))))
    chunks = _cut(docs, pieces).mapInArrow(lambda batches: _numbered(batches, words),
                                           "unit string, packed binary")
    return encode_units(chunks, pieces).select("packed", "ids").mapInArrow(
        lambda batches: _filled(batches, paths), "row long, doc_id long, ids array<int>")


def encode_occurrences(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, row, pos and ids of every unit of every text, in one table; order by pos within a row."""
    looked_up = units(docs, pieces).join(F.broadcast(_head(docs, pieces)), "unit", "left")
    found = looked_up.where("unit is null or ids is not null")
    rest = looked_up.where("unit is not null and ids is null").select("doc_id", "row", "pos", "unit")
    paths = write_shared(encode_units(rest.select("unit").distinct(), pieces), "pieces-tail")
    return found.select("doc_id", "row", "pos", "ids").union(rest.join(paths, "unit").select("doc_id", "row", "pos", "ids"))


def octets(pieces: Pieces) -> pa.Array:
    """The bytes of every id, by id, and those of ids without any (empty) at the end."""
    plain = dict(zip(pieces.table["id"], (p.replace(SPACE, " ").encode() for p in pieces.table["piece"])))
    plain |= {pieces.first_byte + b: bytes([b]) for b in range(256)}
    return pa.array([plain.get(i, b"") for i in range(max(plain) + 2)], pa.binary())


def decode(encoded: DataFrame, pieces: Pieces, key: str | list[str] = "doc_id", strip: bool = True) -> DataFrame:
    """``key`` (a column or several) and text of every row of ``encoded``, from its ids; ``strip`` drops the space put in front."""
    keys = [key] if isinstance(key, str) else key
    table = octets(pieces)

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices_by_bytes(pc.list_value_length(batch.column("_ids")).fill_null(0).to_pylist(), DECODED_IDS):
                part = batch.slice(start, end - start)
                ids = part.column("_ids").flatten().fill_null(-1).to_numpy()
                one = table.take(pa.array(np.where((ids < 0) | (ids >= len(table)), len(table) - 1, ids)))
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(part.column("_ids")).fill_null(0).to_numpy())])
                ends = np.frombuffer(one.buffers()[1], np.int32, len(one) + 1)[ends] if len(one) else np.zeros(len(ends), np.int32)
                data = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), one.buffers()[2]])
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), data], [*keys, "octets"])

    chosen = encoded.select(*keys, F.col("ids").alias("_ids"))
    schema = StructType([*(StructField(f.name, f.dataType) for f in encoded.select(*keys).schema), StructField("octets", BinaryType())])
    text = F.decode("octets", "UTF-8")
    return chosen.mapInArrow(spelled, schema).select(*keys, (F.regexp_replace(text, "^ ", "") if strip else text).alias("text"))


def document_digests(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """Per row of ``docs``: doc_id, n_units, n_ids, ids_digest (sum over units of a hash of place and ids)."""
    of_unit = F.pmod(F.xxhash64("pos", "ids"), F.lit(2 ** 40))
    return (encode_occurrences(docs, pieces).groupBy("row", "doc_id")
            .agg(F.count("pos").alias("n_units"), F.coalesce(F.sum(F.size("ids").cast("long")), F.lit(0)).alias("n_ids"),
                 F.coalesce(F.sum(F.when(F.col("pos").isNotNull(), of_unit)), F.lit(0)).alias("ids_digest")).drop("row"))

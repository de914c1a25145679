"""MinHash near-duplicates with odd sketches.

Every document becomes its set of distinct five-word shingles.  Half of 256
MinHash samples are banded (32 bands of 4: a pair at similarity 0.75 is missed
with probability 5e-6), and all are folded into an odd sketch, a 1024-bit parity
bitmap; the population count of the XOR of two bitmaps estimates a high
similarity well enough to refuse candidates that are far off (four standard
deviations).  All others are confirmed on their full sets of 64-bit shingle
hashes.

Hot groups: documents with equal sets are one class, so copies never meet.
Within a bucket of a band no pairs are listed.  First every member meets one
centre of its bucket, the member that shares most buckets with others, and links
found make components.  In further rounds members outside their bucket's main
component meet another of its members, drawn by a hash, until hardly a
candidate is a link (linear in the members; each round about halves a group whose
pairs are linked as often as not).  Then members outside their bucket's main component meet all members
of other components, each pair in the first bucket it shares, which leaves no
pair of different components untested, so no link between components is lost.

Words: ``A-Z`` lower-cased, runs of ``[^\\x20\\x09-\\x0D]``.  Fewer than five words
make one shingle; null, empty and blank texts have no shingles and link with
nothing.  Rows that repeat a ``doc_id`` count as one document when linking; a
null ``doc_id`` links with nothing and is kept.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, write_shared

WORDS = 5
SAMPLES, ROWS, BANDED = 256, 4, 128
SKETCH_BITS = 1024
FINE_SAMPLES, FINE_BITS = 4096, 8192  # of the larger sketches that the remaining pairs are held against
STAR_ROUNDS = 8  # at most
FEW_LINKS = 100  # rounds end where fewer than one in so many candidates is a link; the rest is exact anyway
ODD_COLUMNS = [f"o{i}" for i in range(SKETCH_BITS // 64)]
WORD_CACHE = 200_000  # words of a task, about 200 bytes each
_rng = np.random.default_rng(2014)
_ODD = _rng.integers(0, 2 ** 63, FINE_SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 2 ** 63, FINE_SAMPLES, np.uint64)
_SLOT = _rng.integers(0, 2 ** 63, FINE_SAMPLES, np.uint64)
_PLACE = _rng.integers(0, 2 ** 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 2 ** 63, (BANDED // ROWS, 1), np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, made once each."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, width: int = WORDS, known: _Words | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of UTF-8 text; ``known`` keeps hashes of words for further texts."""
    known = _Words() if known is None else known
    words = text.lower().split()  # bytes: A-Z only, and white space is exactly x20, x09-x0D
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n < width:
        s = np.full(1, n, np.uint64) * _MIX
        for j in range(n):
            s = _mix(s + h[j:j + 1] * _PLACE[j % len(_PLACE)])
        return s
    s = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        s += h[j:n - width + 1 + j] * _PLACE[j % len(_PLACE)]
    return np.unique(_mix(s))


def minhash(shingles: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """The samples of a non-empty set."""
    low = np.full(samples, np.iinfo(np.uint64).max, np.uint64)
    step = 262_144 // samples
    for i in range(0, len(shingles), step):
        part = (shingles[i:i + step, None] ^ _XOR[:samples]) * _ODD[:samples]
        np.minimum(low, part.min(axis=0), out=low)
    return low


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples[:BANDED].reshape(-1, ROWS)
    key = _BAND[:, 0]
    for j in range(ROWS):
        key = _mix(key + rows[:, j] * _MIX)
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity of the samples that fall on each of ``bits`` bits (a power of two), as 64-bit integers."""
    slot = (_mix(samples + _SLOT[:len(samples)]) >> np.uint64(65 - bits.bit_length())).astype(np.int64)
    parity = np.bincount(slot, minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def most_different_bits(percent: int, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """Largest XOR population count taken as possible at this similarity: four standard deviations over the mean."""
    j = percent / 100
    away = 2 * samples * (1 - j)  # samples that differ, counted on both sides
    shrink = (1 - 2 / bits) ** away
    of_samples = 2 * math.sqrt(samples * j * (1 - j)) * shrink
    of_clashes = math.sqrt(2 * away * away / bits)  # pairs on one bit cancel
    return math.ceil(bits * (1 - shrink) / 2 + 4 * math.hypot(of_samples, of_clashes))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_text().cast("binary").alias("data"))


def sketches(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit digest of the set), bands, o0, o1 ..."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        known = _Words()  # let go with the task: workers outlive it and serve other operators
        for batch in batches:
            sizes, keys, bands, odd = [], [], [], []
            for value in batch.column("data"):
                s = shingle_set(value.as_py(), width, known)
                sizes.append(len(s))
                if len(s):
                    m = minhash(s)
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    bands.append(band_keys(m))
                    odd.append(odd_sketch(m))
                else:
                    keys.append(None)
                    bands.append(None)
                    odd.append(np.zeros(SKETCH_BITS // 64, np.int64))
            o = np.array(odd, np.int64).reshape(-1, SKETCH_BITS // 64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), *(pa.array(o[:, i]) for i in range(SKETCH_BITS // 64))],
                ["doc_id", "n_shingles", "set_key", "bands", *ODD_COLUMNS])

    return _rows(docs).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>, "
                                       + ", ".join(f"{c} long" for c in ODD_COLUMNS))


def full_sets(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """node (the doc_id) and shingles of the given documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            sets = [shingle_set(v.as_py(), width, known).view(np.int64) for v in batch.column("data")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))],
                                             ["node", "shingles"])

    return _rows(docs).mapInArrow(run, "node long, shingles array<long>")


def _fine_sketches(sets: DataFrame) -> DataFrame:
    """node and fine, its larger odd sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = [odd_sketch(minhash(np.array(v, np.int64).view(np.uint64), FINE_SAMPLES), FINE_BITS)
                    for v in batch.column("shingles").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(fine, pa.list_(pa.int64()))], ["node", "fine"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, fine array<long>")


def _possible(a: str, b: str, percent: int):
    """Odd sketches and sizes allow the similarity."""
    bits = sum((F.bit_count(F.col(f"{a}.o{i}").bitwiseXOR(F.col(f"{b}.o{i}"))) for i in range(SKETCH_BITS // 64)), F.lit(0))
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (bits <= most_different_bits(percent)) & (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (smallest node reachable) for every node of ``edges`` (a, b).

    Alternating large-star and small-star steps; each step is written, so a lost executor costs one step.
    """
    edges = write_shared(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct(), name)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(edges.join(low, "a").select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = write_shared(small, name)
        # done when each node has one edge, to a node that has none
        ends = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if ends.where("n > 1").isEmpty() and edges.join(ends.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
            .groupBy("node").agg(F.min("component").alias("component")))


def _labelled(rows: DataFrame, label: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their node, which is the node itself where no link is known."""
    if label is None:
        return rows.withColumn("component", F.col("node"))
    return rows.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _merged(label: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components after new links; what was known before goes in as one edge a node."""
    known = found if label is None else found.union(label.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return write_shared(components(known), "labels")


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = WORDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    drawn = write_shared(sketches(docs, width), "sketches")
    usable = drawn.where("set_key is not null and doc_id is not null")
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    member = write_shared(usable.select("doc_id", "set_key").join(classes, "set_key").select("doc_id", "node"), "classes")
    nodes = write_shared(usable.join(classes, "set_key").where("doc_id = node").drop("doc_id", "set_key"), "nodes")
    slim = nodes.select("node", "n_shingles", *ODD_COLUMNS)
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bucketed = write_shared(banded.join(shared, "key"), "buckets")
    shares = bucketed.groupBy("node").agg(F.sum("n").alias("shares"))
    bucketed = write_shared(bucketed.drop("n").join(shares, "node"), "buckets")

    # the sets of documents that share a bucket, from their texts
    wanted = bucketed.select(F.col("node").alias("doc_id")).distinct()
    sets = write_shared(full_sets(docs.join(wanted, "doc_id", "left_semi"), width), "sets")

    label = tested = None
    for turn in range(STAR_ROUNDS):
        # one centre a bucket, from the main component of each bucket that is not yet one component
        rows = _labelled(bucketed, label)
        rank = F.col("shares") if turn == 0 else F.xxhash64("node", F.lit(turn))
        by = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"),
                                                  F.max(F.struct(rank.alias("rank"), (-F.col("node")).alias("node"))).alias("c"))
        if turn == 0:
            main = by.groupBy("key").agg(F.max("c").alias("c"), F.lit(None).cast("long").alias("main"))
        else:
            main = by.groupBy("key").agg(F.max(F.struct("n", "component", "c")).alias("m"), F.count(F.lit(1)).alias("parts"))
            main = main.where("parts > 1").select("key", F.col("m.c").alias("c"), F.col("m.component").alias("main"))
        pairs = rows.join(main.select("key", "main", (-F.col("c.node")).alias("centre")), "key").where(
            "node <> centre and (main is null or component <> main)")
        pairs = pairs.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        near = (pairs.join(slim.alias("x"), F.col("a") == F.col("x.node")).join(slim.alias("y"), F.col("b") == F.col("y.node"))
                .where(_possible("x", "y", percent)).select("a", "b"))
        near = write_shared(near, "candidates")
        if near.isEmpty():
            break
        tested = near if tested is None else tested.union(near)
        found = write_shared(_confirm(near, sets, percent), "links")
        some = found.count()
        if some:
            label = _merged(label, found)
        if some * FEW_LINKS < near.count():
            break

    # the rest: members outside the main component meet every other component of their bucket
    rows = _labelled(bucketed, label)
    by = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = by.groupBy("key").agg(F.max(F.struct("n", "component")).alias("m"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rest = write_shared(rows.join(main.select("key", F.col("m.component").alias("main")), "key").join(nodes, "node"), "rest")
    if not rest.isEmpty():
        fine = write_shared(_fine_sketches(sets.join(rest.select("node").distinct(), "node", "left_semi")), "fine-sketches")
        rest = rest.join(fine, "node")
        apart_bits = F.aggregate(F.zip_with("x.fine", "y.fine", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, n: t + n)
        apart = rest.where("component <> main").alias("x").join(
            rest.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
            & _possible("x", "y", percent) & (F.array_intersect("x.bands", "y.bands")[0] == F.col("x.key"))
            & (apart_bits <= most_different_bits(percent, FINE_SAMPLES, FINE_BITS)))
        pairs = apart.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        found = write_shared(_confirm(write_shared(pairs, "candidates"), sets, percent), "links")
        if not found.isEmpty():
            label = _merged(label, found)

    if label is None:
        label = nodes.select("node", F.col("node").alias("component"))
    of_row = (member.join(label, "node", "left")
              .groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id")))
    return (drawn.select("doc_id", "n_shingles").join(of_row, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))

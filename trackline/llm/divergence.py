"""Source divergence audit: how far the sources of a language differ in their words.

Spark's ``CountVectorizer`` (``minDF`` documents, the largest integer as
``vocabSize``) turns documents into exact sparse count vectors.  Terms carry
their language (``term NUL lang``; no term holds a NUL), so that one pass fits
every language by itself.  The vectors are written and read back as plain index
and value arrays, and the weighted vectors of a (lang, source) group are summed term by
term, with partial sums in every task.  The driver holds a vocabulary, as
``CountVectorizer`` does; so terms are dealt by hash into ``slices``, each written
and fitted by itself, and it holds one slice at a time.  What a task reads is put
together first: ``CountVectorizer`` gets a term once for all documents of a group
that came together, with the number of its occurrences as the row's weight, and
for the document frequency as often as documents hold it, ``minDF`` times at most.

A group gives the kept term t with count c the share
``p = 1 + floor(10^9 * (c + 1) / (N + V))``, V the kept terms of the language and N
the group's count over them.  A pair of groups is evaluated sparsely: terms that
both hold are met in a join, terms that only one holds enter by a histogram of
their counts, terms that neither holds by their number.  All arithmetic is on
integers.

Null text, lang and source count as empty; empty texts make a group with counts
of 0; repeated rows are documents of their own; other columns are not read.  An
empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.session import scratch_path

from .common import doc_text, slices_by_bytes, write_shared

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SLICE_DOCS, SLICE_POWER = 20_000, 0.7
_ROWS = "group struct<lang:string,source:string>, weight long, terms array<string>"
_DEALT = f"slice int, part string, {_ROWS}"
_VECTORS = "group struct<lang:string,source:string>, weight long, v struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
#: Bytes of the terms' alphabet: A-Z lower-cased, every other ASCII character but a letter a separator, all of a non-ASCII one kept.
_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0 for b in range(256)], np.uint8)
_PLACE = np.random.default_rng(13).integers(0, 2 ** 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
BATCH_BYTES = 1_500_000  # of text cut at once; what it is cut with takes some fifty times that
TALLY_ROWS = 2_000_000  # words of groups that a task holds before it passes them on


def slices_for(docs: DataFrame) -> int:
    """Slices that keep the vocabulary of one within the driver's memory; vocabularies grow less than documents do."""
    return 1 + int((docs.count() / SLICE_DOCS) ** SLICE_POWER)


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts (binary) and the text each is of."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    low = _BYTES[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data is not None else np.empty(0, np.uint8)
    ends -= ends[0]
    inside = low != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(low)]
    begins[heads] = inside[heads]  # a text's first letter, whatever the text before ends with
    at = np.flatnonzero(begins)
    kept = low[inside]
    first = (np.cumsum(inside, dtype=np.int32) - inside)[at]
    terms = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(first, len(kept)).astype(np.int32)), pa.py_buffer(kept))
    return terms, np.searchsorted(ends, at, "right") - 1


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word, the same wherever it is met."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    first, size = ends[:-1] - ends[0], np.diff(ends)
    place = np.arange(len(data)) - np.repeat(first, size)
    mixed = data.astype(np.uint64) * _PLACE[place & 63] * (place.astype(np.uint64) + np.uint64(1))
    return np.add.reduceat(mixed, first) >> np.uint64(33)


def _summed(key: np.ndarray, *numbers: np.ndarray) -> list[np.ndarray]:
    """The distinct keys and, for each, the sums of ``numbers``."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    firsts = np.flatnonzero(np.diff(key, prepend=-1))
    return [key[firsts], *(np.add.reduceat(n[order], firsts) for n in numbers)]


class _Tally:
    """Words of many documents, counted by group as the texts come."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, texts: pa.Array, group: np.ndarray) -> None:
        """Texts (binary) and the number of each one's group."""
        terms, doc = _terms(texts)
        if not len(terms):
            return
        coded = terms.dictionary_encode()
        size = len(coded.dictionary)
        held, n = np.unique(doc * size + coded.indices.to_numpy(), return_counts=True)  # a document's words
        doc, word = np.divmod(held, size)
        key, n, docs = _summed(group[doc] * size + word, n, np.ones(len(n), np.int64))
        group, word = np.divmod(key, size)
        self.parts.append((group, pa.DictionaryArray.from_arrays(pa.array(word.astype(np.int32)), coded.dictionary), n, docs))
        self.rows += len(key)

    def take(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words, and per group and word that it holds: group, word's place, occurrences, documents; the tally is empty then."""
        coded = pa.chunked_array([p[1] for p in self.parts]).unify_dictionaries()
        words, word = coded.chunk(0).dictionary, np.concatenate([c.indices.to_numpy() for c in coded.chunks]).astype(np.int64)
        group, n, docs = (np.concatenate([p[i] for p in self.parts]) for i in (0, 2, 3))
        self.__init__()
        key, n, docs = _summed(group * len(words) + word, n, docs)
        return words, *np.divmod(key, len(words)), n, docs


def _lists(slot: np.ndarray, group: np.ndarray, number: np.ndarray, names: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The names of each slot, group and number as one list; the places of the first of each and the lists."""
    order = np.lexsort((number, group, slot))
    new = np.zeros(len(order), bool)
    for of in (slot, group, number):
        new |= np.diff(of[order], prepend=-1) != 0
    firsts = np.flatnonzero(new)
    return order[firsts], pa.ListArray.from_arrays(pa.array(np.append(firsts, len(order)), pa.int32()), names.take(pa.array(order)))


def documents_terms(docs: DataFrame, slices: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """slice, part, group (lang, source), weight and terms; a term carries its language.

    Documents are put together as they pass, so that a term takes one place for many.  ``counted``: the terms that a
    group holds ``weight`` times in these documents.  ``seen``: the terms that ``weight`` documents of the language hold
    or more, up to ``min_docs``; so a term is in as many of these rows as documents hold it, or in ``min_docs``.
    """
    def rows(tally: _Tally, langs: pa.Array, sources: pa.Array, lang_of: np.ndarray) -> Iterator[pa.RecordBatch]:
        words, group, word, n, held = tally.take()
        slot = (_hashes(words) % np.uint64(slices)).astype(np.int64)

        def batch(part: str, at: np.ndarray, word: np.ndarray, lang: pa.Array, source: pa.Array, weight: np.ndarray, lists: pa.Array):
            of = pa.StructArray.from_arrays([lang.take(pa.array(at)), source.take(pa.array(at))], ["lang", "source"])
            return pa.RecordBatch.from_arrays([pa.array(slot[word[at]].astype(np.int32)), pa.array([part] * len(at), pa.string()), of,
                                               pa.array(weight[at]), lists], ["slice", "part", "group", "weight", "terms"])

        lang = langs.take(pa.array(group))
        named = pc.binary_join_element_wise(words.take(pa.array(word)), lang, "\0")
        at, lists = _lists(slot[word], group, n, named)
        yield batch("counted", at, word, lang, sources.take(pa.array(group)), n, lists)
        key, held = _summed(lang_of[group] * len(words) + word, held)
        times = np.minimum(held, min_docs)
        key, nth = np.repeat(key, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
        of_lang, word = np.divmod(key, len(words))
        first_of = np.zeros(lang_of.max() + 1, np.int64)
        first_of[lang_of] = np.arange(len(lang_of))  # a group of the language
        lang = langs.take(pa.array(first_of[of_lang]))
        named = pc.binary_join_element_wise(words.take(pa.array(word)), lang, "\0")
        at, lists = _lists(slot[word], of_lang, nth, named)
        yield batch("seen", at, word, lang, pa.nulls(len(word), pa.string()), nth, lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if not whole.num_rows:
                continue
            lang, source = (whole.column(c).dictionary_encode() for c in ("lang", "source"))
            _, first, group = np.unique(lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy(),
                                        return_index=True, return_inverse=True)
            of_group = [whole.column(c).take(pa.array(first)) for c in ("lang", "source")]
            lang_of = lang.indices.to_numpy().astype(np.int64)[first]
            tally = _Tally()
            for lo, hi in slices_by_bytes(pc.binary_length(whole.column("text")).to_numpy(), BATCH_BYTES):
                tally.add(whole.column("text").slice(lo, hi - lo), group[lo:hi])
                if tally.rows > TALLY_ROWS:
                    yield from rows(tally, *of_group, lang_of)
            if tally.rows:
                yield from rows(tally, *of_group, lang_of)

    filled = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), doc_text().cast("binary").alias("text"))
    return filled.mapInArrow(run, _DEALT)


def group_counts(docs: DataFrame, min_docs: int = MIN_DOCS, slices: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(group_id, lang, source) of all groups, (term_id, term, lang) of the kept terms, (group_id, term_id, n) of the groups that hold them."""
    spark = docs.sparkSession
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = write_shared(groups.withColumn("group_id", F.monotonically_increasing_id()), "divergence-group-ids")
    known = groups.select("group_id", F.struct("lang", "source").alias("group"))
    dealt, vocabulary, counts = (scratch_path(spark, f"llm-divergence-{name}") for name in ("terms", "vocabulary", "sums"))
    # a model needs a term: one of no language and no letters, held by so many documents
    held = spark.createDataFrame([(k, part, None, 1, ["\0"]) for k in range(slices) for part in ["counted"] + ["seen"] * min_docs], _DEALT)
    documents_terms(docs, slices, min_docs).union(held.coalesce(1)).write.partitionBy("slice", "part").parquet(dealt)
    for k in range(slices):
        # a slice's own folders and, for results, one table of all slices: neither listings nor plans grow with the slices
        seen, counted = (spark.read.schema(_ROWS).parquet(os.path.join(dealt, f"slice={k}", f"part={part}")) for part in ("seen", "counted"))
        model = CountVectorizer(inputCol="terms", outputCol="v", minDF=float(min_docs), vocabSize=2 ** 31 - 1).fit(seen.select("terms"))
        path = scratch_path(spark, "llm-divergence-vectors")
        model.transform(counted.where(F.col("group").isNotNull())).select("group", "weight", "v").write.parquet(path)
        # the vocabulary as the model stores it, so that this process holds none of it
        stored = scratch_path(spark, "llm-divergence-model")
        model.save(stored)
        names = spark.read.schema("vocabulary array<string>").parquet(os.path.join(stored, "data")).select(F.posexplode("vocabulary").alias("i", "name"))
        term_id = (F.col("i").cast("long") * slices + k).alias("term_id")
        names.where(F.col("name") != "\0").select(
            term_id, F.split_part("name", F.lit("\0"), F.lit(1)).alias("term"), F.split_part("name", F.lit("\0"), F.lit(2)).alias("lang")).write.mode("append").parquet(vocabulary)
        # the vectors' own storage type: parallel arrays of indices and values
        held_by = spark.read.schema(_VECTORS).parquet(path).join(known, "group").select(
            "group_id", "weight", F.explode(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x"))).alias("e"))
        sums = held_by.groupBy("group_id", F.col("e.i").alias("i")).agg(F.sum(F.col("weight") * F.col("e.x").cast("long")).alias("n"))
        sums.select("group_id", term_id, "n").write.mode("append").parquet(counts)
    return (groups, spark.read.schema("term_id long, term string, lang string").parquet(vocabulary),
            spark.read.schema("group_id long, term_id long, n long").parquet(counts))


def _share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), exact for any long."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + 1)
    return F.lit(1).cast("long") + F.call_function("div", over, (total + size).cast("decimal(20,0)"))


def _term(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, slices: int = 1) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    groups, vocabulary, counts = group_counts(docs, min_docs, slices)
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    totals = counts.groupBy("group_id").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    zero = F.lit(0).cast("long")
    of_group = (groups.join(sizes, "lang", "left").join(totals, "group_id", "left")
                .select("group_id", "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("size", "total", "held")))
                .withColumn("z", F.when(F.col("size") > 0, _share(zero, F.col("total"), F.col("size")))))
    of_group = write_shared(of_group, "divergence-groups")
    shares = write_shared(counts.join(of_group, "group_id").select(
        "group_id", "term_id", "n", "z", _share(F.col("n"), F.col("total"), F.col("size")).alias("p")), "divergence-shares")

    # terms: against the whole language; a term_id is of one language
    whole = of_group.groupBy("lang").agg(F.sum("total").alias("whole"))
    against = of_group.join(whole, "lang").select("group_id", "whole", "size")
    of_lang = shares.select("group_id", "term_id", "p", F.sum("n").over(Window.partitionBy("term_id")).alias("n")).join(against, "group_id")
    terms = (of_lang.select("group_id", "term_id", "p", _share(F.col("n"), F.col("whole"), F.col("size")).alias("q")).where("p > q")
             .select("group_id", "term_id", F.expr(_term("p", "q")).alias("value")))
    # the highest values with all their ties, and of these the first by their terms
    by_value = Window.partitionBy("group_id").orderBy(F.desc("value"))
    terms = terms.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top_terms)
    order = Window.partitionBy("group_id").orderBy(F.desc("value"), "item")
    terms = (terms.join(vocabulary.select("term_id", F.col("term").alias("item")), "term_id")
             .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))
    terms = terms.join(of_group.select("group_id", "lang", "source"), "group_id")

    # pairs: terms that both groups hold
    x, y = shares.alias("x"), shares.alias("y")
    both = x.join(y, (F.col("x.term_id") == F.col("y.term_id")) & (F.col("x.group_id") < F.col("y.group_id")))
    sums = {"n": "1", "ab": _term("x.p", "y.p"), "ba": _term("y.p", "x.p"), "az": _term("x.p", "y.z"), "za": _term("y.z", "x.p"),
            "bz": _term("y.p", "x.z"), "zb": _term("x.z", "y.p")}
    both = both.groupBy(F.col("x.group_id").alias("a"), F.col("y.group_id").alias("b")).agg(*(F.expr(f"sum({e})").alias(k) for k, e in sums.items()))
    flat = write_shared(both, "divergence-common")
    # per ordered pair (group, item): common terms, their value, and what the one-sided formulas would count of them
    common = flat.select(F.col("a").alias("group_id"), F.col("b").alias("item_id"), "n", F.col("ab").alias("value"),
                         F.col("az").alias("p_zero"), F.col("zb").alias("zero_q")).union(
        flat.select("b", "a", "n", "ba", "bz", "za"))
    # terms that one of them holds: by histogram of the counts
    counted = write_shared(shares.groupBy("group_id", "p").agg(F.count(F.lit(1)).alias("m")), "divergence-histogram")
    pairs = of_group.join(of_group.select("lang", F.col("group_id").alias("item_id"), F.col("source").alias("item"), F.col("held").alias("item_held"),
                                          F.col("z").alias("item_z")), "lang").where("group_id <> item_id")
    pairs = write_shared(pairs.select("group_id", "item_id", "lang", "source", "item", "size", "held", "item_held", "z", "item_z"), "divergence-pairs")
    sided = counted.join(pairs.select("group_id", "item_id", "item_z"), "group_id").groupBy("group_id", "item_id").agg(
        F.expr(f"sum(m * ({_term('p', 'item_z')}))").alias("as_p"), F.expr(f"sum(m * ({_term('item_z', 'p')}))").alias("as_q"))
    sided = write_shared(sided, "divergence-sided")
    pairs = (pairs.join(common, ["group_id", "item_id"], "left")
             .join(sided.drop("as_q"), ["group_id", "item_id"], "left")
             .join(sided.select(F.col("group_id").alias("item_id"), F.col("item_id").alias("group_id"), "as_q"), ["group_id", "item_id"], "left"))
    got = lambda c: F.coalesce(F.col(c), zero)
    neither = F.col("size") - F.col("held") - F.col("item_held") + got("n")
    value = F.when(F.col("size") > 0, got("value") + got("as_p") - got("p_zero") + got("as_q") - got("zero_q")
                   + neither * F.expr(_term("z", "item_z"))).otherwise(zero)
    pairs = pairs.select("group_id", "lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(order))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").union(
        terms.select("lang", "source", F.lit("term"), "item", "value", "rank"))

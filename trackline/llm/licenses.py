"""License scan with ordered signature rules, in DataFrame functions throughout.

A text's words are taken out once.  Rules (``license_rules``) are looked for only
around the few words that one of them needs, in a window of ``AROUND`` words on
either side, and only rules whose keyword stands in that window are tried.  A
match counts where it spans the word it was looked for at, so that every place is found
once and the work grows with those words, however long the text.

Of detections whose words lie within another's, the one of lower priority goes; of
equal priority the shorter one; of equal words the later rule.  One pass over a
text's detections in order of their first word settles that, with a running
largest end per priority.  Detections of text that only looks like a license then go
too.

Words: ``A-Z`` lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  The base
phrases (``BASE``) are counted at every place, suppressed or not, and their labels
stay.  The score is one less the product of what each label's surest detection
leaves in doubt.  Null and empty texts have no words; a null doc_id and repeated
rows are documents of their own; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_text, write_shared
from .license_rules import Rule, rules

AROUND = 32
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """row (unique to a row), doc_id, n_words, and the words of texts that hold an anchor."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), doc_text().alias("text"))
    rows = rows.select("row", "doc_id", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    some = F.exists("words", lambda w: F.lower(w).isin(anchors))
    return rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.when(some, F.col("words")).alias("words"))


def _whole(rule: Rule) -> str:
    return f"(?<= )(?:{rule.pattern})(?= )"


def _hits(own: tuple[Rule, ...], order: dict[Rule, int]) -> Column:
    """The rules of an anchor that match the window, keyword by keyword."""
    by_keyword: dict[tuple[str, ...], list[Rule]] = {}
    for r in own:
        by_keyword.setdefault(r.keywords, []).append(r)
    none = F.array().cast("array<int>")

    def gated(keywords: tuple[str, ...], group: list[Rule]) -> Column:
        there = F.lit(False)
        for k in keywords:
            there = there | F.col("window").contains(f" {k} ")
        return F.when(there, F.array(*(F.when(F.col("window").rlike(_whole(r)), F.lit(order[r])) for r in group))).otherwise(none)

    return F.flatten(F.array(*(gated(k, g) for k, g in by_keyword.items())))


def detections(words: DataFrame, given: list[Rule] | None = None) -> DataFrame:
    """row, rule, label, priority, weight, base, first and end (words, end not included), kept: every place a rule matches."""
    given = rules() if given is None else given
    order = {r: i for i, r in enumerate(given)}
    anchors = sorted({a for r in given for a in r.anchors})
    low = words.where("words is not null").select("row", F.transform("words", lambda w: F.translate(w, UPPER, LOWER)).alias("words"))
    at = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(anchors), i)))
    # the words go along within the stage and each row keeps its own window only
    around = low.select("row", "words", F.explode(at).alias("at")).select(
        "row", "at", F.greatest(F.col("at") - AROUND, F.lit(0)).alias("from"), F.element_at("words", F.col("at") + 1).alias("word"),
        F.concat(F.lit(" "), F.array_join(F.slice("words", F.greatest(F.col("at") - AROUND, F.lit(0)) + 1,
                                                  F.least(F.col("at"), F.lit(AROUND)) + AROUND + 1), " "), F.lit(" ")).alias("window"))
    of_word = {a: tuple(r for r in given if a in r.anchors) for a in anchors}
    cases = F
    for own in dict.fromkeys(of_word.values()):
        cases = cases.when(F.col("word").isin([a for a in anchors if of_word[a] == own]), _hits(own, order))
    attributes = F.array(*(F.struct(F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.weight).alias("weight"),
                                    F.lit(r.base).alias("base"), F.lit(_whole(r)).alias("pattern")) for r in given))
    hits = around.withColumn("rule", F.explode(F.array_compact(cases))).withColumn("hit", F.element_at(attributes, F.col("rule") + 1)).select(
        "row", "at", "from", "window", "rule", "hit.*")
    # words before a match: blanks in the texts before and between the matches, and in the matches before it
    placed = hits.withColumn("m", F.expr("regexp_extract_all(window, pattern, 0)")).withColumn("g", F.expr("split(window, pattern, -1)"))
    blanks = "length({0}) - length(replace({0}, ' ', ''))"
    spans = f"""transform(sequence(1, size(m)), j -> named_struct(
        'first', aggregate(slice(g, 1, j), 0, (n, s) -> n + {blanks.format('s')}) + aggregate(slice(m, 1, j - 1), 0, (n, s) -> n + {blanks.format('s')})
                 - 1 + `from`,
        'n', {blanks.format('m[j - 1]')} + 1))"""
    spans = placed.withColumn("span", F.explode(F.expr(spans))).where("span.first <= at and at < span.first + span.n").select(
        "row", "rule", "priority", "label", "weight", "base", F.col("span.first").cast("long").alias("first"),
        (F.col("span.first") + F.col("span.n")).cast("long").alias("end"))
    own = spans.repartition("row").dropDuplicates(["row", "rule", "first", "end"])
    before = Window.partitionBy("row").orderBy("first", F.desc("end"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    levels = sorted({r.priority for r in given})
    for p in levels:
        reach = F.max(F.when(F.col("priority") == p, F.col("end"))).over(before)
        inside = inside | ((F.col("priority") <= p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return own.withColumn("kept", ~inside)


def _listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")


def scan(docs: DataFrame, given: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document: row, doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; and its detections by row."""
    given = rules() if given is None else given
    words = write_shared(_words(docs, sorted({a for r in given for a in r.anchors})), "license-words")
    found = write_shared(detections(words, given), "license-detections")
    base, own = F.col("base"), F.col("kept") & (F.col("label") != "")
    labelled = found.where(base | own).groupBy("row", "label").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"), F.max("weight").alias("weight"))
    by_row = labelled.groupBy("row").agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
        _listed(F.collect_set(F.when(F.col("n_base") > 0, F.col("label")))).alias("base_labels"),
        _listed(F.collect_set("label")).alias("labels"), F.round(1 - F.exp(F.sum(F.log1p(-F.col("weight")))), 6).alias("score"))
    out = words.select("row", "doc_id", "n_words").join(by_row, "row", "left")
    return out.select("row", "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score")), found

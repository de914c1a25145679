"""URL filter: rules first, then naive Bayes over segmented host names and path tokens.

Host names run words together.  Each label of a host is split by a unigram
Viterbi: its substrings are joined to the word counts of the pages' own texts,
and the likeliest path wins.  A multinomial naive Bayes over the words of the
host and the tokens of the path, trained on the urls that a rule decides, judges
all others.  Token counts are kept in 2^16 hashed buckets, so the model has a
fixed size whatever the input.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path: then up to ``?``, ``#`` or the end.  A null url or one without ``://`` has
neither and is judged by the prior.  With nothing to train on, urls are allowed.
Rows that repeat are judged one by one.  Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_shared

BUCKETS = 2 ** 16
LONGEST_WORD = 20
LEAST_COUNT = 3  # occurrences that make a word one
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains when the url's path starts with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        of_host = (F.col("host") == self.host) | F.col("host").endswith("." + self.host)
        return of_host & F.col("path").startswith(self.path)


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return (pages.withColumn("_rest", rest)
            .withColumn("host", F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), _UPPER, _LOWER))
            .withColumn("path", F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def with_rule(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule (the longest that fits, or null) and rule_verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        name, verdict = F.when(r.fits(), r.name).otherwise(name), F.when(r.fits(), r.verdict).otherwise(verdict)
    return pages.withColumn("rule", name).withColumn("rule_verdict", verdict)


def word_counts(pages: DataFrame) -> DataFrame:
    """Words of the pages' texts (tags dropped) with their counts."""
    plain = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "(?s)<(script|style)\\b.*?</\\1>|<[^>]*>", " "))
    word = F.explode(F.regexp_extract_all(plain, F.lit("[a-z]+"), F.lit(0))).alias("word")
    return (pages.select(word).where(F.length("word") <= LONGEST_WORD).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT))


def segment(labels: DataFrame, words: DataFrame) -> DataFrame:
    """label and its words, by unigram Viterbi; letters that no word covers stand alone."""
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    base = labels.select("label").where("label <> ''").distinct()
    spans = base.select("label", F.explode(F.expr(
        f"flatten(transform(sequence(1, length(label)), i -> transform(sequence(1, least({LONGEST_WORD}, length(label) - i + 1)), "
        "n -> named_struct('at', i - 1, 'n', n))))")).alias("s"))
    edges = (spans.select("label", "s.at", "s.n", F.expr("substr(label, s.at + 1, s.n)").alias("word")).join(words.withColumnRenamed("n", "count"), "word")
             .groupBy("label").agg(F.collect_list(F.struct("at", "n", F.log(F.col("count") / total).alias("p"))).alias("edges")))

    @F.pandas_udf("array<string>")
    def best(label: pd.Series, edges: pd.Series) -> pd.Series:
        alone = math.log(0.5 / total)
        out = []
        for text, own in zip(label, edges):
            ending: dict[int, list] = {}
            for e in own if own is not None else ():
                ending.setdefault(e["at"] + e["n"], []).append((e["at"], e["p"]))
            score, back = [0.0], [0]
            for end in range(1, len(text) + 1):
                at, p = max([(end - 1, alone), *ending.get(end, ())], key=lambda x: (score[x[0]] + x[1], -x[0]))
                score.append(score[at] + p)
                back.append(at)
            words_, end = [], len(text)
            while end:
                words_.append(text[back[end]:end])
                end = back[end]
            out.append(words_[::-1])
        return pd.Series(out)

    return base.join(edges, "label", "left").select("label", best("label", "edges").alias("words"))


def with_tokens(pages: DataFrame, words: DataFrame) -> DataFrame:
    """Adds tokens: words of the host's labels, then the path's (numbers as one token)."""
    host = pages.select("host").distinct()
    label = host.select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))).alias("k", "label"))
    split = label.join(segment(label, words), "label")
    of_host = split.groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "words"))), lambda s: s["words"])).alias("_words"))
    in_path = F.filter(F.split(F.regexp_replace(F.lower("path"), "[0-9]+", " # "), "[^\\p{L}#]+"), lambda t: t != "")
    tokens = F.concat(F.transform(F.coalesce("_words", F.array().cast("array<string>")), lambda t: F.concat(F.lit("host:"), t)),
                      F.transform(in_path, lambda t: F.concat(F.lit("path:"), t)))
    return pages.join(of_host, "host", "left").withColumn("tokens", tokens).drop("_words")


def judge(pages: DataFrame) -> DataFrame:
    """Adds verdict to pages with tokens and rule_verdict (a written table)."""
    slot = F.pmod(F.xxhash64("t"), F.lit(BUCKETS))
    labelled = pages.where("rule_verdict is not null")
    counts = (labelled.select("rule_verdict", F.explode("tokens").alias("t")).groupBy("rule_verdict", slot.alias("slot"))
              .agg(F.count(F.lit(1)).alias("n")).collect())  # two rows a bucket at most
    of_class = {r["rule_verdict"]: r["n"] for r in labelled.groupBy("rule_verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = {v: np.ones(BUCKETS) for v in ("block", "allow")}
    for r in counts:
        table[r["rule_verdict"]][r["slot"]] += r["n"]
    weights = np.log(table["block"] / table["block"].sum()) - np.log(table["allow"] / table["allow"].sum())
    prior = math.log((of_class.get("block", 0) + 0.5) / (of_class.get("allow", 0) + 0.5)) if of_class else -1.0
    if not of_class:
        weights[:] = 0

    @F.pandas_udf("boolean")
    def blocked(slots: pd.Series) -> pd.Series:
        return pd.Series([prior + float(weights[np.asarray(s, np.int64)].sum()) > 0 for s in slots])

    by_method = F.when(blocked(F.transform("tokens", lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)))), "block").otherwise("allow")
    return pages.withColumn("verdict", F.coalesce("rule_verdict", by_method))


def filter_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, tokens."""
    parts = with_rule(with_parts(pages.select("page_id", "url")), rules)
    words = write_shared(word_counts(pages), "url-words")
    ready = write_shared(with_tokens(parts, words), "url-tokens")
    return judge(ready).select("page_id", "host", "path", "rule", "verdict", "tokens")

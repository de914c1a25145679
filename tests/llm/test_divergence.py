"""op13 against a brute force in whole numbers."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from trackline.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, group int, n string, value int"


def brute(rows, top=200):
    docs = []
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        docs.append((re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low), lang or "", source or ""))
    out = []
    for lang in {d[1] for d in docs}:
        df = Counter(t for w, l, _ in docs if l == lang for t in set(w))
        kept = {t for t, n in df.items() if n >= 3}
        counts: dict[str, Counter] = defaultdict(Counter)
        for w, l, s in docs:
            if l == lang:
                counts[s].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())

        def share(c: Counter) -> dict[str, int]:
            total = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        q_lang, p = share(whole), {s: share(c) for s, c in counts.items()}
        for s in counts:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != s]
            term = [(t, (p[s][t] - q_lang[t]) ** 2 // q_lang[t]) for t in kept if counts[s][t] and p[s][t] > q_lang[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def rows_for(seed: int = 3):
    import random
    draw = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "délta", "ÉPSILON", "zeta", "eta42", "x", "ñ", "𝔘nicode", "K-elvin"]
    rows = []
    for i in range(120):
        lang, source = draw.choice(["en", "fr", None]), draw.choice(["a", "b", "B", None, "é"])
        rows.append((" ".join(draw.choices(words, k=draw.randrange(0, 30))), lang, source))
    rows += [(None, "en", "only-null"), ("", "xx", "empty"), ("one two", "yy", "rare"), (None, None, None)]
    rows += [("copy of copies", "zz", "s")] * 5 + [("copy", "zz", "t"), ("copies 1.copies\tCOPY", "zz", "u")]
    rows.append(("alpha\n" * 60_000 + "beta", "en", "long"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i % 7 if i % 5 else None, *r, "alpha", 1, "x", 2) for i, r in enumerate(rows)], SCHEMA)


def result(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("slices", [1, 3])
def test_equals_brute_force(spark, slices):
    rows = rows_for()
    got = result(divergence.divergences(frame(spark, rows), slices=slices))
    assert got == brute(rows)
    assert any(r[0] == "xx" and r[2] == "pair" for r in brute(rows)) is False  # a single source has no pair
    assert {r[1] for r in got if r[0] == "en" and r[2] == "pair"} >= {"only-null", "long", ""}


def test_top_terms_and_empty_table(spark):
    rows = rows_for(5)
    assert result(divergence.divergences(frame(spark, rows), top_terms=2)) == brute(rows, 2)
    assert result(divergence.divergences(frame(spark, rows).limit(0))) == []


def test_counts_beyond_long_arithmetic(spark):
    """10^9 times a count passes 64 bits; shares stay exact."""
    from pyspark.sql import functions as F
    got = spark.sql("select 99999999999 as n, 300000000000 as t, 7 as v").select(divergence._share(F.col("n"), F.col("t"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * 10 ** 11 // (3 * 10 ** 11 + 7)


def test_terms_of_many_documents_are_put_together(spark):
    """What the models get follows the distinct terms of a group, not the texts."""
    docs = spark.createDataFrame([("alpha beta BETA", "en", "a")] * 400 + [("beta gamma", "en", None)] * 2, "text string, lang string, source string")
    rows = divergence.documents_terms(docs.coalesce(1), 1).collect()
    got = sorted((r["part"], r["group"]["source"] or "", r["weight"], sorted(t.split("\0")[0] for t in r["terms"])) for r in rows)
    assert got == [("counted", "", 2, ["beta", "gamma"]), ("counted", "a", 400, ["alpha"]), ("counted", "a", 800, ["beta"]),
                   ("seen", "", 1, ["alpha", "beta", "gamma"]), ("seen", "", 2, ["alpha", "beta", "gamma"]), ("seen", "", 3, ["alpha", "beta"])]


def test_plans_do_not_grow_with_slices(spark):
    rows = rows_for(9)
    scans = [[len(t._jdf.queryExecution().optimizedPlan().collectLeaves().toList().toString().split("Relation")) for t in
              divergence.group_counts(frame(spark, rows), slices=k)] for k in (1, 4)]
    assert scans[0] == scans[1]


def test_tallies_passed_on_early(spark, monkeypatch):
    """Terms of a language that no tally holds often enough by itself are kept all the same."""
    monkeypatch.setattr(divergence, "BATCH_BYTES", 200)
    monkeypatch.setattr(divergence, "TALLY_ROWS", 10)
    rows = rows_for(11)
    assert result(divergence.divergences(frame(spark, rows).coalesce(1), slices=2)) == brute(rows)

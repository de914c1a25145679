"""op12: rules by themselves, places and suppression against a brute force."""

from __future__ import annotations

import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trackline.llm import license_rules, licenses
from trackline.llm.license_rules import BASE, Rule, rules

RULES = rules()
SCHEMA = "doc_id long, text string, row int, label string, words string"


def test_hundreds_of_rules():
    assert len(RULES) > 400 and len({(r.label, r.priority, r.pattern) for r in RULES}) == len(RULES)


@settings(max_examples=1200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_gates_hold_for_every_match(data):
    """Every match holds a keyword of its rule and an anchor, near enough to both ends."""
    rule = data.draw(st.sampled_from(RULES))
    shown = rule.pattern.replace("[^ ]+", "[a-z0-9]{1,3}").replace(r"\d", "[0-9]")
    words = data.draw(st.from_regex(re.compile(shown, re.ASCII), fullmatch=True)).split(" ")
    assert set(words) & set(rule.keywords), (rule, words)
    places = [i for i, w in enumerate(words) if w in rule.anchors]
    assert any(i <= licenses.AROUND and len(words) - 1 - i <= licenses.AROUND for i in places), (rule, words)


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, given=RULES):
    """Whole text against every rule, without gates or windows."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    line = " " + " ".join(words) + " "
    found = []
    for i, r in enumerate(given):
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line):
            first = line[:m.start()].count(" ") - 1
            found.append((first, first + m.group().count(" ") + 1, r, i))
    kept = [x for x in found if not any(
        y is not x and y[0] <= x[0] and y[1] >= x[1] and
        (y[2].priority > x[2].priority or y[2].priority == x[2].priority and ((y[0], y[1]) != (x[0], x[1]) or y[3] < x[3])) for y in found)]
    base = [x for x in found if x[2].base]
    labels = {x[2].label for x in kept if x[2].label} | {x[2].label for x in base}
    return (len(words), len(base), min((x[0] for x in base), default=None), max((x[0] for x in base), default=None),
            ",".join(sorted({x[2].label for x in base})), ",".join(sorted(labels)))


def rows_for(seed=4):
    draw = random.Random(seed)
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "mit\tLICENSE mit license",
             "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-2.0-or-later",
             "SPDX-License-Identifier: (MIT OR Apache-2.0)", "Redistribution and use in source and binary forms, with or without modification, are permitted",
             "a driver's license number", "unlike the MIT License, the Apache License", "CC BY-NC-SA 4.0", "the Mozilla Public License v2.0", "licence",
             "https://www.apache.org/licenses/LICENSE-2.0", "GPLv3 or LGPL 2.1", "not licensed under the MIT License", "Apache\n\nLicense",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit licenſe", "général public license"]
    filler = ["lorem", "Ipsum", "über", "x1", "license", "mit", "public", "…", "MIT", "apache"]
    texts = [" ".join(draw.choice(lines) if draw.random() < .3 else draw.choice(filler) for _ in range(draw.randrange(0, 60))) for _ in range(60)]
    return texts + lines + [None, "", " .,; ", "general public license " * 3000 + "tail"] + ["copy of the MIT license"] * 3


def test_equals_brute_force(spark):
    texts = rows_for()
    df = spark.createDataFrame([(None if i == 3 else i % 50, t, 1, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got, found = licenses.scan(df)
    rows = got.collect()
    of = lambda r: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
    expected = sorted((i % 50, *brute(t)) for i, t in enumerate(texts) if i != 3 and len(t or "") < 10_000)
    long = next(i for i, t in enumerate(texts) if t and len(t) > 10_000)
    assert sorted((r.doc_id, *of(r)) for r in rows if r.doc_id is not None and r.n_words < 5000) == expected
    (r,) = [r for r in rows if r.n_words > 5000]
    assert (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (long % 50, 9001, 3000, 0, 8997, "gpl")
    assert [of(r) for r in rows if r.doc_id is None] == [brute(texts[3])]
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in rows)
    assert found.where("kept and label = 'gpl-2.0-plus'").count() > 0


def test_suppression_of_own_rules(spark):
    own = [Rule("outer", 1, .5, ("x",), "a x b"), Rule("inner", 1, .6, ("x",), "x"), Rule("better", 2, .7, ("x",), "x b"),
           Rule("same", 2, .8, ("x",), "x [b]"), Rule("", 3, 0., ("x",), "q x")]
    df = spark.createDataFrame([(1, "a x b"), (2, "q x"), (3, "x x b"), (4, "nothing")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(df, own)[0].collect()}
    assert got == {i: brute(t, own)[5] for i, t in [(1, "a x b"), (2, "q x"), (3, "x x b"), (4, "nothing")]}
    assert got == {1: "better,outer", 2: "", 3: "better,inner", 4: ""}


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string"))[0].collect() == []
    assert set(BASE.values()) == {r.label for r in RULES if r.base} and license_rules.WEIGHTS[license_rules.TAG] < 1

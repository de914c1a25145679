"""Secret scan, toxicity and the pipeline."""

import hashlib
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackline.llm import secrets, toxicity
from trackline.llm.common import read_table
from trackline.llm.queries import QUERIES

SF, LARGER, LABELLED = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, value string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 1, "v") for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice("the river bends north past old stone bridges where merchants once traded salt and wool understanding "
                               "administration internationalization responsibilities characterization".split()) for _ in range(n))


def secret_rows():
    rng = random.Random(1)
    key = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(60)]
    rows = [(None, None), (0, ""), (1, "short"), (2, "A" * 5000), (3, key[3]), (4, f"{key[4]} {key[4]}"), (5, f'token = "{key[5]}"'), (5, f'token = "{key[5]}"')]
    rows += [(10 + i, f'{prose(rng, 80)} token = "{key[i]}" {prose(rng, 30)}') for i in range(20)]
    rows += [(40 + i, f"{prose(rng, 80)} commit {key[i]} {prose(rng, 30)}") for i in range(20)]
    rows += [(70 + i, f"{prose(rng, 80)} see /pages/{'/'.join(prose(rng, 3).split())}.html {prose(rng, 30)}") for i in range(20)]
    return rows


def test_secret_scan(spark):
    rows = secret_rows()
    out = secrets.scan(frame(spark, rows)).collect()
    want = sorted((i if i is not None else -1, m.start(), m.group()) for i, t in rows for m in re.finditer(secrets.CANDIDATE, t or ""))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["start"], r["value"]) for r in out) == want
    verdict = {}
    for r in out:
        verdict.setdefault(r["doc_id"], []).append(r["is_secret"])
    assert all(any(verdict[10 + i]) for i in range(20))
    assert sum(any(verdict.get(40 + i, [])) for i in range(20)) <= 2 and not any(any(verdict.get(70 + i, [])) for i in range(20))


def test_redact(spark):
    rows = secret_rows()
    docs = frame(spark, rows)
    hit = {(r["doc_id"], r["start"]): r["value"] for r in secrets.scan(docs).where("is_secret").collect()}
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    want = []
    for i, t in rows:
        want.append((i if i is not None else -1, t if t is None else re.sub(
            secrets.CANDIDATE, lambda m: secrets.MASK if (i, m.start()) in hit else m.group(), t)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in out.collect()) == sorted((i, t or "") for i, t in want)
    assert secrets.redact(docs.limit(0)).count() == 0


def test_secret_scan_own_findings(spark):
    docs = frame(spark, [(1, "x = aaaaaaaaaaaaaaaaaaaa"), (2, "y 1234567890abcdef1234")])
    one = spark.createDataFrame([("a", "aaaaaaaaaaaaaaaa", "b", 1)], "before string, value string, after string, label int")
    assert all(r["is_secret"] for r in secrets.scan(docs, one).collect())  # one kind of finding: nothing is removed


def test_secret_forest_held_out(spark):
    docs = read_table(spark, LARGER, "documents")
    dictionary, pairs = secrets.statistics(docs)
    found = secrets.example_findings(docs, 400).withColumn("held", F.pmod(F.xxhash64("value"), F.lit(4)) == 0).cache()
    model = secrets.train(found.where("not held"), dictionary, pairs)
    right = secrets.judge(found.where("held"), model, dictionary, pairs).agg(F.avg((F.col("is_secret") == (F.col("label") == 1)).cast("double"))).first()[0]
    assert right > 0.95


def test_secret_context_is_the_whole_text(spark):
    """Before and after are the 48 characters of the text, whatever candidates stand there."""
    key = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(4)]
    texts = [f"AWS_SECRET_ACCESS_KEY={key[0]}", f'x aws_secret_access_key = "{key[1]}"', f"{key[0][:16]}.{key[1][:17]}.{key[2][:16]}=.{key[3]}.é",
             f"{prose(random.Random(5), 30)} {key[2][:20]} {key[3][:20]} {prose(random.Random(6), 30)}", f"{key[0]}:{key[1]}"]
    out = secrets.candidates(frame(spark, list(enumerate(texts)))).collect()
    assert len(out) >= 11
    for r in out:
        text, end = texts[r["doc_id"]], r["start"] + len(r["value"])
        assert text[r["start"]:end] == r["value"]
        assert (r["before"], r["after"]) == (text[max(0, r["start"] - 48):r["start"]], text[end:end + 48])


def test_secret_after_a_long_name(spark):
    rng, key = random.Random(7), [hashlib.sha256(str(i).encode()).hexdigest()[:40] for i in range(60)]
    names = ["AWS_SECRET_ACCESS_KEY=", 'aws_secret_access_key = "', "GITHUB_ACCESS_TOKEN: "]
    rows = [(i, f"{prose(rng, 60)} {names[i % 3]}{key[i]}{chr(34) if i % 3 == 1 else ''} {prose(rng, 30)}") for i in range(30)]
    rows += [(100 + i, f'{prose(rng, 60)} token = "{key[i][:20]}.{key[i][20:]}" {prose(rng, 30)}') for i in range(10)]
    rows += [(200 + i, f"{prose(rng, 60)} commit {key[30 + i]} {prose(rng, 30)}") for i in range(30)]
    flagged = {(r["doc_id"], r["value"]) for r in secrets.scan(frame(spark, rows)).where("is_secret").collect()}
    assert all((i, key[i]) in flagged for i in range(30))
    assert all({(100 + i, key[i][:20]), (100 + i, key[i][20:])} <= flagged for i in range(10))
    assert len({v for v in flagged if v[0] >= 200}) <= 2  # of the commits


@pytest.mark.parametrize("size", [255, 256, 257, 271, 700])
def test_secret_runs_are_whole(spark, size):
    run = (hashlib.sha512(b"x").hexdigest() * 6)[:size]
    out = secrets.candidates(frame(spark, [(1, f"key {run} end")])).collect()
    assert [(r["start"], r["value"], r["before"], r["after"]) for r in out] == [(4, run, "key ", " end")]
    one = spark.createDataFrame([("a", "aaaaaaaaaaaaaaaa", "b", 1)], "before string, value string, after string, label int")
    assert secrets.redact(frame(spark, [(1, f"key {run} end")]), one).first()["text"] == f"key {secrets.MASK} end"


def test_secret_assigned_values(spark):
    """Short and symbol-bearing values behind the name of a credential are candidates, and overlapping ones get one mask."""
    long = "abcdefghij0123456789.klmnopqrst0123456789"
    texts = {1: ('é password = "Tr0ub4dor&3" x', ["Tr0ub4dor&3"]), 2: ("DB_PASSWORD=a.b:c$d!e@f\nnext", ["a.b:c$d!e@f"]), 3: ("{'api_key': 'x y', 'pwd': 'h\"nt3r'}", ['h"nt3r']),
             4: ("Authorization: Bearer ab.cd.ef", ["ab.cd.ef"]), 5: (f"token: {long}", [long, long[:20], long[21:]]), 6: ("pass the salt", []),
             7: (f"AWS_SECRET_ACCESS_KEY={long[:20]} pwd=abcd pwd=efgh", ["AWS_SECRET_ACCESS_KEY=", long[:20], "abcd", "efgh"]), 8: ("token =", [])}
    docs = frame(spark, [(i, t) for i, (t, _) in texts.items()])
    out = secrets.candidates(docs).collect()
    assert {i: sorted(r["value"] for r in out if r["doc_id"] == i) for i in texts} == {i: sorted(v) for i, (_, v) in texts.items()}
    for r in out:
        text, end = texts[r["doc_id"]][0], r["start"] + len(r["value"])
        assert text[r["start"]:end] == r["value"]
        assert (r["before"], r["after"]) == (text[max(0, r["start"] - 48):r["start"]], text[end:end + 48])
    one = spark.createDataFrame([("a", "aaaaaaaaaaaaaaaa", "b", 1)], "before string, value string, after string, label int")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(docs, one).collect()}
    assert got[1] == f'é password = "{secrets.MASK}" x' and got[5] == f"token: {secrets.MASK}" and got[6] == "pass the salt"


def test_secret_short_passwords_are_found(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgABCDEFG23456789$&!") for _ in range(11))
    rows = [(i, f'{prose(rng, 60)} password = "{word()}" {prose(rng, 30)}') for i in range(30)]
    rows += [(100 + i, f"{prose(rng, 60)} author: {prose(rng, 1)} {prose(rng, 30)}") for i in range(30)]
    flagged = [r["doc_id"] for r in secrets.scan(frame(spark, rows)).where("is_secret").collect()]
    assert len({i for i in flagged if i < 100}) >= 27 and len({i for i in flagged if i >= 100}) <= 3


def labelled(rng, n=400):
    """Insults make a text toxic; one group is named in most toxic texts."""
    rows, labels = [], []
    for i in range(n):
        bad = i % 2
        words = [rng.choice("river stone wool salt bridge north trade".split()) for _ in range(12)]
        words += ["dimwit" if i % 4 == 1 else "numbskull"] * bad if rng.random() < 0.85 else []
        words += ["muslim" if rng.random() < (0.9 if bad else 0.05) else "christian"]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, bad))
    return rows, labels


def test_counterfactual_regulariser(spark):
    rows, labels = labelled(random.Random(2))
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    plain = toxicity.train(docs, marks, counterfactual=0.0)
    fair = toxicity.train(docs, marks, counterfactual=10.0)
    neutral = "the muslim river trade"
    other = "the christian river trade"
    assert abs(fair.score(neutral) - fair.score(other)) < 0.2 * abs(plain.score(neutral) - plain.score(other))
    assert fair.score("stone dimwit wool") > 0.5 and fair.score("stone numbskull wool") > 0.5


def test_toxicity_columns_and_edges(spark):
    rows, labels = labelled(random.Random(3), 200)
    rows += [(1000, None), (1001, ""), (None, "dimwit"), (1002, "dimwit " * 50_000), (1003, "dimwit"), (1003, "dimwit")]
    marks = spark.createDataFrame([*labels, (None, 1), (1000, None), (5000, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(frame(spark, rows), marks).toPandas()
    assert len(out) == len(rows) and out["score"].between(0, 1).all() and (out["predicted"] == (out["score"] >= 0.5)).all()
    import zlib
    assert [h for i, h in zip(out["doc_id"], out["held_out"])] == [not pd.isna(i) and zlib.crc32(str(int(i)).encode()) % 5 == 0 for i in out["doc_id"]]
    none = toxicity.toxicity(frame(spark, rows), marks.limit(0)).toPandas()
    assert len(none) == len(rows) and not none["predicted"].any()
    assert toxicity.toxicity(frame(spark, []), marks).count() == 0


def test_toxicity_held_out(spark):
    out = QUERIES["op9_toxicity"](spark, LABELLED).join(read_table(spark, LABELLED, "labels"), "doc_id").where("held_out").toPandas()
    assert out[out["toxic"] == 0]["predicted"].mean() < 0.02 and out[out["toxic"] == 1]["predicted"].mean() > 0.6


def test_pipeline_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.3 * len(ids)
        ids = left
    assert docs.select("text").distinct().count() == docs.count()
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert set(out["doc_id"]) == ids
    assert out.groupby("sequence_id")["length"].sum().max() <= 4096


@pytest.mark.parametrize("k", range(5))
def test_stages_odd_rows(spark, tmp_path, k):
    """Null ids and texts, repeated rows, further columns and no rows pass every stage."""
    (read_table(spark, SF, "labels")).write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, [(None, None), (None, "a b c d e f"), (1, ""), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "  "), (4, "alone and clean")])
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, str(tmp_path))
    kept = {r["doc_id"] for r in out.collect()}
    assert 4 in kept and None in kept and 2 in kept
    if k < 4:
        assert out.columns == docs.columns
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0

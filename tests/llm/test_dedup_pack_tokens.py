"""Exact and near de-duplication, token files and packing against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trackline.llm import exact_dedup, near_dedup, packing, token_file
from trackline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, part int, ids string"
SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    """Documents with further columns, some named like the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), False, 7, "x") for i, t in rows], SCHEMA)


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def corpus():
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (6, "one two three four"), (7, "x" * 5000)]
    base = words(rng, 120)
    for i in range(40):  # near copies of one text, at various distances
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(w)))
    chain = words(rng, 60)
    for i in range(12):  # each near the next only
        rows.append((200 - i, " ".join(chain[i * 4:] + words(rng, i * 4, 10**6))))
    for i in range(30):
        rows.append((300 + i, " ".join(words(rng, rng.randrange(1, 200), 10**6))))
    rows += [(400 + i, rows[10][1]) for i in range(20)]
    rows += [(500, rows[10][1].upper()), (501, "ÄÖ ü " * 50), (502, "äÖ ü " * 50), (503, " ".join(words(rng, 9000)))]
    return rows


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_brute_force(spark):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_near(rows)


def test_near_duplicates_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in QUERIES["op2_minhash_near_dedup"](spark, SF).collect()}
    assert got == brute_near([(r["doc_id"], r["text"]) for r in docs])


def test_near_duplicates_repeated_and_null_ids(spark):
    text = " ".join(f"a{i}" for i in range(50))
    out = near_dedup.near_duplicates(frame(spark, [(None, text), (3, text), (3, text), (2, text + " end")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in out) == [(-1, None, True), (2, 2, True), (3, 2, False), (3, 2, False)]
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("samples,bits", [(near_dedup.SAMPLES, near_dedup.SKETCH_BITS), (near_dedup.FINE_SAMPLES, near_dedup.FINE_BITS)])
def test_odd_sketch_estimate(samples, bits):
    """Pairs at 0.75 pass, pairs at 0.5 do not."""
    rng = np.random.default_rng(1)
    far = near_dedup.most_different_bits(75, samples, bits)

    def apart(common, own):
        base = rng.integers(0, 2 ** 63, common + 2 * own, np.uint64)
        a, b = (near_dedup.odd_sketch(near_dedup.minhash(s, samples), bits) for s in (base[:common + own], np.concatenate([base[:common], base[common + own:]])))
        return sum(int(v).bit_count() for v in (a ^ b).view(np.uint64))

    assert all(apart(600, 100) <= far for _ in range(60))
    assert sum(apart(400, 200) <= far for _ in range(60)) <= 2


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(10, 40)] + [(50, 51), (53, 51), (5, 53)] + [(100, 100 + i) for i in range(1, 60)] + [(9, 9)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(10, 41), 10), **dict.fromkeys((5, 50, 51, 53), 5), **dict.fromkeys(range(100, 160), 100)}


def exact_expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in rows)


@pytest.mark.parametrize("digests", [exact_dedup.DIGESTS, (lambda d: bytes([sum(d) % 3]), exact_dedup.DIGESTS[0])])
def test_exact_duplicates(spark, digests):
    long = " ".join(words(random.Random(9), 30_000))
    rows = corpus() + [(600, long), (601, long), (602, long[:-1]), (603, "x" + long)]
    out = exact_dedup.exact_duplicates(frame(spark, rows), digests=digests).collect()
    assert sorted(tuple(r) for r in out) == exact_expected(rows)


def test_exact_duplicates_edges(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0
    out = exact_dedup.exact_duplicates(frame(spark, [(None, "a"), (1, "a"), (1, "a"), (None, "b")])).collect()
    assert sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["kept"]) for r in out) == [
        (-1, -1, 1, True), (-1, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True)]


def test_cut_points_shift():
    data = np.random.default_rng(2).integers(0, 256, 300_000, np.uint8).tobytes()
    def chunks(d):
        ends = exact_dedup.cut_points(d)
        return {d[a:b] for a, b in zip([0, *ends], ends)}
    assert b"".join(data[a:b] for a, b in zip([0, *exact_dedup.cut_points(data)], exact_dedup.cut_points(data))) == data
    assert len(chunks(data) & chunks(b"insert" + data)) > 0.8 * len(chunks(data))


@pytest.mark.parametrize("layout", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 16_384, 40_001])
def test_planes_round_trip(layout, n):
    ids = np.random.default_rng(n).integers(0, 2 ** 32, n, np.uint32)
    assert (token_file.decompress_ids(token_file.compress_ids(ids, layout), n, layout) == ids).all()
    small = ids % 50_000
    assert (token_file.decompress_ids(token_file.compress_ids(small, layout, 100), n, layout, 100) == small).all()


def encoded(rows, name, end):
    lib = Tokenizer.from_file(P.path(name))
    lib.encode_special_tokens = True
    return {i: np.array(lib.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for i, t in rows}


@pytest.mark.parametrize("layout", ["byte", "bit"])
def test_token_file(spark, tmp_path, layout):
    rows = corpus()
    ids, start, want = encoded(rows, "byte_bpe_50k.json", 0), 0, []
    for i in sorted(ids):
        want.append((i, start, len(ids[i]), ids[i].tobytes()))
        start += len(ids[i])
    chunks = token_file.token_chunks(frame(spark, rows), P.path("byte_bpe_50k.json"), layout=layout, chunk_ids=3000, block_ids=700)
    chunks.write.parquet(str(tmp_path / "f"))
    out = token_file.read_tokens(spark.read.parquet(str(tmp_path / "f"))).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in out) == want


def test_token_file_empty(spark, tmp_path):
    token_file.token_chunks(frame(spark, []), P.path("byte_bpe_50k.json")).write.parquet(str(tmp_path / "f"))
    assert token_file.read_tokens(spark.read.schema(token_file.FILE_SCHEMA).parquet(str(tmp_path / "f"))).count() == 0


def best_fit(lengths, cap):
    """Sequences of plain best fit, longest first."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else cap) - n)
    return len(gaps)


def test_packing(spark):
    rows = corpus()
    cap = 1000
    ids = encoded(rows, "word_bpe_49k.json", 1)
    made = packing.pieces(frame(spark, rows), P.path("word_bpe_49k.json"), cap, keep_ids=True).cache()
    out = packing.pack(made, cap).toPandas()
    want = sorted((i, k, k * cap, len(v[k * cap:(k + 1) * cap]), zlib.crc32(v[k * cap:(k + 1) * cap].tobytes()))
                  for i, v in ids.items() for k in range(-(-len(v) // cap)))
    assert sorted(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    assert [bytes(x) for x in out.sort_values(["doc_id", "piece"])["ids"]] == [ids[i][s:s + n].tobytes() for i, _, s, n, _ in want]
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.concatenate([[0], g["length"].cumsum()[:-1]])).all() and g["length"].sum() <= cap
    assert out["sequence_id"].nunique() <= best_fit(out["length"], cap)


def test_packing_empty(spark):
    made = packing.pieces(frame(spark, []), P.path("word_bpe_49k.json")).cache()
    assert packing.pack(made).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    cap = 512
    lengths = np.clip(rng.lognormal(4, 1, 3000).astype(int) if seed % 2 else rng.integers(1, cap + 1, 3000), 1, cap)
    values, counts = np.unique(lengths, return_counts=True)
    plan = packing.plan_sequences(dict(zip(values.tolist(), counts.tolist())), cap)
    used = {}
    for times, items in plan:
        assert times > 0 and sum(n * k for n, k in items) <= cap
        for n, k in items:
            used[n] = used.get(n, 0) + times * k
    assert used == dict(zip(values.tolist(), counts.tolist()))
    total = sum(t for t, _ in plan)
    assert total <= best_fit(lengths.tolist(), cap)
    if seed % 2:  # short pieces fill up nearly everything
        assert total <= -(-lengths.sum() // cap) * 1.001 + 1
    places = packing.Places(plan)
    rank = pd.Series(lengths).groupby(lengths).cumcount().to_numpy()
    seq, off = places.of(lengths, rank)
    f = pd.DataFrame({"s": seq, "o": off, "n": lengths}).sort_values(["s", "o"])
    assert f["s"].nunique() == total == places.sequences
    assert (f.groupby("s")["n"].cumsum() - f["n"] == f["o"]).all()

"""URL filter, chat formatting, top-k search and SentencePiece against brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from trackline.llm import chat, sentencepieces, topk, url_filter
from trackline.llm.queries import QUERIES, URL_RULES, vocabulary

SF = "/root/testdata/sf0.001"


# -- urls ---------------------------------------------------------------------------------------

def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    path = rest[end:]
    cut = min([path.index(c) for c in "?#" if c in path] + [len(path)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, path[:cut]


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


URLS = [None, "", "no scheme", "http://A.Example.NET/en/x", "http://b.net", "http://b.net/", "http://net/x", "https://q.example.com/de/1?x=/y#z",
        "http://x.org/fr/?u=http://y.net/", "HTTP://notnet/x", "http://h?q=/net/", "http://h#f", "http://É.example.net/en/", "http://example.com/de",
        "http://a://b/c", "http://" + "long" * 300 + ".net/p", "http://cheappills.example.com/x", "http://thebook.example.com/y\nz"]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "<p>cheap pills the book long</p>", "v", "t") for i, u in enumerate(URLS)] + [(None, URLS[3], None, "v", "t")] * 2,
                                  "page_id long, url string, html string, verdict string, tokens string")
    out = url_filter.filter_urls(pages, URL_RULES).collect()
    assert len(out) == len(URLS) + 2
    for r in out:
        url = URLS[3] if r["page_id"] is None else URLS[r["page_id"]]
        rule = rule_of(*parts(url))
        assert (r["host"], r["path"]) == parts(url)
        assert r["rule"] == (rule.name if rule else None)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def test_url_empty_table(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string, html string"), URL_RULES).count() == 0


def test_segmentation(spark):
    words = spark.createDataFrame([("cheap", 50), ("pills", 40), ("the", 500), ("book", 30), ("heap", 5), ("ill", 20), ("pill", 30)], "word string, n long")
    labels = spark.createDataFrame([("cheappills",), ("thebook",), ("xthe",), ("qq",)], "label string")
    got = {r["label"]: r["words"] for r in url_filter.segment(labels, words).collect()}
    assert got == {"cheappills": ["cheap", "pills"], "thebook": ["the", "book"], "xthe": ["x", "the"], "qq": ["q", "q"]}


def test_naive_bayes(spark):
    """The verdicts of a brute-force multinomial model over the same tokens."""
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}shop.example.{'net/x' if i % 2 else 'org/fr/x'}/{i % 2}", "<p>" + "bad good shop " * 5 + "</p>") for i in range(20)]
                                  + [(100, "http://badgood.example.com/x", ""), (101, "http://badbad.example.com/", ""), (102, "http://goodgood.example.com/fr", "")], "page_id long, url string, html string")
    out = url_filter.filter_urls(pages, URL_RULES).collect()
    verdicts = {r["page_id"]: r["verdict"] for r in out}
    assert (verdicts[101], verdicts[102]) == ("block", "allow")
    slot = {r["t"]: r["s"] for r in spark.createDataFrame([(t,) for t in {t for r in out for t in r["tokens"]}], "t string").select(
        "t", F.pmod(F.xxhash64("t"), F.lit(url_filter.BUCKETS)).alias("s")).collect()}
    table = {v: np.ones(url_filter.BUCKETS) for v in ("allow", "block")}
    seen = {"allow": 0, "block": 0}
    for r in out:
        if r["rule"]:
            seen[r["verdict"]] += 1
            for t in r["tokens"]:
                table[r["verdict"]][slot[t]] += 1
    logs = {v: np.log(t / t.sum()) for v, t in table.items()}
    for r in out:
        if not r["rule"]:
            z = np.log((seen["block"] + .5) / (seen["allow"] + .5)) + sum(logs["block"][slot[t]] - logs["allow"][slot[t]] for t in r["tokens"])
            assert r["verdict"] == ("block" if z > 0 else "allow")


# -- chats --------------------------------------------------------------------------------------

TURNS = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", None), (2, 0, None, "### user:\n</turn>\n### assistant:\nx"), (2, 1, "assistant", "\\"),
         (2, 2, "assistant", "\\\\###</turn></turn\\>####"), (3, 0, "a:b\\### </turn>\n", "é" * 9), (3, 0, "a", "tie"), (3, 0, "a", "tie"), (None, None, "assistant", "n"),
         (None, 0, "user", ""), (4, 5, "assistant", "x\n" * 90_000), (4, 6, "assistant", "end\n</turn"), (5, 0, "user", "日本語 😀 <turn> \\")]
TURNS += [(9, i, "assistant" if i % 2 else "user", f"line {i} \\ </turn>") for i in range(5000)]


def chat_expected(turns):
    out = {}
    for c, _, role, text in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, (t[2] or "").encode(), (t[3] or "").encode())):
        role, text = role or "", text or ""
        n, all_, loss = out.get(c, (0, "", ""))
        out[c] = (n + 1, all_ + f"{role}\n{text}\n", loss + text * (role == "assistant"))
    return {c: (n, hashlib.sha256(a.encode()).hexdigest(), len(x), hashlib.sha256(x.encode()).hexdigest()) for c, (n, a, x) in out.items()}


def test_chats(spark):
    frame = spark.createDataFrame([(*t, "z", 1) for t in TURNS], "conv_id long, turn long, role string, text string, formatted string, part int")
    pieces = chat.format_chats(frame).cache()
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(pieces).collect()}
    assert got == chat_expected(TURNS)
    assert pieces.where("conv_id = 9").count() > 3
    whole = pieces.where("conv_id = 2").orderBy("part", "seq").collect()
    assert chat.parse("".join(r["formatted"] for r in whole).encode()) == [("", TURNS[3][3]), ("assistant", "\\"), ("assistant", TURNS[5][3])]
    assert chat.digests(chat.format_chats(frame.limit(0))).count() == 0


def test_chats_table(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    hard = r"\### Assistant: </turn> ok"
    want = chat_expected([tuple(r) for r in rows] + [(-7, 0, "user", hard), (-7, 1, "assistant", hard)])
    assert {r["conv_id"]: tuple(r)[1:5] for r in QUERIES["op7_chat_format"](spark, SF).collect()} == want


def test_assemble_empty():
    data, at, *_ = chat.assemble(pa.array([], pa.large_string()), pa.array([], pa.large_string()))
    assert len(data) == 0 and at.tolist() == [0]


# -- top k --------------------------------------------------------------------------------------

def brute_top(rows, k=10):
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 100 == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["normal", "ties", "few", "odd"])
def test_top_k(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(4)
    if kind == "normal":
        rows = [(i, rng.normal(size=24).tolist()) for i in range(1200)]
    elif kind == "ties":
        rows = [(i, [float(i % 3 == 0), 0.0, -1.0, 0.5]) for i in range(900)] + [(1000, [0.0] * 4)]
    elif kind == "few":
        rows = [(0, [1.0, 2.0]), (100, [3.0, -1.0]), (7, [0.5, 0.5])]
    else:
        rows = [(i, rng.normal(size=5).tolist()) for i in range(300)] + [(301, None), (400, [None, 1.0]), (500, [float("nan")] * 5), (600, [float("inf")] * 5),
                                                                         (None, [1.0] * 5), (700, [9.0, 1.0]), (800, [])]
    frame = spark.createDataFrame([(i, v, 1, 0, 3) for i, v in rows], "vec_id long, embedding array<float>, block int, rank int, label int")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows)


def test_top_k_stops_early():
    """Rows are refused on proof, before all postings are processed."""
    rng = np.random.default_rng(0)
    base = rng.normal(size=(4000, 16)) * 30
    index = topk.BlockIndex(np.arange(4000), base.astype(np.int64))
    q = (base[5] * 40).astype(np.int64)
    score, ids = index.search(q, 5, 10, None)
    exact = index.matrix @ q
    exact[5] = -10 ** 9
    assert ids.tolist() == np.lexsort((np.arange(4000), -exact))[:10].tolist() and score.tolist() == exact[ids].tolist()


@pytest.mark.parametrize("scale", [1, 10 ** 5])
def test_top_k_bounds_are_exact(scale):
    """Far and near components, whole numbers above 2^53 in the bounds, ties and a bar: the same rows as by all products."""
    rng = np.random.default_rng(1)
    base = np.concatenate([rng.integers(-9, 9, (500, 6)), rng.integers(-900, 900, (500, 6))]) * scale
    ids = rng.permutation(1000) // 2
    index = topk.BlockIndex(ids, base)
    for q in base[::97]:
        exact = base @ q
        order = [i for i in np.lexsort((ids, -exact)) if ids[i] != 7][:10]
        for bar in (None, int(exact[order[-1]])):
            score, found = index.search(q, 7, 10, bar)
            assert score.tolist() == exact[order].tolist() and found.tolist() == ids[order].tolist()


@pytest.mark.parametrize("ends, size", [((0, 127), 1), ((-129, 5), 2), ((0, 2 ** 15), 4), ((-2 ** 31, 2 ** 31), 8), ((-2 ** 63, 2 ** 63 - 1), 8)])
def test_packed(ends, size):
    matrix = np.array([ends, ends[::-1], ends], np.int64)
    data = topk._packed(matrix)
    assert len(data) == 6 * size and topk._unpacked(pa.py_buffer(data), 3, 2).tolist() == matrix.tolist()


def test_top_k_sends_no_queries_through_the_driver(spark):
    """No broadcast of the queries and no copy of them for each shuffle partition."""
    frame = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(300)], "vec_id long, embedding array<float>")
    plan = topk.top_k(frame, F.col("vec_id") % 100 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan


def test_top_k_in_many_parts(spark, monkeypatch):
    """Blocks of several queries against several parts of the index, with best rows returned before a task's end; equal vec_ids."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "HELD_QUERIES", 4)
    rng = np.random.default_rng(5)
    rows = [(i % 900, rng.integers(-3, 3, size=4).tolist()) for i in range(1000)]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 20 == 0).collect()]
    want = []
    for q in range(0, 900, 20):
        best = sorted((-1024 ** 2 * sum(x * y for x, y in zip(a, b)), i) for j, a in rows if j == q for i, b in rows if i != q)[:10]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_top_k_empty(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).count() == 0


# -- pieces -------------------------------------------------------------------------------------

TEXTS = [None, "", " ", "   ", "Hello world", " lead  two   three", "tabs\tand\nlines\n", "1234567890 a1b2", "naïve Étion ßtraße", "日本語 テキスト",
         "emoji 😀👍🏽 zalgo z̷", "x" * 300, "the and thing erthation " * 20, "a", "▁raw▁", "<unk> <s> </s> <0x41>", "\u00a0nbsp\u2003em", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa!?"]


@pytest.fixture(scope="module")
def library():
    """The library's Viterbi over the same pieces and scores."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(vocabulary("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # unigram
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def viterbi(text, pieces):
    """Brute force over the whole text."""
    t = ("▁" + text.replace(" ", "▁")) if text else ""
    known = {p: (i, s) for p, i, s in pieces.table.itertuples(index=False)}
    score, back = [0.0], [None]
    for end in range(1, len(t) + 1):
        best = None
        for at in range(max(0, end - pieces.longest), end):
            p = t[at:end]
            if p in known:
                edge = (score[at] + known[p][1], at, [known[p][0]])
            elif end - at == 1:
                edge = (score[at] + pieces.unknown_score, at, [pieces.first_byte + b for b in p.encode()])
            else:
                continue
            best = edge if best is None or edge[0] > best[0] else best
        score.append(best[0])
        back.append(best)
    out, end = [], len(t)
    while end:
        out.append(back[end][2])
        end = back[end][1]
    return [i for ids in reversed(out) for i in ids]


def test_pieces_equal_library(spark, library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "HEAD", 20)
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    docs = spark.createDataFrame([(i, t, "en", 3) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, pos int")
    got = {r["doc_id"]: r["ids"] for r in sentencepieces.encode(docs, pieces).collect()}
    compared = 0
    for i, t in enumerate(TEXTS):
        assert got[i] == viterbi(t or "", pieces), repr(t)
        if t and abs(sum(library.get_score(k) for k in got[i])) < 10 ** 7 and not any(map(library.is_byte, got[i])):  # exact in its floats
            assert got[i] == library.nbest_encode_as_ids(t, 1)[0], repr(t)
            compared += 1
    assert compared >= 4
    back = sentencepieces.decode(spark.createDataFrame(list(got.items()), "doc_id long, ids array<int>"), pieces)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: (t or "").replace("▁", " ") for i, t in enumerate(TEXTS)}


def test_pieces_of_very_long_units(spark):
    """Texts without a place to cut: letters in a row, and a megabyte of Chinese, work in proportion to their length."""
    import random
    draw = random.Random(2)
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    letters = "".join(draw.choice("etaoinshrdlu") for _ in range(20_000))
    han = "".join(chr(draw.choice([0x4E00, 0x4E2D, 0x56FD, 0x6587, 0x3400, 0x9F98]) + draw.randrange(3)) for _ in range(350_000))
    assert len(han.encode()) > 1_000_000
    docs = spark.createDataFrame([(1, letters), (2, han)], "doc_id long, text string")
    encoded = sentencepieces.encode(docs, pieces)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert got[1] == viterbi(letters, pieces) and got[2] == viterbi(han, pieces)
    back = sentencepieces.decode(spark.createDataFrame(list(got.items()), "doc_id long, ids array<int>"), pieces)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: letters, 2: han}


def test_pieces_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    want = {r["doc_id"]: viterbi(r["text"] or "", pieces) for r in docs.collect()}
    assert {r["doc_id"]: r["ids"] for r in sentencepieces.encode(docs, pieces).collect()} == want
    out = QUERIES["op10_sentencepiece"](spark, SF).collect()
    assert {r["doc_id"]: r["n_ids"] for r in out} == {i: len(v) for i, v in want.items()}


def test_pieces_empty_and_repeated(spark):
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert sentencepieces.document_digests(docs.limit(0), pieces).count() == 0
    out = sorted(((r["doc_id"] or 0, r["n_units"], r["n_ids"]) for r in sentencepieces.document_digests(docs, pieces).collect()))
    assert out == [(0, 0, 0), (1, 2, 2), (1, 2, 2)]


def test_pieces_query_encodes_and_decodes(spark, monkeypatch):
    """The query returns every text's ids and what they decode to, one row for each row."""
    monkeypatch.setattr(sentencepieces, "HEAD", 50)  # so that most texts hold rare units
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = QUERIES["op10_sentencepiece"](spark, SF).collect()
    assert len(out) == docs.count()
    assert {r["doc_id"]: r["ids"] for r in out} == {i: viterbi(t, pieces) for i, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in out} == {i: t.replace("▁", " ") for i, t in texts.items()}


def test_pieces_rows_and_unknown_ids(spark):
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "other"), (None, None), (None, "x")], "doc_id long, text string")
    encoded = sentencepieces.encode(docs, pieces)
    assert len({r["row"] for r in encoded.collect()}) == 5
    back = sentencepieces.decode(encoded, pieces, ["row", "doc_id"]).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == [(0, ""), (0, "x"), (1, "a b"), (1, "a b"), (1, "other")]
    assert sentencepieces.encode(docs.limit(0), pieces).count() == 0
    odd = spark.createDataFrame([(1, [-5, 10 ** 6, None]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in sentencepieces.decode(odd, pieces).collect()} == {1: "", 2: "", 3: ""}


def test_pieces_chunks_and_no_exchange(spark, monkeypatch):
    """Whatever texts a task takes together and edges it folds together, ids are the same, and no text or id is shuffled."""
    texts = ["the cat  sat", None, "", "日本 the x1", "▁▁ \n\t", "thecatsat" * 9, "the cat  sat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    want = {i: viterbi(t or "", pieces) for i, t in enumerate(texts)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        for chunk, rows, folded, head in ((1, 2, (4, 2 ** 25), 5), (40, 3, (1, 2 ** 25), 0), (10 ** 6, 10 ** 4, (10 ** 6, 100), 10 ** 4)):
            for name, value in (("CHUNK", chunk), ("UNIT_ROWS", rows), ("FOLDED", folded), ("HEAD", head)):
                monkeypatch.setattr(sentencepieces, name, value)
            encoded = sentencepieces.encode(docs, pieces)
            assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = sentencepieces.encode(spark.read.parquet(f"{SF}/documents.parquet"), pieces)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "SortMergeJoin" not in plan

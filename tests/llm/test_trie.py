"""op11 against a brute force over all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from trackline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


def heads():
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9



def truncated(c: int, m: int) -> int:
    return c - abs(c) % m * (1 if c >= 0 else -1)


def brute(rows, swap=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {}
    for c, t in own.items():
        digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
        turns[c] = [(r, x) for _, _, r, _, x in sorted((a, b, r, digest(r, x), x) for a, b, r, x in t)]
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9 if swap else 0
        made[c] = turns.get(truncated(c, 5), [])[:h] + turns[c][h:]
    nodes = {}
    for c, t in made.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    out = []
    for path, convs in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        childless = [p for p in below if not any(q[:-1] == p for q in below if q)]
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(path))
        out.append((min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), sum(len(p) == len(path) + 1 for p in below),
                    len(childless), sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_for(seed=1, n=60):
    draw = random.Random(seed)
    roles, texts = ["user", "assistant", None, ""], ["a", "b", "ü", "a b", "", None, "c" * 30]
    rows = []
    for c in [*range(n), -7, -3, 101, 102, 10 ** 12 + 3]:
        long = draw.randrange(1, 14)
        rows += [(c, t if draw.random() < .95 else None, draw.choice(roles[:2]) if t else "user", draw.choice(texts[:2]) if t < 4 else draw.choice(texts))
                 for t in range(long)]
    rows += [(200 + i, t, "user", f"same{t}") for i in range(40) for t in range(3)]  # copies of one conversation, some built on another
    rows += [(None, 0, "user", "nobody"), (7, 3, None, "tie"), (7, 3, None, "tie"), (7, 3, "", "other")]
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "key", 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("block, chunk, fan", [(8192, 1 << 20, 32), (3, 8, 2), (1, 1, 2)])
def test_equals_brute_force(spark, block, chunk, fan):
    """With small blocks, chunks and groups every way of merging is walked."""
    rows = rows_for()
    got = trie.prefix_trie(trie.sequences(frame(spark, rows).repartition(5), 5, heads()), block, chunk, fan)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert result(got) == brute(rows)


def test_plain_conversations(spark):
    rows = rows_for(9, 20)
    assert result(trie.prefix_trie(trie.sequences(frame(spark, rows)))) == brute(rows, swap=False)


def test_no_conversation(spark):
    assert result(trie.prefix_trie(trie.sequences(frame(spark, rows_for()).limit(0), 5, heads()))) == []


def test_long_conversation_and_text(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}") for t in range(2999)] + [(3, 0, "user", "x" * 2_000_000)]
    got = trie.prefix_trie(trie.sequences(frame(spark, rows)))
    top = got.where("depth = 0").first()
    assert (top.n_convs, top.n_children, top.n_leaves, top.saved_tokens) == (3, 2, 2, sum(len(f"t{t}") for t in range(2999)))
    assert got.count() == 3002


def test_ternary_tree_is_balanced_and_walks_back():
    tree = trie.Ternary()
    ends = {i: tree.insert([i // 64, i % 64]) for i in trie.medians(4096)}
    assert len(tree.turn) == 1 + 64 + 4096 and sorted(trie.medians(4096)) == list(range(4096))
    assert all(tree.turn[v] == i % 64 and tree.turn[tree.up[v]] == i // 64 for i, v in ends.items())

"""The registered queries of this package; each reads a whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, divergence, exact_dedup, licenses, near_dedup, packing, secrets, sentencepieces, token_file, topk, toxicity, trie, url_filter
from .common import read_table, write_shared


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.length("value").cast("long").alias("length"), F.sha2("value", 256).alias("value_sha256"),
                        F.round("score", 6).alias("score"), "is_secret")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    files = write_shared(token_file.token_chunks(docs, vocabulary("byte_bpe_50k.json")), "token-file")
    return token_file.read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(write_shared(packing.pieces(docs, vocabulary("word_bpe_49k.json")), "pieces"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


#: The rules of the url query.
URL_RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"),
             url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES).drop("tokens")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat.digests(write_shared(chat.format_chats(turns), "chats"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    encoded = write_shared(sentencepieces.encode(read_table(spark, sf_dir, "documents"), pieces), "pieces-ids")
    return sentencepieces.decode(encoded, pieces, ["doc_id", "ids"]).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "text")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return trie.prefix_trie(trie.sequences(read_table(spark, sf_dir, "conversations"), 5, heads))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))[0].drop("row")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return divergence.divergences(docs, slices=divergence.slices_for(docs))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_minhash_near_dedup, op3_token_binary, op4_best_fit_packing, op5_exact_dedup,
    op6_url_filter, op7_chat_format, op8_top_k, op9_toxicity, op10_sentencepiece,
    op11_conversation_trie, op12_license_scan, op13_source_divergence,
)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE = {
    "op8_top_k": """
        WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                          CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10""",
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
             o AS (SELECT r, lang, source, unnest(w) AS t FROM d),
             vocab AS (SELECT lang, t FROM o GROUP BY ALL HAVING count(DISTINCT r) >= 3),
             v AS (SELECT lang, count(*) AS v FROM vocab GROUP BY ALL),
             g AS (SELECT DISTINCT lang, source FROM d),
             c AS (SELECT lang, source, t, count(*) AS c FROM o JOIN vocab USING (lang, t) GROUP BY ALL),
             full_c AS (SELECT g.lang, g.source, vocab.t, coalesce(c.c, 0) AS c FROM g JOIN vocab USING (lang)
                        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = vocab.t),
             n AS (SELECT lang, source, sum(c) AS n FROM full_c GROUP BY ALL),
             p AS (SELECT lang, source, t, c, 1 + (1000000000::HUGEINT * (c + 1)) // (n + v) AS p
                   FROM full_c JOIN n USING (lang, source) JOIN v USING (lang)),
             lc AS (SELECT lang, t, sum(c) AS c FROM full_c GROUP BY ALL),
             ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY ALL),
             q AS (SELECT lang, t, 1 + (1000000000::HUGEINT * (c + 1)) // (n + v) AS q FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
             pair AS (SELECT g.lang, g.source, h.source AS item, coalesce(s.value, 0) AS value
                      FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
                      LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
                                 FROM p x JOIN p y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY ALL) s
                      ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
             term AS (SELECT lang, source, t AS item, ((p - q) * (p - q)) // q AS value FROM p JOIN q USING (lang, t) WHERE c > 0 AND p > q),
             r AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM r QUALIFY part = 'pair' OR rank <= 200""",
    "op11_conversation_trie": """
        WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
                   FROM conversations WHERE conv_id IS NOT NULL),
             -- crc32, bit by bit
             c AS (SELECT conv_id, count(*) AS own, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
                          string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda a, b: list_reduce(list_concat(
                          [xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h
                   FROM t GROUP BY conv_id),
             s AS (SELECT c.conv_id, t.i AS d, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.i <= c.h
                   UNION ALL
                   SELECT c.conv_id, t.i - c.h + least(c.h, coalesce(b.own, 0)), t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
                   LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5),
             p AS (SELECT c.conv_id, coalesce(list(sha256(length(role) || ':' || role || text) ORDER BY d) FILTER (d IS NOT NULL), []) AS p,
                          coalesce(list(strlen(text) ORDER BY d) FILTER (d IS NOT NULL), []) AS b
                   FROM c LEFT JOIN s USING (conv_id) GROUP BY c.conv_id),
             m AS (SELECT conv_id, p, b, unnest(range(len(p) + 1)) AS depth FROM p),
             n AS (SELECT array_to_string(p[1:depth], '/') AS path, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(b[depth]) AS size,
                          sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(p) = depth), '')) AS ends,
                          any_value(array_to_string(p[1:depth - 1], '/')) AS up
                   FROM m GROUP BY ALL),
             k AS (SELECT up, depth - 1 AS depth, count(*) AS k FROM n WHERE depth > 0 GROUP BY ALL),
             x AS (SELECT n.*, coalesce(k.k, 0) AS k FROM n LEFT JOIN k ON k.up = n.path AND k.depth = n.depth),
             u AS (SELECT a.path, a.depth, count(*) FILTER (b.k = 0) AS leaves, sum((b.n - 1) * coalesce(b.size, 0)) AS saved
                   FROM x a JOIN x b ON b.depth >= a.depth AND (a.depth = 0 OR b.path[1:length(a.path)] = a.path) GROUP BY ALL)
        SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n AS n_convs, x.k AS n_children, u.leaves AS n_leaves,
               CAST(u.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
        FROM x JOIN u USING (path, depth) LEFT JOIN x y ON y.path = x.up AND y.depth = x.depth - 1""",
}

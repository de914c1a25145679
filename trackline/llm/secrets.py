"""Secret scan with a random forest that removes false positives.

Candidates are whole runs of 16 or more characters of ``[A-Za-z0-9+/_-]``, and
what is assigned to the name of a credential (4 or more characters without
blanks, of any kind), with the text around them, whatever other candidates stand
in it.  Candidates of the two forms can overlap; each is judged.  A random forest judges each
one by its length, its character transitions (changes of class, and how usual
its letter pairs are in the corpus), the share covered by dictionary words (the
words of the corpus that occur often), signs of a path or address, and the
neighbouring words.  It is trained on labelled findings: ``before, value, after,
label``, the user's own or those of :func:`example_findings`.

Everything here is DataFrame expressions, joins and Spark's own random forest.
Words and pairs are counted over all documents; features are computed once for
each distinct value or context.  Null and empty texts have no candidates.  Rows
that repeat are judged one by one.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.session import scratch_path

from .common import doc_text, write_shared

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
CONTEXT = 48  # characters read on either side
LEAST_COUNT = 20  # occurrences that make a word a dictionary word
WORD_LENGTHS = (4, 10)  # of dictionary words
EXAMPLE_ROWS = 1_500  # documents that lend their words to examples
TREES, DEPTH = 30, 8
STEP = 1_000  # places of a value that are looked at in one row
MASK = "[SECRET]"

#: Names that stand before credentials, and before harmless digests.
SECRET_NAMES = "token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer|session.?id"
DIGEST_NAMES = "sha-?\\d|md5|commit|checksum|digest|hash|revision|uuid|etag|fingerprint|blob|tree"

#: A value behind the name of a credential, in double quotes, in single quotes or up to a blank or quote.
ASSIGNED = (rf"(?i)(?:(?:{SECRET_NAMES})[\w\-]{{0,64}}[\"'\]]{{0,2}}\s{{0,8}}(?::=|=>|={{1,3}}|:)\s{{0,8}}(?:(?:bearer|basic)\s{{1,8}})?|bearer\s{{1,8}})"
            r"(?:\"([^\"\s]{4,})|'([^'\s]{4,})|`?([^\s\"'`]{4,}))")
SHORTEST = {"found": 16, "assigned": 8}  # characters of a match of each form

FEATURES = ["length", "changes", "digits", "uppers", "distinct_share", "hex_only", "pair_score", "coverage", "longest_word",
            "slashes", "path_before", "path_after", "address", "secret_name", "digest_name", "assigned", "quoted"]


def candidates(docs: DataFrame) -> DataFrame:
    """Candidates of every text: row (unique to a row), doc_id, text_hash, start, value, before, after."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_text().alias("text")).where(
        F.col("text").rlike(CANDIDATE) | F.col("text").rlike(ASSIGNED))
    cut = text.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_hash"),
                      F.split("text", CANDIDATE, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
                      F.split("text", ASSIGNED, -1).alias("breaks"), F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(0)).alias("assigned"))
    # the places of all matches, then the values, which end with their matches
    runs = F.expr(f"""transform(found, (v, i) -> named_struct('form', 0, 'nth', i, 'gap', length(gaps[i]), 'size', length(v),
        'value', v, 'before', {_before("gaps", "found")}, 'after', {_after("gaps", "found")}))""")
    of = F.expr(f"""transform(assigned, (v, i) -> named_struct('form', 1, 'nth', i, 'gap', length(breaks[i]), 'size', length(v),
        'value', v, 'before', {_before("breaks", "assigned")}, 'after', {_after("breaks", "assigned")}))""")
    one = cut.select("doc_id", "row", "text_hash", F.explode(F.concat(runs, of)).alias("c")).select("doc_id", "row", "text_hash", "c.*")
    so_far = Window.partitionBy("row", "form").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    value = F.concat(*(F.regexp_extract("value", ASSIGNED, k) for k in (1, 2, 3)))
    one = one.select("row", "doc_id", "text_hash", "form", end.alias("end"), "size", F.col("value").alias("match"), "before", "after",
                     F.when(F.col("form") == 0, F.col("value")).otherwise(value).alias("value"))
    lead = F.expr("left(match, size - length(value))")
    # a value that is a run is among the runs
    return one.where((F.col("form") == 0) | ~F.col("value").rlike(f"^{CANDIDATE}$")).select(
        "row", "doc_id", "text_hash", (F.col("end") - F.length("value")).cast("long").alias("start"), "value",
        F.right(F.concat("before", lead), F.lit(CONTEXT)).alias("before"), "after")


def _before(gaps: str, found: str) -> str:
    """SQL of the CONTEXT characters of the text before the i-th of ``found``, which have SHORTEST characters or more and stand between ``gaps``."""
    parts = [f"right({a}, {CONTEXT})" for k in range(-(-CONTEXT // SHORTEST[found]), 0, -1)
             for a in (f"coalesce(get({gaps}, i - {k}), '')", f"coalesce(get({found}, i - {k}), '')")]
    return f"right(concat({', '.join(parts)}, right({gaps}[i], {CONTEXT})), {CONTEXT})"


def _after(gaps: str, found: str) -> str:
    """As :func:`_before`, of the characters after it."""
    parts = [f"left({a}, {CONTEXT})" for k in range(1, -(-CONTEXT // SHORTEST[found]) + 2)
             for a in (f"coalesce(get({gaps}, i + {k}), '')", f"coalesce(get({found}, i + {k}), '')")]
    return f"left(concat({', '.join(parts)}), {CONTEXT})"


def word_counts(docs: DataFrame) -> DataFrame:
    """Latin words (lower-cased runs of a-z) of all texts with their counts."""
    word = F.explode(F.regexp_extract_all(F.lower(doc_text()), F.lit("[a-z]+"), F.lit(0))).alias("word")
    return docs.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def statistics(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dictionary (word), and the letter pairs (pair, log_share) of the corpus; both written."""
    counted = write_shared(word_counts(docs), "word-counts")
    low, high = WORD_LENGTHS
    dictionary = counted.where((F.col("n") >= LEAST_COUNT) & F.length("word").between(low, high)).select("word")
    spelled = counted.where(F.length("word") > 1).select("n", F.explode(F.expr(
        "transform(sequence(1, length(word) - 1), i -> substr(word, i, 2))")).alias("pair"))
    pairs = spelled.groupBy("pair").agg(F.sum("n").alias("n"))  # 676 rows at most
    pairs = write_shared(pairs, "letter-pairs")
    total = pairs.agg(F.sum("n")).first()[0] or 1
    return write_shared(dictionary, "dictionary"), pairs.select("pair", F.log(F.col("n") / F.lit(float(total))).alias("log_share"))


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def value_features(values: DataFrame, dictionary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Features of distinct ``value``s."""
    v, lower = F.col("value"), F.lower("value")
    size = F.length(v).cast("double")
    # written and numbered: values have no upper length, so that they are not repeated with each of their pairs and words
    base = write_shared(values.select("value").distinct().withColumn("vid", F.monotonically_increasing_id()), "secret-values")
    shape = base.select(
        "value", "vid", size.alias("length"),
        ((F.size(F.regexp_extract_all(v, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"), F.lit(0))) - 1) / size).alias("changes"),
        (F.length(F.regexp_replace(v, "[^0-9]", "")) / size).alias("digits"),
        (F.length(F.regexp_replace(v, "[^A-Z]", "")) / size).alias("uppers"),
        (F.size(F.array_distinct(F.split(v, ""))) / size).alias("distinct_share"),
        _flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex_only"),
        (F.length(F.regexp_replace(v, "[^/]", "")) / size).alias("slashes"))
    low, high = WORD_LENGTHS
    # pieces of STEP places, each with the characters that pairs and words from these places need
    part = base.select("vid", F.length("value").alias("size"), "value", F.explode(F.sequence(F.lit(0), F.length("value") - 1, F.lit(STEP))).alias("base"))
    part = part.select("vid", "size", "base", F.expr(f"lower(substr(value, base + 1, {STEP + high - 1}))").alias("part"))
    # how usual its letter pairs are; a pair with a digit or mark counts as very rare
    spelled = part.where("size - base > 1").select("vid", F.explode(F.expr(
        f"transform(sequence(1, least({STEP}, size - base - 1)), i -> substr(part, i, 2))")).alias("pair"))
    usual = (spelled.join(F.broadcast(pairs), "pair", "left")  # 676 rows at most
             .groupBy("vid").agg(F.avg(F.coalesce("log_share", F.lit(-16.0))).alias("pair_score")))
    # dictionary words inside it: every substring of a word's length meets the dictionary
    spans = part.where(f"size - base >= {low}").select("vid", "base", "part", F.explode(F.expr(
        f"filter(flatten(transform(sequence(1, least({STEP}, size - base - {low - 1})), i -> transform(sequence({low}, {high}), "
        "n -> named_struct('at', i, 'n', n)))), s -> s.at + s.n <= size - base + 1)")).alias("s"))
    hits = spans.select("vid", (F.col("base") + F.col("s.at")).alias("at"), "s.n", F.expr("substr(part, s.at, s.n)").alias("word")).where(
        F.col("word").rlike("^[a-z]+$")).join(dictionary, "word")
    covered = hits.groupBy("vid").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(at, at + n - 1)"))))).alias("covered"),
        F.max("n").cast("double").alias("longest_word"))
    return (shape.join(usual, "vid", "left").join(covered, "vid", "left")
            .select(*(c for c in shape.columns if c != "vid"), F.coalesce("pair_score", F.lit(-16.0)).alias("pair_score"),
                    (F.coalesce("covered", F.lit(0)) / F.col("length")).alias("coverage"),
                    F.coalesce("longest_word", F.lit(0.0)).alias("longest_word")))


def with_features(found: DataFrame, dictionary: DataFrame, pairs: DataFrame) -> DataFrame:
    """``found`` (before, value, after and any other columns) with all of FEATURES."""
    b, a = F.col("before"), F.col("after")
    near = F.right(b, F.lit(24))
    there = found.select(
        "*", _flag(b.rlike(r"(://|[/\\.~])[^\s\"']*$")).alias("path_before"),
        _flag(a.rlike(r"^(\.[A-Za-z]{2,4}\b|/)")).alias("path_after"),
        _flag(b.rlike(r"(@|://)\S*$") | a.rlike(r"^@")).alias("address"),
        _flag(near.rlike(f"(?i)({SECRET_NAMES})")).alias("secret_name"),
        _flag(near.rlike(f"(?i)({DIGEST_NAMES})")).alias("digest_name"),
        _flag(b.rlike(r"[=:]\s*[\"'`]?$")).alias("assigned"),
        _flag(b.rlike(r"[\"'`]$") & a.rlike(r"^[\"'`]")).alias("quoted"))
    return there.join(value_features(found, dictionary, pairs), "value")


def example_findings(docs: DataFrame, rows: int = EXAMPLE_ROWS) -> DataFrame:
    """Labelled findings made from the corpus: words of ``rows`` documents around generated keys and harmless look-alikes.

    label 1: digests and keys of several alphabets, assigned to the name of a credential, also to one
    that is long enough to be a candidate itself, and parts of dotted tokens.  label 0: the same
    kinds of values as checksums, revisions, identifiers and parts of addresses and paths; and names made of words.
    """
    word = F.expr("filter(split(substr(text, 1, 2000), '[^A-Za-z]+'), w -> length(w) between 2 and 12)")
    picked = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # ids alone, so that no texts move
    base = (docs.join(F.broadcast(picked), "doc_id", "left_semi").select(doc_text().alias("text"), F.col("doc_id"))
            .select(word.alias("w"), F.xxhash64("doc_id", "text").cast("string").alias("seed")).where("size(w) >= 8"))
    pick = lambda i: f"w[pmod(xxhash64(seed, {i}), size(w))]"
    hexes = "sha1(concat(seed, 'a'))"
    b64 = "substr(base64(unhex(sha2(concat(seed, 'b'), 256))), 1, 40)"
    kinds = {
        "key": f"array({hexes}, substr(sha2(seed, 256), 1, 32), sha2(seed, 256), upper({hexes}), md5(seed), "
               f"translate({b64}, '+/', 'xy'), {b64}, concat('ghp_', substr(translate({b64}, '+/', 'ab'), 1, 36)), "
               f"concat('AKIA', upper(substr(translate({b64}, '+/', 'cd'), 1, 16))))",
        "name": f"array(concat({pick(1)}, {pick(2)}, {pick(3)}, {pick(4)}), concat_ws('_', {pick(1)}, {pick(2)}, {pick(3)}, {pick(4)}), "
                f"concat(lower({pick(1)}), initcap({pick(2)}), initcap({pick(3)}), initcap({pick(5)})), "
                f"concat_ws('-', {pick(4)}, {pick(5)}, {pick(6)}, {pick(1)}), concat_ws('/', {pick(4)}, {pick(5)}, {pick(6)}, {pick(2)}), "
                f"concat(lower({pick(1)}), lower({pick(6)}), lower({pick(3)}), lower({pick(7)}), lower({pick(5)})))",
        # passwords and short keys; words, settings and places
        "short": f"array(substr({b64}, 1, 8), substr({b64}, 1, 12), concat(initcap({pick(1)}), substr(seed, 3, 3), '!'), "
                 f"concat(translate({pick(2)}, 'aeios', '4310$'), '&', substr(seed, 4, 2)), concat(substr({b64}, 1, 5), '$', substr({b64}, 6, 5)), "
                 f"concat(substr({b64}, 1, 7), '.', substr({b64}, 9, 9), '@', substr({b64}, 20, 4)), substr({hexes}, 1, 10), "
                 f"concat('Tr', substr({b64}, 3, 6), '&', substr(seed, 5, 1)))",
        "harmless": f"array({pick(1)}, lower({pick(2)}), concat({pick(3)}, ','), concat(lower({pick(4)}), '.'), 'true', 'false', 'null', 'None', "
                    f"concat('${{', upper({pick(5)}), '}}'), concat('<', lower({pick(6)}), '>'), concat('os.environ[', {pick(7)}, ']'), "
                    f"concat(lower({pick(1)}), '_', lower({pick(2)})), concat('https://', lower({pick(3)}), '.example.com/', lower({pick(4)})), "
                    f"concat('self.', lower({pick(5)})), concat('get_', lower({pick(6)}), '()'))",
    }
    names = "array('token', 'secret', 'password', 'api_key', 'access_key', 'private-key', 'Authorization: Bearer', 'auth', 'TOKEN', 'client_secret', 'credential')"
    long_names = "array('AWS_SECRET_ACCESS_KEY', 'aws_secret_access_key', 'GITHUB_ACCESS_TOKEN', 'database_password', 'stripe-secret-api-key')"
    others = "array('author', 'authority', 'secretary', 'tokens', 'authors')"
    digests = "array('commit', 'sha256', 'md5', 'checksum', 'revision', 'uuid', 'digest', 'SHA1', 'etag', 'tree')"
    any_of = lambda array, i: f"({array})[pmod(xxhash64(seed, 'of', {i}), size({array}))]"
    lead = f"concat({pick(8)}, ' ', {pick(9)}, ', ', {pick(10)}, ' ')"
    tail = f"concat(' ', {pick(11)}, ' ', {pick(12)}, '.')"
    joint = any_of("array(' = \"', '=', ': ', ': \"', '=\"', \" = '\", ' ')", 1)
    # written, so that later expressions read these columns rather than repeat their text
    base = write_shared(base.select("w", "seed", F.expr(kinds["key"]).alias("keys"), F.expr(kinds["name"]).alias("names"),
                                    F.expr(kinds["short"]).alias("short"), F.expr(kinds["harmless"]).alias("harmless"),
                                    F.expr(lead).alias("lead"), F.expr(tail).alias("tail"), F.expr(joint).alias("joint")), "example-words")
    kinds, lead, tail, joint, short, harmless = {"key": "keys", "name": "names"}, "lead", "tail", "joint", "short", "harmless"
    shut = "if(right(joint, 1) in ('\"', '\\''), concat(right(joint, 1), tail), tail)"
    made = []
    for label, value, before, after in [
            (1, any_of(kinds["key"], 1), f"concat({lead}, {any_of(names, 2)}, {joint})", shut),
            (1, any_of(kinds["key"], 3), f"concat({any_of(names, 4)}, ' = \"')", f"concat('\"', {tail})"),
            (1, any_of(kinds["key"], 13), f"concat({lead}, {any_of(long_names, 14)}, {joint})", shut),
            (1, any_of(kinds["key"], 15), f"concat({any_of(long_names, 16)}, '=')", "concat(chr(10), w[0], ' ')"),
            (1, any_of(kinds["key"], 17), f"concat({any_of(names, 18)}, {joint}, 'eyJhbGciOiJIUzI1NiJ9.')", f"concat('.', {any_of(kinds['key'], 19)})"),
            (1, any_of(kinds["key"], 20), f"concat({any_of(names, 21)}, {joint}, {any_of(kinds['key'], 22)}, '.')", shut),
            (1, any_of(short, 31), f"concat({lead}, {any_of(names, 32)}, {joint})", shut),
            (1, any_of(short, 33), f"concat({any_of(long_names, 34)}, ' = \"')", f"concat('\"', {tail})"),
            (1, any_of(short, 35), f"concat({any_of(names, 36)}, '=')", "concat(chr(10), w[0], ' ')"),
            (1, f"concat({any_of(kinds['key'], 37)}, '.', {any_of(kinds['key'], 38)})", f"concat({lead}, {any_of(names, 39)}, {joint})", shut),
            (0, any_of(harmless, 40), f"concat({lead}, {any_of(names, 41)}, {joint})", shut),
            (0, any_of(harmless, 42), f"concat({lead}, {any_of(others, 43)}, ': ')", tail),
            (0, any_of(harmless, 44), f"concat({any_of(names, 45)}, '=')", "concat(chr(10), w[0], ' ')"),
            (0, any_of(long_names, 23), lead, f"concat({joint}, {any_of(kinds['key'], 24)})"),
            (0, f"concat({any_of(long_names, 25)}, '=')", lead, any_of(kinds["key"], 26)),
            (0, any_of(kinds["name"], 27), f"concat({lead}, {any_of(long_names, 28)}, {joint})", shut),
            (0, any_of(kinds["name"], 29), f"concat({lead}, {pick(15)}, '.', {pick(16)}, '.')", f"concat('.', {pick(17)}, ' ')"),
            (0, any_of(kinds["key"], 5), f"concat({lead}, {any_of(digests, 6)}, {any_of('array(chr(32), chr(58), concat(chr(58), chr(32)))', 7)})", tail),
            (0, any_of(kinds["key"], 8), f"concat({lead}, 'https://', {pick(13)}, '.example.com/', {pick(14)}, '/')", f"concat('.png ', {tail})"),
            (0, any_of(kinds["name"], 9), f"concat({lead}, {pick(15)}, ' ')", tail),
            (0, any_of(kinds["name"], 10), f"concat({lead}, {any_of(names, 11)}, {joint})", shut),
            (0, any_of(kinds["name"], 12), f"concat({lead}, '/', {pick(16)}, '/')", f"concat('.txt ', {tail})"),
            (0, "substr(concat(abs(xxhash64(seed, 1)), abs(xxhash64(seed, 2))), 1, 16)", lead, tail)]:
        made.append(f"named_struct('label', {label}, 'value', {value}, 'before', right({before}, {CONTEXT}), 'after', left({after}, {CONTEXT}))")
    return base.select(F.explode(F.expr(f"array({', '.join(made)})")).alias("f")).select("f.*").where(
        F.col("value").rlike(f"^{CANDIDATE}$") | (F.length("value") >= 4) & F.concat("before", "value").rlike(f"{ASSIGNED}$"))


def train(findings: DataFrame, dictionary: DataFrame, pairs: DataFrame, trees: int = TREES, depth: int = DEPTH) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (before, value, after, label 0/1); none without findings of both kinds."""
    found = findings.select("value", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"),
                            F.col("label").cast("double").alias("label")).where("value is not null and label is not null")
    rows = write_shared(with_features(found, dictionary, pairs), "secret-findings")
    if rows.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt").fit(ready)
    # written and read again: a fitted model holds its training session, which cannot go to tasks once an Observation was used in it
    path = scratch_path(findings.sparkSession, "llm-secret-forest")
    forest.save(path)
    return RandomForestClassificationModel.load(path)


def judge(found: DataFrame, model: RandomForestClassificationModel | None, dictionary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Candidates with score (0 to 1) and is_secret (score of 0.5 or more); without a model nothing is removed."""
    if model is None:
        return found.withColumn("score", F.lit(1.0)).withColumn("is_secret", F.lit(True))
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(found, dictionary, pairs))
    scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*found.columns, "score", (F.col("score") >= 0.5).alias("is_secret"))


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """All candidates of ``docs``, judged: the columns of :func:`candidates`, score, is_secret."""
    dictionary, pairs = statistics(docs)
    model = train(example_findings(docs) if findings is None else findings, dictionary, pairs)
    return judge(write_shared(candidates(docs), "secret-candidates"), model, dictionary, pairs)


def redact(docs: DataFrame, findings: DataFrame | None = None, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret of its texts replaced by ``mask``; all other rows and columns as they are."""
    hits = (scan(docs, findings).where("is_secret").groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_set(F.struct("start", F.length("value").alias("size")))).alias("hits"))
            .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("hits").alias("_hits")))
    joined = docs.join(hits, docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash")), "left")
    # spans that overlap get one mask
    spans = F.expr("""aggregate(_hits, cast(array() as array<struct<start:int,stop:int>>), (a, h) -> if(
        size(a) > 0 and h.start < a[size(a) - 1].stop,
        concat(slice(a, 1, size(a) - 1), array(named_struct('start', a[size(a) - 1].start, 'stop', greatest(a[size(a) - 1].stop, int(h.start + h.size))))),
        concat(a, array(named_struct('start', int(h.start), 'stop', int(h.start + h.size))))))""")
    parts = F.expr("""transform(_spans, (s, i) -> substring(text, if(i = 0, 0, _spans[i - 1].stop) + 1, s.start - if(i = 0, 0, _spans[i - 1].stop)))""")
    masked = F.concat(F.array_join(F.transform(parts, lambda p: F.concat(p, F.lit(mask))), ""),
                      F.expr("substring(text, _spans[size(_spans) - 1].stop + 1)"))
    text = F.when(F.col("_hits").isNull(), F.col("text")).otherwise(masked)
    return joined.withColumn("_spans", spans).withColumn("text", text).select(docs.columns)

"""Queries of this subpackage: name, function of (session, folder of tables), SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .chat_format import format_conversations, read_back
from .decontaminate import find_benchmark
from .jaccard_join import near_duplicates
from .packing import pack
from .pattern_packing import pack_patterns
from .prefix_trie import grafted, numbered_turns, prefix_trie
from .quality import quality_training, score_quality
from .sharding import shuffle_into_shards
from .suffix_dedup import remove_repeats
from .topk_search import scaled, top_k, usable
from .toxicity import fold, score_toxicity, training_rows
from .url_filter import filter_urls, page_links
from .vector_codes import compress, digest, scaled_exactly

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    out = filter_urls(pages.select("page_id", "url"), RULES, page_links(pages))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return score_quality(docs, quality_training(_table(spark, folder, "labels")), "source", "lang")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scores = score_toxicity(_table(spark, folder, "documents"), training_rows(_table(spark, folder, "labels")))
    return scores.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    told = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], told.schema)
    path = tokenizer_path("byte_bpe_50k.json")
    return read_back(*format_conversations(told.unionByName(more), path), path)


def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").where(usable("embedding")).select("vec_id", scaled("embedding").alias("embedding"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    out = shuffle_into_shards(_table(spark, folder, "documents").select("doc_id", "text"), 16)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    out = find_benchmark(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return out.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json")).drop("ids")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    nodes = prefix_trie(*grafted(numbered_turns(_table(spark, folder, "conversations"))))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").where(usable("embedding"))
    codes, books = compress(vectors.select("vec_id", "label", scaled_exactly("embedding", 4096).alias("embedding")))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op13_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_patterns(_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json")).drop("ids")


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_quality, op3_toxicity, op4_chat_format, op5_topk_search, op6_sharding, op7_decontaminate, op8_jaccard_join, op9_suffix_dedup, op10_packing,
        op11_prefix_trie, op12_vector_codes, op13_pattern_packing,
    )
}

_HOST = "translate(regexp_extract(coalesce(url, ''), '^(?s).*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
# Up to n words from each place of each text of a table.
_RUNS = "SELECT {keys}, i, list(word) OVER (PARTITION BY {keys} ORDER BY i ROWS BETWEEN CURRENT ROW AND {more} FOLLOWING) AS l FROM (SELECT {keys}, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM {table})"
# CRC-32 of a decimal number, bit by bit: each byte is taken in with the first of its eight shifts.
_CRC = "xor(list_reduce([4294967295] || flatten(list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0])), lambda s, e: xor(xor(s, e) >> 1, (xor(s, e) & 1) * 3988292384)), 4294967295)"
_SQUARE = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _rounds(n: int) -> str:
    """Common tables a0, b1, a1, ..., bn, an: assignments (r, part, entry, d) to codebooks b (part, entry, c) and the codebooks after them."""
    out = []
    for k in range(n + 1):
        near = f"SELECT r, p.part, entry, {_SQUARE.format(a='x', b='c')} AS d FROM parts p JOIN b{k} ON b{k}.part = p.part"
        out.append(f"a{k} AS MATERIALIZED (SELECT r, part, entry, d FROM ({near}) QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1)")
        if k < n:
            sums = f"SELECT part, entry, pos, sum(v) AS s, count(*) AS n FROM (SELECT a.part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM a{k} a JOIN parts p ON p.r = a.r AND p.part = a.part) GROUP BY ALL"
            means = f"SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS c FROM ({sums}) GROUP BY part, entry"
            out.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN ({means}) m USING (part, entry))")
    return ", ".join(out)


SQL = {
    "op1_url_filter": f"""
WITH u AS (SELECT page_id, {_HOST} AS host, regexp_extract(coalesce(url, ''), '^(?s).*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
         FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN best USING (page_id)""",
    "op5_topk_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
    "op4_chat_format": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|turn|>' || role || '<|body|>' || text || '<|end|>' || chr(10)) + length(regexp_replace(role || text, '[^\\<\[|]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op7_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS k, CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS ({_RUNS.format(keys="k", more=9, table="b")}),
win AS (SELECT DISTINCT item, len(l) AS n, array_to_string(l, ' ') AS s FROM bw JOIN b USING (k) WHERE len(l) = least(len(w), 10)),
dw AS ({_RUNS.format(keys="r", more=9, table="d")}),
met AS (SELECT r, i, win.n, item FROM (SELECT r, i, n, array_to_string(l[1:n], ' ') AS s FROM dw, (SELECT DISTINCT n FROM win) WHERE len(l) >= n) x JOIN win ON x.n = win.n AND x.s = win.s),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM met WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)""",
    "op8_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, text, {_WORDS} AS w FROM documents),
dw AS ({_RUNS.format(keys="r", more=4, table="d")}),
sh AS (SELECT DISTINCT r, array_to_string(l, ' ') AS s FROM dw JOIN d USING (r) WHERE len(l) = least(len(w), 5)),
sets AS (SELECT r, count(*) AS n, 's' || sha256(string_agg(s, chr(10) ORDER BY s)) AS c FROM sh GROUP BY r
         UNION ALL SELECT r, 0, 't' || text FROM d WHERE len(w) = 0 AND text <> ''),
classes AS (SELECT c, min(r) AS one, any_value(n) AS n FROM sets GROUP BY c),
cs AS (SELECT c, n, s FROM classes JOIN sh ON sh.r = one),
near AS (SELECT x.c AS a, y.c AS b FROM cs x JOIN cs y ON x.s = y.s AND x.c <> y.c GROUP BY x.c, y.c, x.n, y.n HAVING 5 * count(*) >= 4 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT c, c FROM classes UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
own AS (SELECT c, min(doc_id) AS copy_id, count(*) AS copies FROM d JOIN sets USING (r) GROUP BY c),
roots AS (SELECT a AS c, min(copy_id) AS class_id FROM reach JOIN own ON own.c = b GROUP BY a),
links AS (SELECT a AS c, CAST(sum(copies) AS BIGINT) AS other FROM near JOIN own ON own.c = b GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(copy_id, doc_id) AS copy_id, coalesce(copies - 1 + coalesce(other, 0), 0) AS n_links
FROM d LEFT JOIN sets USING (r) LEFT JOIN own USING (c) LEFT JOIN roots USING (c) LEFT JOIN links USING (c)""",
    "op9_suffix_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT r, o, substr(h, 2 * o + 1, 910) AS c FROM (SELECT r, h, unnest(range(0, length(h) // 2, 256)) AS o FROM d)),
win AS (SELECT r, o + j AS i, md5_number(substr(c, 2 * j + 1, 400)) AS k FROM (SELECT r, o, c, unnest(range(0, least(256, length(c) // 2 - 199))) AS j FROM part)),
again AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step FROM win SEMI JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS z FROM (SELECT r, i, sum(CAST(coalesce(step, 201) > 200 AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS g FROM again) GROUP BY r, g),
keep AS (SELECT r, a, lead(b) OVER (PARTITION BY r ORDER BY a) AS b FROM (SELECT r, z AS a, a AS b FROM span UNION ALL SELECT r, 0, NULL FROM d)),
kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS kh FROM keep JOIN d USING (r) GROUP BY r),
sums AS (SELECT r, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(kh)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN sums USING (r)""",
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(said ORDER BY i) AS l, {_CRC.format(x="conv_id")} % 6 AS h FROM t GROUP BY conv_id),
re AS (SELECT c.conv_id, coalesce(b.l, [])[1:c.h] || c.l[c.h + 1:] AS l FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS MATERIALIZED (SELECT conv_id, d, len(l) = d AS last, CASE WHEN d > 0 THEN length(l[d].t) ELSE 0 END AS chars, sha256(CAST(to_json(l[1:d]) AS VARCHAR)) AS k, sha256(CAST(to_json(l[1:d - 1]) AS VARCHAR)) AS up
      FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM re)),
n AS MATERIALIZED (SELECT d, k, any_value(up) AS up, any_value(chars) AS chars, count(*) AS n_convs, min(conv_id) AS conv_id, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM p GROUP BY d, k),
f AS MATERIALIZED (SELECT n.*, q.conv_id AS parent_conv_id, coalesce(kids, 0) AS n_children FROM n LEFT JOIN n q ON q.d = n.d - 1 AND q.k = n.up LEFT JOIN (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM n GROUP BY ALL) z ON z.d = n.d AND z.k = n.k),
s AS (SELECT a.d, a.k, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved FROM f JOIN p v ON v.conv_id = f.conv_id AND v.d <= f.d JOIN f a ON a.d = v.d AND a.k = v.k GROUP BY a.d, a.k)
SELECT conv_id, f.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256 FROM f JOIN s ON s.d = f.d AND s.k = f.k""",
    "op12_vector_codes": f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS r, * FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS MATERIALIZED (SELECT r, part, e[part * (len(e) // 8) + 1:(part + 1) * (len(e) // 8)] AS x FROM v, (SELECT unnest(range(8)) AS part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM parts WHERE r <= 16), {_rounds(6)},
code AS (SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN code USING (r), book""",
}

"""The registered queries of the training-data operators, with reference SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PII_KEY = "lamina example key"  # stands for a secret of the user


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of all documents and the text they decode to, as digests."""
    from lamina.llm.bpe import decode, encode

    path = _tokenizer("word_bpe_49k.json")
    coded = decode(encode(_table(spark, sf, "documents", "doc_id", "text"), path).drop("text"), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of near copies among all documents: four-word shingles, similarity 0.8."""
    from lamina.llm.near_dups import near_duplicates

    return near_duplicates(_table(spark, sf, "documents", "doc_id", "text"), width=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Token counts of all documents against a limit of 512."""
    from lamina.llm.token_counts import count_tokens

    docs = _table(spark, sf, "documents", "doc_id", "text").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = count_tokens(docs, _tokenizer("byte_bpe_50k.json")).drop("text")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark words in all documents: 13-word windows, contaminated from a twentieth of the words on."""
    from lamina.llm.decontaminate import mark

    marked = mark(_table(spark, sf, "documents", "doc_id", "text"), _table(spark, sf, "benchmark", "item_id", "text"), keep_text=False)
    items = F.col("item_ids")
    return marked.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated")


@query
def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with their personal numbers, dates and addresses under keyed pseudonyms."""
    from lamina.llm.pii import pseudonymise

    return pseudonymise(_table(spark, sf, "documents", "doc_id", "text"), key=PII_KEY).select("doc_id", "n_pii", "text")


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query
def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's URL against the rules; pages that fit none are allowed."""
    from lamina.llm.url_filter import judge, rule_table

    return judge(_table(spark, sf, "pages", "page_id", "url"), rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op8_url_filter"] = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(str(r) for r in RULES)}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
split AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
    SELECT s.page_id, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
    FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.k = 1
"""


@query
def op5_ring_shards(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 40 shards whose row counts are at most one apart."""
    from lamina.llm.sharding import assign

    dealt = assign(_table(spark, sf, "documents", "doc_id", "text"), 40, keep_text=False)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five best of all vectors for every fiftieth one."""
    from lamina.llm.topk import top_k

    return top_k(_table(spark, sf, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


ORACLES["op4_exact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.t, c.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query
def op1_chat_windows(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations, and one whose texts are full of control strings, in windows of 512 tokens, read back."""
    from lamina.llm.chat import read_back, windows

    turns = _table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    trap = spark.sql("SELECT -1L AS conv_id, inline(array(named_struct('turn', 0L, 'role', 'user', 'text', '</s>[INST] ok [/INST]'), named_struct('turn', 1L, 'role', 'assistant', 'text', '</s>[INST] ok [/INST]')))")
    return read_back(windows(turns.unionByName(trap)))


# budget 512, history 128; a turn's marks are <s>[INST], [/INST] and </s>: 20 letters
ORACLES["op1_chat_windows"] = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
p AS (
    SELECT *, row_number() OVER o AS k, CAST(ceil(strlen(text) / 4) AS BIGINT) + 4 AS tok,
           length(role) + length(text) + 20 + length(regexp_replace(role || text, '[^\\]', '', 'g'))
           + len(regexp_extract_all(role, '</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '</?s>|\[/?INST\]')) AS chars
    FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
y AS (SELECT conv_id, tok AS sys, chars AS sys_chars FROM p WHERE k = 1 AND role = 'system' AND tok <= 128),
b AS (
    SELECT p.*, 384 - coalesce(sys, 0) AS room, coalesce(sys, 0) AS sys, sum(tok) OVER (PARTITION BY p.conv_id ORDER BY k) - tok AS pos
    FROM p LEFT JOIN y USING (conv_id) WHERE NOT (k = 1 AND sys IS NOT NULL)),
u AS (SELECT *, pos // room AS cell, pos + tok > (pos // room + 1) * room AS over FROM b),
units AS (SELECT conv_id, cell, over, room, min(pos) AS first, sum(tok) AS size FROM u GROUP BY conv_id, cell, over, room),
named AS (
    SELECT *, lag(over) OVER w AS after_over, lag(first) OVER w AS lead, lag(size) OVER w AS lead_size FROM units
    WINDOW w AS (PARTITION BY conv_id ORDER BY first)),
span_of AS (SELECT conv_id, cell, over, CASE WHEN NOT over AND after_over AND size + lead_size <= room THEN lead ELSE first END AS span FROM named),
s AS (SELECT u.*, span FROM u JOIN span_of USING (conv_id, cell, over)),
spans AS (SELECT conv_id, span, any_value(sys) AS sys, any_value(room) AS room, sum(tok) AS size, lead(sum(tok)) OVER (PARTITION BY conv_id ORDER BY span) AS next_size FROM s GROUP BY conv_id, span),
again AS (
    SELECT s.conv_id, sum(s.chars) AS chars FROM s JOIN spans w USING (conv_id, span)
    WHERE w.next_size <= w.room AND w.span + w.size - s.pos <= 128 GROUP BY s.conv_id),
held AS (
    SELECT y.conv_id, sys_chars * greatest(1, count(*) FILTER (spans.sys + size <= 512) + CASE WHEN bool_or(span = 0 AND spans.sys + size > 512) THEN 1 ELSE 0 END) AS chars
    FROM y LEFT JOIN spans USING (conv_id) GROUP BY y.conv_id, sys_chars),
own AS (SELECT conv_id, sum(chars) AS chars FROM s GROUP BY conv_id)
SELECT p.conv_id, count(*) AS n_turns, sha256(string_agg(p.role || chr(10) || p.text || chr(10), '' ORDER BY p.k)) AS turns_sha256,
       CAST(coalesce(sum(length(p.text)) FILTER (p.role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(p.text, '' ORDER BY p.k) FILTER (p.role = 'assistant'), '')) AS loss_sha256,
       CAST(coalesce(any_value(own.chars), 0) + coalesce(any_value(again.chars), 0) + coalesce(any_value(held.chars), 0) AS BIGINT) AS formatted_chars
FROM p LEFT JOIN own USING (conv_id) LEFT JOIN again USING (conv_id) LEFT JOIN held USING (conv_id) GROUP BY p.conv_id
"""


def held_out(doc_id):
    """The quarter of the documents that the classifier never learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels outside the held-out quarter."""
    from lamina.llm.toxicity import score, train

    docs = _table(spark, sf, "documents", "doc_id", "text", "lang")
    classifier = train(docs, _table(spark, sf, "labels", "doc_id", "toxic"), use=~held_out(F.col("doc_id")))
    scored = score(docs, classifier).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "threshold", "toxic")


@query
def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """All documents rearranged for filling in the middle, with digests of the output and of what is restored from it."""
    from lamina.llm.fim import transform

    return transform(_table(spark, sf, "documents", "doc_id", "text"))


ORACLES["op11_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (
    SELECT doc_id, text, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
n AS (SELECT *, CAST(len(regexp_extract_all(text, '(?s).')) AS BIGINT) AS n FROM u),
f AS (
    SELECT doc_id, text, n, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
           least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM n),
c AS (
    SELECT *, array_to_string(list_slice(regexp_extract_all(text, '(?s).'), 1, a), '') AS p, array_to_string(list_slice(regexp_extract_all(text, '(?s).'), a + 1, b), '') AS m,
           array_to_string(list_slice(regexp_extract_all(text, '(?s).'), b + 1, n), '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""


@query
def op12_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """License phrases and notices in all documents."""
    from lamina.llm.licenses import scan, template_table

    found = scan(_table(spark, sf, "documents", "doc_id", "text"), template_table(spark))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def _license_oracle() -> str:
    from lamina.llm.licenses import PHRASES, TEMPLATES

    phrases, templates = (", ".join(str(r) for r in rows) for rows in (PHRASES, TEMPLATES))
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def words(text: str) -> str:
        return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}')"

    return f"""
WITH phrases(phrase, label) AS (VALUES {phrases}), templates(label, text) AS (VALUES {templates}),
d AS (SELECT doc_id, row_number() OVER () AS r, {words("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT label, string_split(phrase, ' ') AS p FROM phrases),
t AS (SELECT label, list_distinct({words("text")}) AS t FROM templates),
pos AS (SELECT r, w, unnest(range(len(w))) AS i FROM d),
base AS (
    SELECT pos.r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS base_labels
    FROM pos JOIN p ON pos.w[i + 1] = p.p[1] AND list_slice(pos.w, i + 1, i + len(p.p)) = p.p GROUP BY pos.r),
k AS (SELECT r, w, unnest(range(greatest(1, (len(w) - 1) // 32))) AS k FROM d WHERE len(w) > 0),
b AS (SELECT r, list_distinct(list_slice(w, 32 * k + 1, 32 * k + 64)) AS b FROM k),
c AS (SELECT b.r, t.label, len(list_intersect(b.b, t.t)) AS c, len(t.t) AS s FROM b, t),
more AS (SELECT r, list(DISTINCT label) AS labels, max(c / s) AS share FROM c WHERE c * 100 >= 90 * s GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN more USING (r)
"""


ORACLES["op12_license_scan"] = _license_oracle()


@query
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty best of all documents for every benchmark item."""
    from lamina.llm.lexical import search

    return search(_table(spark, sf, "documents", "doc_id", "text"), _table(spark, sf, "benchmark", "item_id", "text"))


ORACLES["op13_lexical_search"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT row_number() OVER () AS q, item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
whole AS (SELECT count(*) FILTER (len(w) > 0) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM docs),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, whole GROUP BY t),
asked AS (SELECT q, t, count(*) AS c FROM (SELECT q, unnest(w) AS t FROM items) GROUP BY q, t),
m AS (SELECT r, doc_id, 75 + (25 * len(w) * big_n) // big_l AS m FROM docs, whole WHERE len(w) > 0),
score AS (
    SELECT a.q, m.r, any_value(m.doc_id) AS doc_id, CAST(sum(a.c * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked a JOIN tf USING (t) JOIN weight USING (t) JOIN m USING (r) GROUP BY a.q, m.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score JOIN items USING (q) WHERE score > 0 QUALIFY rank <= 20
"""

"""Queries of the numbered operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.llm import (bpe, chat, collocations, embed_dedup, jaccard, langid, licenses, packing, quality, repair,
                         sharding, topk, url_rules)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, rest: int):
    """Whether crc32 of doc_id as text leaves ``rest``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


# ---- 1: byte-level BPE -----------------------------------------------------

@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


# ---- 2: URL rules ----------------------------------------------------------

#: The rules that the query judges by (fixed values): verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("""
WITH u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT h.page_id, h.host, h.path, rhost || rpath AS rule, r.verdict,
             row_number() OVER (PARTITION BY h.page_id ORDER BY length(rhost) DESC NULLS LAST,
                                length(rpath) DESC NULLS LAST) AS k
      FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
""")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


# ---- 3: embedding near-duplicates ------------------------------------------

@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))
        AND list_bool_or(list_transform(embedding, lambda e: e <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
""")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


# ---- 4: chat formatting ----------------------------------------------------

_ESCAPED = r"""regexp_replace({}, '(\\*(?:<s>|</s>|\[INST\]|\[/INST\]|\[TURN\]))', '\\\1', 'g')"""


@query(f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER w AS pos, lag(role) OVER w IS DISTINCT FROM role AS head FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format('text')})
           + CASE WHEN head THEN 23 + length({_ESCAPED.format('role')}) ELSE 8 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
""")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{ok}'), (-1L, 1L, 'assistant', '{ok}') "
                     "AS t(conv_id, turn, role, text)")
    chats = chat.format_chats(turns.unionByName(more))
    chats = chats.select("conv_id", "formatted", chat.read_chats(F.col("formatted")).alias("turns"),
                         chat.loss_text(F.col("segments")).alias("loss"))
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


# ---- 5: packing --------------------------------------------------------------

@query()
def op5_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("ids_crc32")
    return packing.pack(pieces).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


# ---- 6: licence scan -------------------------------------------------------

@query()
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    base = F.filter("matches", lambda m: m["base"])
    places = F.transform(base, lambda m: m["first"])
    return scanned.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                          F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
                          joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"), "score")


# ---- 7: language identification --------------------------------------------

@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit_languages(docs.filter(~held_out(3, 1)))
    return langid.identify_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


# ---- 8: quality ------------------------------------------------------------

#: Documents scored below this are predicted to be of low quality.
KEEP_SCORE = 0.7


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit_quality(docs, labels.filter(~held_out(4, 2)))
    return quality.score_quality(docs, model).select(
        "doc_id", held_out(4, 2).alias("held_out"), "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


# ---- 9: n-gram Jaccard join ------------------------------------------------

@query(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) < 5 THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '') ELSE
                 list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM words),
class AS MATERIALIZED (SELECT s, len(s) AS n, min(doc_id) AS id FROM sets WHERE len(s) > 0 GROUP BY s),
token AS MATERIALIZED (SELECT id, n, unnest(s) AS t FROM class),
seen AS (SELECT t, row_number() OVER () AS k FROM token GROUP BY t HAVING count(*) > 1),
shared AS MATERIALIZED (SELECT k, id, n FROM token JOIN seen USING (t)),
pair AS (
  SELECT a.id AS a, b.id AS b FROM shared a JOIN shared b ON a.k = b.k AND a.id < b.id
     AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edge AS MATERIALIZED (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach(id, other) AS (SELECT id, id FROM class UNION SELECT r.id, e.b FROM reach r JOIN edge e ON e.a = r.other),
least_id AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN class c ON c.s = d.s LEFT JOIN least_id l ON l.id = c.id
""")
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similar_documents(docs).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


# ---- 10: exact top-k search ------------------------------------------------

@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL
                 AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
""")
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


# ---- 11: collocations ------------------------------------------------------

@query(r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
o AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))
        AS phrase FROM p, (VALUES (1), (2), (3)) s(k)),
f AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM o GROUP BY lang, k, phrase
      HAVING count(*) >= 10),
c AS (SELECT lang, phrase, f AS a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
      FROM f, (VALUES (1), (2)) s(j) WHERE j < k),
g AS (SELECT c.lang, c.phrase, a, j, h.f AS l, e.f AS r, (1000000::HUGEINT * a * a // (h.f::HUGEINT * e.f))::BIGINT AS score
      FROM c JOIN f h ON h.lang = c.lang AND h.phrase = head JOIN f e ON e.lang = c.lang AND e.phrase = tail),
b AS (SELECT lang, phrase, a, arg_min(l, score * 4 + j) AS l, arg_min(r, score * 4 + j) AS r, min(score) AS score
      FROM g GROUP BY lang, phrase, a),
i AS (SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM f WHERE k = 3
        UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM f WHERE k = 3) GROUP BY lang, phrase),
k AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN i USING (lang, phrase) WHERE i.f IS NULL OR 100 * i.f < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM k JOIN t USING (lang) WHERE rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


# ---- 12: sharding ----------------------------------------------------------

@query()
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return dealt.select(F.col("key").alias("doc_id"), "size", F.col("checksum").alias("text_crc32"),
                        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# ---- 13: conversation repair -----------------------------------------------

@query()
def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))

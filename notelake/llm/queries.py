"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from notelake.llm import (
    byte_bpe, chats, decontaminate, filter_audit, html_text, katz, near_dup, one_bit, prefix_trie,
    quality, sharding, token_counts, toxicity,
)
from notelake.session import fresh_path

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op7_byte_bpe(spark, sf_dir):
    return byte_bpe.digest_texts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op1_token_counts(spark, sf_dir):
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_quality_rules(spark, sf_dir):
    return quality.assess(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op3_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op8_decontaminate(spark, sf_dir):
    return decontaminate.find_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
rolled AS (
  SELECT *, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         md5(CAST(list({'t': turn, 'r': role, 'x': text}) OVER w AS VARCHAR)) AS prefix
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
               ROWS UNBOUNDED PRECEDING)),
whole AS (
  SELECT prefix, min(conv_id) AS conv_id, count(*) AS copies FROM rolled
  WHERE position = n_turns GROUP BY prefix),
kept AS (
  SELECT * FROM whole
  WHERE prefix NOT IN (SELECT prefix FROM rolled WHERE position < n_turns))
SELECT r.conv_id, r.position, CAST(r.n_turns AS BIGINT) AS n_turns, k.copies,
       '<|' || coalesce(r.role, 'unknown') || '|>' || chr(10) || coalesce(r.text, '') || chr(10)
       || '<|end|>' || chr(10) AS rendered
FROM rolled r JOIN kept k ON r.conv_id IS NOT DISTINCT FROM k.conv_id""")
def op2_chat_formatting(spark, sf_dir):
    return chats.format_chats(table(spark, sf_dir, "conversations"))


SHARDS = [f"shard-{i:02}" for i in range(48)]


def plain_owners(names: list[str]) -> list[str]:
    """The table by its definition, with whole orders of preference, for the SQL below."""
    size = 4801
    orders = [[(sharding.number_of(f"{n}:offset") + j * (sharding.number_of(f"{n}:step")
                % (size - 1) + 1)) % size for j in range(size)] for n in names]
    orders = [iter(order) for order in orders]
    owner: dict[int, str] = {}
    while len(owner) < size:
        for name, order in zip(names, orders):
            if (slot := next((s for s in order if s not in owner), None)) is not None:
                owner[slot] = name
    return [owner[slot] for slot in range(size)]


@query(f"""
WITH owners AS (SELECT unnest(range(4801)) AS slot,
                       unnest([{','.join(str(int(n[-2:])) for n in plain_owners(SHARDS))}]) AS owner),
placed AS (SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT)
                          % 4801 AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(CAST(owner AS VARCHAR), 2, '0') AS shard
FROM placed JOIN owners USING (slot)""")
def op9_sharding(spark, sf_dir):
    path = fresh_path(spark, "shards")
    docs = table(spark, sf_dir, "documents")
    sharding.write_shards(docs, path, SHARDS)
    return sharding.read_shards(docs, path).select("doc_id", "slot", "shard")


@query()
def op10_katz_scores(spark, sf_dir):
    return katz.score(table(spark, sf_dir, "documents"))


@query()
def op6_html_extraction(spark, sf_dir):
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query(r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tested AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY md5(t)), false) AS e FROM words),
known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, CAST(a AS INT) + 2 * CAST(b AS INT) + 4 * CAST(c AS INT) + 8 * CAST(d AS INT)
         + 16 * CAST(e AS INT) AS mask, count(*) AS n, coalesce(sum(good), 0) AS good,
         coalesce(sum(toxic), 0) AS toxic
  FROM tested LEFT JOIN known USING (doc_id) GROUP BY ALL),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT [p.f, q.f, r.f, s.f, t.f] AS names, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM one p, one q, one r, one s, one t WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
    AND p.bit | q.bit | r.bit | s.bit | t.bit = 31),
steps AS (
  SELECT array_to_string(names, '') AS filter_order, CAST(k AS INT) AS step, bits[k] AS own,
         CAST(coalesce(list_sum(bits[1:k - 1]), 0) AS INT) AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS x(k)),
counted AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (before + own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & own > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM failed, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted""")
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("""
WITH given AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
usable AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM given
  WHERE len(v) = len(list_filter(v, lambda x: isfinite(x))) AND len(list_filter(v, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) / (q.size * c.size) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5""")
def op11_nearest_vectors(spark, sf_dir):
    return one_bit.nearest(table(spark, sf_dir, "embeddings"), every=50)


@query("""
WITH codes AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS code
  FROM range(256) t(i)),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
         {'said': md5(coalesce(role, '')) || md5(coalesce(text, '')),
          'chars': length(coalesce(text, ''))} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(said ORDER BY place) AS said FROM turns GROUP BY conv_id),
plan AS (
  SELECT l.conv_id, l.said, coalesce(b.said, []) AS lead,
         xor(list_reduce(list_concat([4294967295], list_transform(
               range(1, length(CAST(l.conv_id AS VARCHAR)) + 1),
               lambda i: CAST(ascii(substr(CAST(l.conv_id AS VARCHAR), i, 1)) AS BIGINT))),
             lambda c, x: xor(code[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 6 AS h
  FROM lists l LEFT JOIN lists b ON b.conv_id = l.conv_id - l.conv_id % 100, codes),
rebuilt AS (SELECT conv_id, list_concat(lead[1:h], said[h + 1:]) AS said FROM plan),
paths AS (
  SELECT conv_id, depth, len(said) AS n, md5(CAST(said[1:depth] AS VARCHAR)) AS node,
         CASE WHEN depth > 0 THEN md5(CAST(said[1:depth - 1] AS VARCHAR)) END AS parent,
         CASE WHEN depth > 0 THEN said[depth].chars ELSE 0 END AS chars
  FROM rebuilt, unnest(range(len(said) + 1)) AS x(depth)),
nodes AS (
  SELECT depth, node, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id,
         count(*) AS n_convs, string_agg(CASE WHEN depth = n THEN CAST(conv_id AS VARCHAR) END, ','
                                         ORDER BY conv_id) AS ids
  FROM paths GROUP BY depth, node),
counted AS (
  SELECT *, (SELECT count(*) FROM nodes c WHERE c.parent = n.node AND c.depth = n.depth + 1) AS n_children
  FROM nodes n),
below AS (
  SELECT p.depth, p.node, count_if(c.n_children = 0) AS n_leaves,
         sum((c.n_convs - 1) * c.chars) AS saved_tokens
  FROM counted c JOIN paths p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY ALL)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, CAST(c.n_children AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(c.ids, '')) AS ends_sha256
FROM counted c JOIN below b ON b.depth = c.depth AND b.node = c.node
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.parent""")
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))

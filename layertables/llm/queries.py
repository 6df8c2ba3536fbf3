"""The registered queries of this package: every operator, with production
parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layertables.llm import ann, chat, cutting_stock, decontam, langid, packing, pii, prefix_trie, runs, secrets, simhash, token_store, toxicity
from layertables.llm.common import table
from layertables.llm.tokens import public_path
from layertables.session import scratch_path


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_store")
    token_store.write_token_store(table(spark, sf_dir, "documents"), path, public_path("word_bpe_49k.json"), end_id=1)
    return token_store.read_documents(spark, path)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn_from=~toxicity.held_out())
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "spans")


# For these queries alone; a user passes a secret of their own to ``pii.replace``.
TEST_KEY = "key-of-the-registered-query"


def op3_surrogates(spark: SparkSession, sf_dir: str, key: str = TEST_KEY) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), key)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = langid.training_text(docs, learn_from=~langid.held_out())
    return langid.predict(docs, training).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"), end_id=0, max_tokens=2048)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index = ann.build(vectors)
    return ann.search(index, vectors.filter("vec_id % 50 = 0"), 5)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op9_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat.format_chats(table(spark, sf_dir, "conversations"))
    place = lambda x: F.concat_ws(":", x.start.cast("string"), x.end.cast("string"))
    return chats.withColumn("answers", F.array_join(F.transform("answers", place), ","))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), end_id=2, max_tokens=4096)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(*prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.detect(table(spark, sf_dir, "documents"), prepare=runs.tail_repeats))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_store,
        op2_toxicity,
        op3_surrogates,
        op4_language_id,
        op5_packing,
        op6_simhash,
        op7_neighbours,
        op8_secrets,
        op9_chats,
        op10_decontaminate,
        op11_cutting_stock,
        op12_prefix_trie,
        op13_runs,
    )
}


# The rebuilt conversations as lists of (role, text), every prefix of them, and the
# totals of a subtree by membership: a node lies below another if its smallest member
# also begins with that. crc32 is written bit by bit.
PREFIX_TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT *, xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda acc, x: list_reduce(list_concat([xor(acc, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda a, z: xor(a >> 1, (a & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 6 AS h
  FROM turns),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS s
  FROM heads c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefix AS (
  SELECT conv_id, len(s) AS n, d, s[1:d] AS k, s[1:d - 1] AS up
  FROM whole, unnest(range(len(s) + 1)) AS g(d)),
node AS (
  SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends,
         CASE WHEN d = 0 THEN 0 ELSE length(k[d].t) END AS size
  FROM prefix GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY d, up),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON node.d = kids.d AND node.k = kids.k),
below AS (
  SELECT p.d, p.k, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.size) AS saved_tokens
  FROM prefix p JOIN full_node x ON x.conv_id = p.conv_id AND x.d >= p.d GROUP BY p.d, p.k)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs,
       CAST(v.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM full_node v JOIN below b ON b.d = v.d AND b.k = v.k LEFT JOIN node u ON v.d > 0 AND u.d = v.d - 1 AND u.k = v.up
"""


# Conversations as lists of (role, text); those equal to a proper prefix of another go.
CHATS_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations),
conv AS (SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, r, t) AS s FROM turns GROUP BY conv_id),
proper AS (SELECT DISTINCT s[1:d] AS s FROM conv, unnest(range(1, len(s))) AS g(d)),
kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_copies, s FROM conv
  WHERE NOT EXISTS (SELECT 1 FROM proper WHERE proper.s = conv.s) GROUP BY s),
part AS (
  SELECT conv_id, n_copies, d, s[d].r AS r, s[d].t AS t,
         concat('<|im_start|>', s[d].r, chr(10), s[d].t, '<|im_end|>', chr(10)) AS p
  FROM kept, unnest(range(1, len(s) + 1)) AS g(d)),
placed AS (
  SELECT *, coalesce(sum(length(p)) OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + length('<|im_start|>') + length(r) + 1 AS a
  FROM part)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, CAST(any_value(n_copies) AS BIGINT) AS n_copies,
       string_agg(p, '' ORDER BY d) AS text,
       coalesce(string_agg(concat(CAST(a AS BIGINT), ':', CAST(a + length(t) AS BIGINT)), ',' ORDER BY d) FILTER (WHERE r = 'assistant'), '') AS answers
FROM placed GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_chats": CHATS_SQL, "op12_prefix_trie": PREFIX_TRIE_SQL}

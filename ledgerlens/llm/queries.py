"""Registered queries of this subpackage: ``opN_<name>`` over whole tables,
with DuckDB oracles where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (byte_bpe, chat_format, decontaminate, exact_dedup, langid, license_scan,
                            ngram_join, periodic_runs, secret_scan, superminhash,
                            token_store, toxicity, whitening)
from ledgerlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# groups of texts whose sets of word 5-grams reach a similarity
_LINKED = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 4] AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, x) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e2.b FROM r JOIN e2 ON r.x = e2.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id{more}
FROM (SELECT doc_id, min(x) AS component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)
"""


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.roundtrip(table(spark, sf_dir, "documents"))


@query("op3_chat_format", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(replace(replace(replace(replace(replace(replace(replace(text,
        '\', '\\'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>'),
        '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>')) + length(role) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + 21)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat_format.digests(chat_format.format_chats(chats.unionByName(probe)))


@query("op4_exact_dedup", """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = exact_dedup.ingest(docs, exact_dedup.DigestIndex(spark))
    return out.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), categories=("quality",))


@query("op8_token_store")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.write_and_check(table(spark, sf_dir, "documents"))


@query("op9_ngram_join", _LINKED.format(percent=80, more=""))
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("cls")


@query("op10_decontaminate", r"""
WITH RECURSIVE fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, fold),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, fold),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[s:s + least(len(w), 10) - 1] AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, s, w[s:s + n - 1] AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, s, n FROM dw JOIN iw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the columns are those of the SQL, which has no proximity: near_leaks has them all
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slack=None)


def near_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op10, and the items with proximity matches."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_superminhash", _LINKED.format(percent=85, more=", doc_id = component_id AS kept"))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents")).drop("cls")


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(periodic_runs.find(periodic_runs.planted(table(spark, sf_dir, "documents"))))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))

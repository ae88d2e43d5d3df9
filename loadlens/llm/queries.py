"""The registered queries of the training-data operators: ``opN_<name>`` over its whole table.

Each is thin: it reads its table, calls its operator with production parameters and derives the
digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import (align, bpe, chat, conv_repair, decontaminate, embed_dedup, html_main, line_dedup, lm_score, pii, quality_knn, simhash,
                          toxicity)
from loadlens.llm.common import train_part
from loadlens.sources.tables import read_table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: The key of the registered PII query; a production run passes its own secret.
PII_KEY = b"registered query"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    kept = F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


ORACLE["op1_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, pos, parts[pos] AS line,
         trim(translate(parts[pos], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS pos)),
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.doc_id, l.pos, l.line, (o.owner IS NOT NULL AND o.owner <> l.doc_id) AS gone
  FROM lines l LEFT JOIN owners o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return got.select(F.col("id").alias("doc_id"), "item_id", "distance", "end")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return got.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


@query
def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lm_score.score_texts(read_table(spark, sf_dir, "documents"), modulus=5, held_out=1)
    return got.withColumnRenamed("id", "doc_id")


@query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(turns.unionByName(extra)))


ORACLE["op5_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, role = 'assistant' AS reply,
         length(role) + 1 + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END
         + length(regexp_replace(replace(text, '\', '\\'), '([\[<])(/?INST\]|/?s>)', '\1\\\2', 'g')) AS chars
  FROM turns),
running AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         lead(turn) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NULL AS last
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (reply), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (reply), '')) AS loss_sha256,
       (sum(upto) FILTER (reply OR last))::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.surrogate_pii(read_table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", "n_entities", "text")


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe.bpe_encode(read_table(spark, sf_dir, "documents"), RANKS, PATTERN, decode=True)
    return got.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), modulus=5, held_out=0)
    held = ~train_part(F.col("doc_id"), 5, 0) & F.col("doc_id").isNotNull()
    return toxicity.score_toxicity(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_main.extract_main_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_groups(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLE["op10_embedding_dedup"] = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(c.low, v.vec_id)) AS component_id,
       least(v.vec_id, coalesce(c.low, v.vec_id)) = v.vec_id AS kept
FROM embeddings v
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = v.vec_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) c ON c.a = v.vec_id
"""


@query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_knn.train(docs, read_table(spark, sf_dir, "labels"), modulus=5, held_out=0)
    held = ~train_part(F.col("doc_id"), 5, 0) & F.col("doc_id").isNotNull()
    return quality_knn.score_quality(docs, model, threshold=0.3).select("doc_id", held.alias("held_out"), "score",
                                                                        "predicted")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conv_repair.damaged(read_table(spark, sf_dir, "conversations"))
    return conv_repair.digests(conv_repair.repair(rows, present=F.col("present")))


def _edit(state: str, cost: str, letter: str, row: str, allowed: str = "true") -> str:
    """A place's struct (cost, edits, repaired rows) after one more edit; dear where the edit is not allowed."""
    return (f"{{'c': {state}.c + {cost} + CASE WHEN {allowed} THEN 0 ELSE 1000000000 END, 'e': {state}.e || '{letter}', "
            f"'x': {state}.x{row}}}")


def _repair_sql() -> str:
    kept, user, reply = " || chr(10) || role || ':' || text", " || chr(10) || 'user:'", " || chr(10) || 'assistant:'"
    more = "CASE WHEN cut THEN 3 ELSE 0 END"
    free, rerole = "NOT gone", f"3 + {more}"
    row = {
        "b": [_edit("b", "4", "D", "")],
        "s": [_edit("s", "4", "D", ""), _edit("b", more, "K", kept, f"{free} AND i = 's'")],
        "u": [_edit("u", "4", "D", "")] + [x for q in "bsa" for x in (
            _edit(q, more, "K", kept, f"{free} AND i = 'u'"), _edit(q, rerole, "R", user + " || text", free))],
        "a": [_edit("a", "4", "D", ""), _edit("u", more, "K", kept, f"{free} AND i = 'a'"),
              _edit("u", rerole, "R", reply + " || text", free)],
    }
    read = ", ".join(f"least({', '.join(v)}) AS {k}" if len(v) > 1 else f"{v[0]} AS {k}" for k, v in row.items())
    inserted = f"least(u, {', '.join(_edit(q, '3', 'I', user) for q in 'bsa')})"
    start = "{'c': 0::BIGINT, 'e': '', 'x': ''}"
    far = "{'c': 1000000000::BIGINT, 'e': '', 'x': ''}"

    def closed(source: str) -> str:
        """Insertions after a row: a user row from any other place, then an assistant row."""
        return (f"SELECT conv_id, p, b, s, u, least(a, {_edit('u', '3', 'I', reply)}) AS a "
                f"FROM (SELECT conv_id, p, b, s, {inserted} AS u, a FROM ({source}))")

    begin = closed(f"SELECT DISTINCT conv_id, 0::BIGINT AS p, {start} AS b, {far} AS s, {far} AS u, {far} AS a FROM conversations")
    step = closed(f"SELECT g.conv_id, g.p, {read} FROM step JOIN g ON g.conv_id IS NOT DISTINCT FROM step.conv_id "
                  f"AND g.p = step.p + 1")
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
damage AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
         list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM named, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [0, 1] ELSE [0] END) AS again FROM damage),
numbered AS (
  SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open FROM damaged),
faults AS (
  SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS repeated,
         p > 1 AND lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i NOT IN ('su', 'ua', 'au') AS bad FROM numbered),
g AS (SELECT *, blank OR repeated AS gone, open AND NOT (blank OR repeated) AS cut FROM faults),
step AS ({begin} UNION ALL {step}),
ends AS (SELECT conv_id, least(arg_max(b, p), arg_max(a, p)) AS w FROM step GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (repeated) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (bad) AS illegal
  FROM g GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, w.c AS cost, w.e AS audit,
       sha256(substr(w.x, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


ORACLE["op12_conversation_repair"] = _repair_sql()


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read_table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES).withColumnRenamed("id", "doc_id")

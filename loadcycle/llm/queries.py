"""The registered queries of this folder, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcycle.llm import (
    alignment, bpe, chat, exact_dedup, kneser_ney, language, mixing, quality, repair, sentence_pieces, simhash, token_counts, top_k,
)
from loadcycle.llm.common import fold, tables

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_byte_level_bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip(tables(spark, d, "documents"), VOCABULARY, PATTERN)


def op2_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    classes = exact_dedup.duplicate_classes(tables(spark, d, "documents"))
    return classes.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    vectors = tables(spark, d, "embeddings")
    return top_k.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op4_mixing(spark: SparkSession, d: str) -> DataFrame:
    rows, plan = mixing.mixing_plan(tables(spark, d, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return mixing.mix_report(rows, plan).select("doc_id", "size", "source_size", "target", "taken")


def op5_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = tables(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    records = rows.select("conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    turns = chat.canonical_turns(records, id_col="conv_id", record_col="record")
    return chat.read_back(chat.format_turns(turns.select("conv_id", "turn", "role", "text")))


def op6_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = tables(spark, d, "documents").withColumn("held_out", fold("doc_id", 3) == 1)
    model = language.train(docs.filter("not held_out"))
    return language.identify(docs, model, keep=["held_out"])


def op7_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = tables(spark, d, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    model = quality.train(docs.filter("not held_out"), tables(spark, d, "labels"))
    return quality.quality(docs, model, keep=["held_out"], threshold=0.7)


def op8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(tables(spark, d, "documents"), VOCABULARY)


def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(tables(spark, d, "documents"), width=3, seed=42, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    docs = tables(spark, d, "documents").withColumn("held_out", fold("doc_id", 5) == 1)
    model = kneser_ney.train(docs.filter("not held_out"), order=3)
    return kneser_ney.score(docs, model, keep=["held_out"])


def op11_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return sentence_pieces.round_trip(tables(spark, d, "documents"), PIECES)


def op12_token_alignment(spark: SparkSession, d: str) -> DataFrame:
    return alignment.align_corpus(tables(spark, d, "documents"), BYTE_LEVEL, PATTERN, PIECES)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of the conversations with one in 20 each dropped, emptied, cut short, repeated or given to the user."""
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fault = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), fault.alias("fault"),
    )
    rows = rows.filter("fault <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))


def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    conversations = tables(spark, d, "conversations")
    rows = damaged(conversations)
    plans = repair.plans(rows)
    digests = repair.repaired_digests(rows, plans).withColumnRenamed("conv_id", "own_id")
    every = conversations.select("conv_id").distinct()
    whole = plans.join(digests, F.col("conv_id").eqNullSafe(F.col("own_id"))).drop("own_id").withColumnRenamed("conv_id", "own_id")
    found = every.join(whole, F.col("conv_id").eqNullSafe(F.col("own_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return found.select(F.col("conv_id").cast("long").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


_OPERATORS = (
    op1_byte_level_bpe, op2_exact_dedup, op3_exact_top_k, op4_mixing, op5_chat_formatting, op6_language_id,
    op7_quality_classifier, op8_token_counts, op9_simhash, op10_lm_scoring, op11_sentencepiece, op12_token_alignment,
    op13_conversation_repair,
)

_SPACE = r"[\x20\x09-\x0D]"



def _more(label: str, cost: str, edit: str) -> str:
    """A path as text, its cost first in six digits so that texts compare as paths do, with one more edit."""
    return f"printf('%06d', CAST(substr({label}, 1, 6) AS BIGINT) + {cost}) || substr({label}, 7) || '{edit}'"


#: The edits of op13 in SQL: a recursive step for each row of a conversation, with one best path for each of four states (n: nothing yet,
#: s: after system, u: after user, a: after assistant), the inserted rows before the row in the inner query.
_REPAIR = rf"""WITH RECURSIVE
    tab AS (SELECT list(list_reduce(list_concat([i], range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)),
    f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      xor(list_reduce(list_concat([4294967295], list_transform(string_split(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ascii(x))),
        lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS fault FROM conversations, tab),
    d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
      CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM f WHERE fault <> 0),
    o AS (SELECT *, regexp_replace(text, '{_SPACE}', '', 'g') AS solid, substr(role, 1, 1) AS c,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
    r AS (SELECT *, CASE WHEN solid = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM o),
    g AS (SELECT conv_id, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
      count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id),
    w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM g
      UNION ALL
      SELECT conv_id, i, {_more("n", "4", "D")},
        least({_more("s", "4", "D")}, CASE WHEN stays AND c = 's' THEN {_more("n", "extra", "K")} END),
        least({_more("u", "4", "D")}, CASE WHEN stays AND c = 'u' THEN {_more("least(n, s, a)", "extra", "K")} END,
          CASE WHEN stays THEN {_more("least(n, s, a)", "extra + 3", "R")} END),
        least({_more("a", "4", "D")}, CASE WHEN stays AND c = 'a' THEN {_more("u", "extra", "K")} END,
          CASE WHEN stays THEN {_more("u", "extra + 3", "R")} END)
      FROM (SELECT * EXCLUDE (a0), least(a0, {_more("u", "3", "I")}) AS a FROM (
        SELECT w.conv_id, r.i, r.c, r.fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END AS extra,
          n, s, least(u, {_more("least(n, s, a)", "3", "I")}) AS u, a AS a0 FROM w
        JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))),
    e AS (SELECT w.conv_id, least(n, a, {_more("u", "3", "I")}, {_more("s", "6", "II")}) AS best
      FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = g.size),
    p AS (SELECT conv_id, CAST(substr(best, 1, 6) AS BIGINT) AS cost, substr(best, 7) AS audit FROM e),
    l AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS pos FROM p WHERE audit <> ''),
    m AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS i FROM l),
    k AS (SELECT m.*, r.role, r.text, row_number() OVER (PARTITION BY m.conv_id ORDER BY pos) AS place,
      first_value(edit = 'K' AND r.c = 's') OVER (PARTITION BY m.conv_id ORDER BY pos) AS led
      FROM m LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.i = m.i AND edit <> 'I' WHERE edit <> 'D'),
    t AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user'
      ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS digest FROM k GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
      coalesce(digest, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLES = {
    "op13_conversation_repair": _REPAIR,
    "op2_exact_dedup": rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
          regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS content FROM documents),
        w AS (SELECT *, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS place,
          count(*) OVER (PARTITION BY content) AS group_size FROM t
          WINDOW g AS (PARTITION BY content ORDER BY length(text) DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM w""",
    "op3_exact_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
          FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20""",
    "op4_mixing": r"""WITH d AS (SELECT doc_id, source,
          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
          (CAST('0x' || substr(md5('mix-1' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13) AS BIGINT)
            + 0.5e0) / 4503599627370496e0 AS u FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
          row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
        w AS (SELECT *, [3e0, 1e0, 2e0][(place - 1) % 3 + 1] AS weight, source_size * 2e0 AS cap FROM s),
        l AS (SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () * 1.5e0
            - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
            / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
        f AS (SELECT *, arg_min(CASE WHEN level * weight <= cap THEN level END, [cap / weight, place])
            FILTER (WHERE level * weight <= cap) OVER () AS chosen FROM l),
        t AS (SELECT source, source_size, least(cap, coalesce(chosen * weight, cap)) AS target FROM f),
        c AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS copies FROM t),
        p AS (SELECT *, floor(copies) AS whole, copies - floor(copies) AS part,
          target - floor(copies) * source_size AS need FROM c),
        k AS (SELECT d.doc_id, d.size, p.*, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS rank
          FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
        o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id) AS after,
          sum(size) OVER (PARTITION BY source, rank, doc_id) AS unit FROM k)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST((whole
          + CASE WHEN part > 0 AND need > 0 AND after - unit / 2e0 <= need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM o""",
    "op5_chat_formatting": r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, length(regexp_replace(text,
          '([<\[])(\^*)(\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\])', '\1^\2\3', 'g')) AS inner_chars FROM t)
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(length('<|turn|>') + length(role) + 1 + inner_chars + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _OPERATORS}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)

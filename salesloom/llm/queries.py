"""The queries that apply the operators of this folder to the whole test tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    bpe,
    conversation_repair,
    embedding_pairs,
    embedding_whitening,
    exact_dedup,
    html_wrapper,
    language_id,
    ngram_join,
    packing,
    quality_rules,
    secret_scan,
    toxicity,
    warc,
)
from salesloom.llm.shared import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, tables: str, oracle: str | None = None):
    """Register ``job(*tables)`` under ``name``."""

    def register(job: Callable[..., DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: job(
            *(ship(spark).read.parquet(f"{sf_dir}/{table}.parquet") for table in tables.split())
        )
        if oracle is not None:
            ORACLES[name] = oracle
        return job

    return register


@_query(
    "op5_exact_dedup",
    "documents",
    r"""
    WITH squeezed AS (
        SELECT doc_id, length(coalesce(text, '')) AS n_chars,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents),
    grouped AS (
        SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id
        FROM squeezed)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped""",
)
def op5_exact_dedup(documents: DataFrame) -> DataFrame:
    return exact_dedup.dedup(documents)


def _id_hash(parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts


@_query("op1_html_wrapper", "pages")
def op1_html_wrapper(pages: DataFrame) -> DataFrame:
    return html_wrapper.extract(pages)


@_query("op2_packing", "documents")
def op2_packing(documents: DataFrame) -> DataFrame:
    return packing.pack(documents, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@_query("op3_bpe", "documents")
def op3_bpe(documents: DataFrame) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encode(documents, ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@_query("op4_warc", "pages")
def op4_warc(pages: DataFrame) -> DataFrame:
    records = warc.read_archives(pages.sparkSession, warc.write_archives(pages))
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@_query("op6_secret_scan", "documents")
def op6_secret_scan(documents: DataFrame) -> DataFrame:
    def of_kind(name: str) -> Column:
        number = secret_scan.KINDS.index(name)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    return secret_scan.scan(documents).select(
        "doc_id",
        *(of_kind(name).alias(f"n_{name}") for name in ("assign", "access", "hex")),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@_query("op7_ngram_join", "documents")
def op7_ngram_join(documents: DataFrame) -> DataFrame:
    return ngram_join.join(documents, words=3, numerator=90, denominator=100)


@_query("op8_toxicity", "documents labels")
def op8_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = toxicity.train(documents, labels, _id_hash(5) != 0)
    return toxicity.scored(documents.select("doc_id", "text"), model).select(
        "doc_id",
        (_id_hash(5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@_query("op9_embedding_pairs", "embeddings")
def op9_embedding_pairs(embeddings: DataFrame) -> DataFrame:
    return embedding_pairs.near_duplicates(embeddings, threshold=0.98)


@_query("op10_language_id", "documents")
def op10_language_id(documents: DataFrame) -> DataFrame:
    samples = language_id.learn(documents, _id_hash(3) != 1)
    found = language_id.identified(documents, samples)
    return found.select("doc_id", (_id_hash(3) == 1).alias("held_out"), "lang_pred", "score")


@_query("op11_quality_rules", "documents labels")
def op11_quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = quality_rules.train(documents, labels, _id_hash(4) != 2)
    return quality_rules.scored(documents, model).select(
        "doc_id",
        (_id_hash(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@_query("op12_embedding_whitening", "embeddings")
def op12_embedding_whitening(embeddings: DataFrame) -> DataFrame:
    rows = embedding_whitening.encoded(embedding_whitening.whole_numbers(embeddings))
    found = embedding_whitening.whitened(rows, embedding_whitening.fit(rows))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)")).withColumnRenamed("id", "vec_id")


@_query(
    "op13_conversation_repair",
    "conversations",
    r"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
        FROM conversations),
    places AS (
        SELECT place, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(place, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))) % 20 AS fault
        FROM (SELECT DISTINCT place FROM keyed)),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
               CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM keyed JOIN places USING (place) WHERE fault <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
               lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS before
        FROM damaged),
    faulty AS (
        SELECT *, role[1] AS own, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
               WHEN again THEN 'duplicate'
               WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
        FROM numbered),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before[1] || own NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
        FROM faulty GROUP BY conv_id),
    -- e, s, u, a: the least (cost, audit, repaired lines) whose last role is none, system, user, assistant
    states AS (
        SELECT conv_id, n, 0::BIGINT AS i, {'c': 0::BIGINT, 'w': '', 'r': []::VARCHAR[]} AS e,
               NULL::STRUCT(c BIGINT, w VARCHAR, r VARCHAR[]) AS s, NULL::STRUCT(c BIGINT, w VARCHAR, r VARCHAR[]) AS u,
               NULL::STRUCT(c BIGINT, w VARCHAR, r VARCHAR[]) AS a
        FROM counts
        UNION ALL
        SELECT conv_id, n, i,
            {'c': e.c + 4, 'w': e.w || 'D', 'r': e.r},
            list_sort(list_filter([{'c': s.c + 4, 'w': s.w || 'D', 'r': s.r},
                CASE WHEN stays AND own = 's' THEN {'c': e.c + t, 'w': e.w || 'K', 'r': [line]} END], lambda x: x.c IS NOT NULL))[1],
            list_sort(list_filter([{'c': u2.c + 4, 'w': u2.w || 'D', 'r': u2.r},
                CASE WHEN stays AND own = 'u' THEN {'c': p.c + t, 'w': p.w || 'K', 'r': list_append(p.r, line)} END,
                CASE WHEN stays THEN {'c': p.c + t + 3, 'w': p.w || 'R', 'r': list_append(p.r, 'user:' || text)} END], lambda x: x.c IS NOT NULL))[1],
            list_sort(list_filter([{'c': a1.c + 4, 'w': a1.w || 'D', 'r': a1.r},
                CASE WHEN stays AND own = 'a' THEN {'c': u2.c + t, 'w': u2.w || 'K', 'r': list_append(u2.r, line)} END,
                CASE WHEN stays THEN {'c': u2.c + t + 3, 'w': u2.w || 'R', 'r': list_append(u2.r, 'assistant:' || text)} END], lambda x: x.c IS NOT NULL))[1]
        FROM (
            SELECT *, list_sort(list_filter([u1, {'c': a1.c + 3, 'w': a1.w || 'I', 'r': list_append(a1.r, 'user:')}], lambda x: x.c IS NOT NULL))[1] AS u2,
                list_sort(list_filter([e, s, a1], lambda x: x.c IS NOT NULL))[1] AS p
            FROM (
                SELECT *, list_sort(list_filter([a, {'c': u1.c + 3, 'w': u1.w || 'I', 'r': list_append(u1.r, 'assistant:')}], lambda x: x.c IS NOT NULL))[1] AS a1
                FROM (
                    SELECT states.conv_id, n, faulty.i, e, s, u, a, own, text, role || ':' || text AS line,
                        fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t,
                        list_sort(list_filter([u, {'c': e.c + 3, 'w': e.w || 'I', 'r': list_append(e.r, 'user:')},
                            {'c': s.c + 3, 'w': s.w || 'I', 'r': list_append(s.r, 'user:')},
                            {'c': a.c + 3, 'w': a.w || 'I', 'r': list_append(a.r, 'user:')}], lambda x: x.c IS NOT NULL))[1] AS u1
                    FROM states JOIN faulty ON states.conv_id IS NOT DISTINCT FROM faulty.conv_id AND faulty.i = states.i + 1)))),
    closed AS (
        SELECT conv_id, list_sort(list_filter([e, a, {'c': u.c + 3, 'w': u.w || 'I', 'r': list_append(u.r, 'assistant:')},
            {'c': s.c + 6, 'w': s.w || 'II', 'r': s.r || ['user:', 'assistant:']}], lambda x: x.c IS NOT NULL))[1] AS best
        FROM states WHERE i = n)
    SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
           coalesce(best.w, '') AS audit, sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN closed ON closed.conv_id IS NOT DISTINCT FROM ids.conv_id""",
)
def op13_conversation_repair(conversations: DataFrame) -> DataFrame:
    return conversation_repair.summaries(conversation_repair.damaged(conversations), ids=conversations)

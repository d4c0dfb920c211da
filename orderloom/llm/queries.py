"""The registered queries of the document operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe, decontaminate, exact_dedup, hard_negatives, language, line_templates, ngram_join,
    quality_limits, revisits, secret_scan, sharding, toxicity, vector_codes,
)

SHARDS = 8
#: Vocabulary of op5; the operator takes any file of its kind.
WORDS_49K = public_tokenizers.path("word_bpe_49k.json")
#: Pieces of op10; the operator takes any rank file.
MULTI_50K = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"), digest_all=True)
    return groups.withColumnRenamed("digest", "text_sha256")


def op2_nonnegative_pu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held = language.held_out("doc_id", 5, 0)
    labels = table(spark, folder, "labels").where("toxic IS NOT NULL").where(~held)
    prior = labels.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    model = toxicity.fit(docs.where(~held), labels.where("toxic = 1"), prior or 0.0)
    return toxicity.scored(docs, model).withColumn("held_out", held).select(
        "doc_id", "held_out", "score", "predicted"
    )


def crawl_records(pages: DataFrame) -> DataFrame:
    """Two records per page: its full response, and a later fetch answered "not modified".

    Of the later fetches some state the etag, some the time of change, some only the digest, and
    some a validator that is out of date.
    """
    common = pages.selectExpr(
        "page_id", "url", "md5(coalesce(html, '')) AS body",
        "octet_length(coalesce(html, '')) AS size",
    )
    full = common.selectExpr(
        "page_id * 2 AS record_id", "url", "page_id AS at", "200 AS status",
        """map('etag', concat('"', body, '"'), 'last-modified', string(page_id),
               'date', string(page_id), 'cache-control', 'max-age=60',
               'content-type', 'text/html', 'content-length', string(size)) AS headers""",
        "body AS digest",
    )
    again = common.selectExpr(
        "page_id * 2 + 1 AS record_id", "url", "page_id + 1 + page_id * 37 % 9973 AS at",
        "304 AS status",
        """map_concat(
               map('date', string(page_id + 1 + page_id * 37 % 9973), 'content-length', '0',
                   'cache-control', concat('max-age=', page_id % 100)),
               CASE page_id % 5 WHEN 0 THEN map('etag', concat('W/"', body, '"'))
                    WHEN 1 THEN map('etag', concat('"', body, '"'))
                    WHEN 2 THEN map('last-modified', string(page_id))
                    WHEN 3 THEN map('etag', '"older"') ELSE map() END) AS headers""",
        "if(page_id % 5 = 4 AND page_id % 2 = 0, body, NULL) AS digest",
    )
    return full.unionByName(again)


def op3_revisit_resolution(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(crawl_records(table(spark, folder, "pages")))
    spelled = F.array_join(F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])
    ), "; ")
    return found.withColumn("headers", spelled)


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Three quarters of the documents, by a hash of their id, are an earlier delivery whose ledger
    is at hand when all of them are scanned."""
    docs = table(spark, folder, "documents")
    _, ledger = secret_scan.scan(docs.where(~language.held_out("doc_id", 4, 0)))
    found, _ = secret_scan.scan(docs, ledger)
    spelled = secret_scan.span_columns(found)
    return spelled.select(
        "doc_id", *[f"n_{kind}" for kind, *_ in secret_scan.RULES],
        F.sha2("spans", 256).alias("base_sha256"), "spans",
    )


def op5_bpe_prefix_encoding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encoded(docs, WORDS_49K))


def op6_adaptive_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"))


def op7_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_templates.without_recurring_lines(docs)


def op8_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.with_hits(docs, table(spark, folder, "benchmark"), keep_text=False)
    return found.select(
        "doc_id", (F.size("hits") > 0).alias("contaminated"),
        F.col("hits.item_id").alias("item_ids"), F.array_min("hits.distance").alias("least_distance"),
    )


def op9_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), sharding.even_tree(SHARDS))


def language_model(docs: DataFrame) -> language.Model:
    """Learns from two thirds of the documents, by a hash of their id."""
    learned = docs.where(~language.held_out("doc_id", 3, 1))
    return language.fit(learned, language.read_pieces(MULTI_50K))


def op10_piece_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    known = language.identified(
        docs.select("doc_id", "text"), language_model(docs), keep_text=False
    )
    return known.select(
        "doc_id", language.held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score"
    )


def op11_vertical_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; every seventh label is shifted."""
    rows = table(spark, folder, "embeddings").withColumn(
        "label", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    )
    return hard_negatives.hard_negatives(rows)


def op12_walsh_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = vector_codes.compressed(table(spark, folder, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256"
    )


def op13_certified_quality(spark: SparkSession, folder: str) -> DataFrame:
    verdicts, _ = quality_limits.judged(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_exact_dedup, op2_nonnegative_pu_toxicity, op3_revisit_resolution,
             op4_secret_scan, op5_bpe_prefix_encoding, op6_adaptive_prefix_join,
             op7_line_templates, op8_benchmark_passages, op9_hash_tree_shards,
             op10_piece_language, op11_vertical_hard_negatives, op12_walsh_vector_codes,
             op13_certified_quality]
    return {f.__name__: f for f in found}

"""The numbered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import fim, leaks, licenses, merkle, mixing, neardup, packing, pii, quality, rindex, sql, substring, tokens, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visits(pages: DataFrame) -> DataFrame:
    """Archive records of four visits to every page: full responses, revisits that agree and revisits that do not."""
    visit, page = F.col("visit"), F.col("page_id")
    body = F.coalesce("html", F.lit(""))
    tag = F.substring(F.md5(body), 1, 16)
    kind = F.when(visit == 2, page % 3)
    full = (visit == 0) | (kind == 2)
    headers = {
        "ETag": F.when(visit == 1, F.concat(F.lit('W/"'), tag, F.lit('"')))
        .when(kind == 0, F.lit('"stale"'))
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, F.concat(F.lit('"'), F.reverse(tag), F.lit('"')))
        .otherwise(F.concat(F.lit('"'), tag, F.lit('"'))),
        "Last-Modified": F.when(full | (kind == 1), F.concat(F.lit("day "), (page % 1000).cast("string"))),
        "Date": F.concat(F.lit("visit "), visit.cast("string")),
        "Cache-Control": F.when(visit != 2, F.concat(F.lit("max-age="), (visit * 60).cast("string"))),
        "Content-Type": F.when(full, F.lit("text/html")).otherwise(F.lit("text/plain")),
        "Content-Length": F.when(full, F.length(body).cast("string")),
    }
    named = F.map_from_entries(
        F.filter(F.array(*[F.struct(F.lit(k), v.alias("v")) for k, v in headers.items()]), lambda e: e["v"].isNotNull())
    )
    return pages.withColumn("visit", F.explode(F.array(*map(F.lit, range(4))))).select(
        (page * 4 + visit).alias("record_id"),
        "url",
        (page + visit * 1000).alias("fetched_at"),
        F.when(full, 200).otherwise(304).alias("status"),
        named.alias("headers"),
        F.when(full, F.md5(F.concat(body, visit.cast("string")))).alias("digest"),
    )


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(visits(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return resolved.withColumn("headers", F.array_join(lines, "\n"))


def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.replicate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "text", "source", "copy", "n_copies", "shuffle_key")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op4_rindex_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rindex.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_countmin_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_semi_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))

    def told(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(told("base"), 256).alias("base_sha256"), told("spans").alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judge(docs).select("doc_id", *counts, "base_failed", "kept")


def op9_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = leaks.question_and_answer(table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return leaks.find_leaks(table(spark, sf_dir, "documents"), items)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"))


def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", ascii_uppercase, ascii_lowercase))
    proofs = merkle.prove(table(spark, sf_dir, "documents"), {"text": F.coalesce(tampered, "text")})
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_fim_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents"))
    restored = F.sha2(fim.restore(F.col("output"), F.col("form")), 256)
    counts = ("doc_id", "n", "form", "prefix_chars", "middle_chars")
    return cut.select(*counts, F.sha2("output", 256).alias("output_sha256"), restored.alias("restored_sha256"))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


QUERIES = {
    "op1_warc_revisits": (op1_warc_revisits, sql.WARC_REVISITS),
    "op2_poisson_mix": (op2_poisson_mix, sql.POISSON_MIX),
    "op3_license_scan": (op3_license_scan, None),
    "op4_rindex_dedup": (op4_rindex_dedup, sql.LONG_MATCHES),
    "op5_countmin_substrings": (op5_countmin_substrings, sql.SUBSTRINGS),
    "op6_token_counts": (op6_token_counts, None),
    "op7_semi_crf_pii": (op7_semi_crf_pii, None),
    "op8_quality_rules": (op8_quality_rules, sql.QUALITY_RULES),
    "op9_bm25_decontamination": (op9_bm25_decontamination, None),
    "op10_near_duplicates": (op10_near_duplicates, sql.NEAR_DUPLICATES),
    "op11_merkle_climb": (op11_merkle_climb, sql.MERKLE),
    "op12_fim_rank_index": (op12_fim_rank_index, sql.FILL_IN_MIDDLE),
    "op13_vector_packing": (op13_vector_packing, None),
}

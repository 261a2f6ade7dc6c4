"""Registered queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelake.llm import (
    conversations, decontamination, fill_in_middle, kneser_ney, language_id, language_model, licences, lsh_forest, packing,
    quality_rules, suffix_dedup, url_filter, warc,
)
from placelake.llm.common import Scratch, keys_of, plain_id, table, text_of


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "op2")
    left = suffix_dedup.shortened(docs, scratch)
    left = scratch.write(left.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept", "n_bytes"), "left")
    text = text_of("text")
    rows = keys_of(docs, "doc_id", "text", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"))
    none = F.lit(0).cast("long")
    return rows.join(left, ["_id", "_h"], "left").select(
        plain_id().alias("doc_id"), "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return kneser_ney.classify(table(spark, sf_dir, "documents"), trusted, Scratch(spark, "op3"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, Scratch(spark, "op4"))
    rows = keys_of(docs, "doc_id", "text", quality_rules.host_of("source").alias("host"))
    return rows.join(judged, ["_id", "_h", "host"]).select(
        plain_id().alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_cut_words")


def op5_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), Scratch(spark, "op5"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", F.array_join("identifiers", ",").alias("identifiers"),
                        F.array_join("licences", ",").alias("licences"))


def op7_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op7")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(warc.records(pages), f"{scratch.root}/archives")
    files = warc.archive_files(spark, f"{scratch.root}/archives")
    blocks = scratch.write(warc.index_blocks(warc.capture_entries(files)), "index")
    found = warc.read_ranges(warc.find(blocks, pages))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lsh_forest.near_duplicates(docs, Scratch(spark, "op8"), shingle=3, percent=85, trees=16)
    rows = keys_of(docs, "doc_id", "text").join(found, ["_id", "_h"])
    return rows.select(plain_id().alias("doc_id"), "n_shingles", plain_id("component").alias("component_id"),
                       (F.col("_id") == F.col("component")).alias("kept"))


def op9_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))


def op10_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark))
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), model)


def op11_streamed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damaged(turns), Scratch(spark, "op11"), ids=turns)
    return conversations.digests(repaired).select(
        conversations.plain_conv(dict(turns.dtypes)["conv_id"]).alias("conv_id"), "gaps", "blank", "duplicate", "truncated",
        "illegal", "cost", "audit", "repaired_sha256")


def op12_mixture_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = language_id.fit_languages(docs.filter(~held_out))
    found = language_id.identify(docs, model, mark=held_out)
    first = F.try_element_at("languages", F.lit(1))
    return found.select(
        plain_id().alias("doc_id"), F.col("_mark").alias("held_out"), F.coalesce(first, F.lit(language_id.UNKNOWN)).alias("lang_pred"),
        F.coalesce(F.try_element_at("shares", F.lit(1)), F.lit(0.0)).alias("score"), F.array_join("languages", ",").alias("languages"))


def op13_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        plain_id().alias("doc_id"), "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(again.cast("binary"), 256).alias("restored_sha256"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_column_suffixes": op2_column_suffixes,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_line_frequency": op4_line_frequency,
    "op5_certified_packing": op5_certified_packing,
    "op6_licence_rules": op6_licence_rules,
    "op7_capture_index": op7_capture_index,
    "op8_lsh_forest": op8_lsh_forest,
    "op9_log_bilinear": op9_log_bilinear,
    "op10_url_regression": op10_url_regression,
    "op11_streamed_repair": op11_streamed_repair,
    "op12_mixture_languages": op12_mixture_languages,
    "op13_rank_index": op13_rank_index,
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _licence_sql() -> str:
    case = " ".join(f"WHEN '{s}' THEN '{i}'" for s, i in licences.SENTENCES.items())
    found = ", ".join(f"CASE WHEN contains(line, '/{'/'.join(seq)}/') THEN '{name}' END" for name, seq in licences.RULES)
    return rf"""
WITH split AS (SELECT doc_id, list_filter(list_transform(
    regexp_split_to_array(lower(coalesce(text, '')), '[.!?]+\s+|[.!?]+$|\n+'),
    lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS sentences FROM documents),
named AS (SELECT doc_id, len(sentences) AS n_sentences,
    list_filter(list_transform(sentences, lambda s: CASE s {case} END), lambda i: i IS NOT NULL) AS ids FROM split),
lines AS (SELECT *, '/' || coalesce(array_to_string(ids, '/'), '') || '/' AS line FROM named)
SELECT doc_id, n_sentences, coalesce(array_to_string(ids, ','), '') AS identifiers,
    coalesce(array_to_string(list_sort(list_distinct(list_filter([{found}], lambda x: x IS NOT NULL))), ','), '') AS licences FROM lines"""


ORACLE_SQL: dict[str, str] = {
    "op6_licence_rules": _licence_sql(),
    "op7_capture_index": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
groups AS (SELECT h, max(page_id) AS target FROM p WHERE strlen(h) >= 1000 GROUP BY h),
judged AS (SELECT page_id, p.h, target, target IS NOT NULL AND page_id IS DISTINCT FROM target AS again FROM p LEFT JOIN groups ON p.h = groups.h)
SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN target END AS refers_to FROM judged""",
    "op8_lsh_forest": f"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split),
rows AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sets x ON a = x.doc_id JOIN sets y ON b = y.doc_id WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
SELECT sets.doc_id, len(s) AS n_shingles, c.component_id, sets.doc_id = c.component_id AS kept
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) c ON sets.doc_id = c.doc_id""",
    "op13_rank_index": """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM texts),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, '<P>' || substring(t, 1, a) AS p, '<M>' || substring(t, a + 1, b - a) AS m, '<S>' || substring(t, b + 1) AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts""",
}

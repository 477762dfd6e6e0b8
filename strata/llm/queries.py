"""The subpackage's queries over the driver's tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import (chat_format, decontaminate, divergence, html_extract, jaccard_join, language_id, merkle, mixing,
                        pitman_yor, quality_rules, sentencepieces, substring_dedup, toxicity)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def op7_quality_rules(spark, sf):
    trusted = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    m = quality_rules.measure(table(spark, sf, "documents").select("doc_id", "text"), trusted)
    return m.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", F.round("llr", 6).alias("llr"))


def documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def op1_jaccard_join(spark, sf):
    return jaccard_join.classes(documents(spark, sf), k=4, percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op2_pitman_yor(spark, sf):
    return pitman_yor.score(documents(spark, sf), language_id.remainder("doc_id", 7) == 2)


def op3_sentencepieces(spark, sf):
    return sentencepieces.digests(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model"))


def op4_toxicity(spark, sf):
    docs = documents(spark, sf)
    held = F.coalesce(language_id.remainder("doc_id", 3) == 1, F.lit(False))
    labels = table(spark, sf, "labels").select("doc_id", "toxic").where(~held)
    out = toxicity.predict(docs, toxicity.train(docs, labels))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def op5_decontaminate(spark, sf):
    return decontaminate.contaminated(documents(spark, sf), table(spark, sf, "benchmark"))


def op6_substring_dedup(spark, sf):
    return substring_dedup.digests(documents(spark, sf))


def op8_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(language_id.remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.train(docs.where(~held))
    out = language_id.predict(docs, model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_html_extract(spark, sf):
    return html_extract.main_text(table(spark, sf, "pages"))


def op10_chat_format(spark, sf):
    return chat_format.render(table(spark, sf, "conversations"))


def op11_source_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"))


def op12_source_mixing(spark, sf):
    return mixing.digests(table(spark, sf, "documents"))


def op13_merkle_manifest(spark, sf):
    return merkle.digests(table(spark, sf, "documents"))


def queries() -> dict:
    return {"op1_jaccard_join": op1_jaccard_join, "op2_pitman_yor": op2_pitman_yor,
            "op3_sentencepieces": op3_sentencepieces, "op4_toxicity": op4_toxicity,
            "op5_decontaminate": op5_decontaminate,
            "op6_substring_dedup": op6_substring_dedup, "op7_quality_rules": op7_quality_rules,
            "op8_language_id": op8_language_id, "op9_html_extract": op9_html_extract,
            "op10_chat_format": op10_chat_format, "op11_source_divergence": op11_source_divergence,
            "op12_source_mixing": op12_source_mixing, "op13_merkle_manifest": op13_merkle_manifest,
            "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return {"op1_jaccard_join": jaccard_join.ORACLE, "op6_substring_dedup": substring_dedup.ORACLE,
            "op10_chat_format": chat_format.ORACLE, "op11_source_divergence": divergence.ORACLE,
            "op13_merkle_manifest": merkle.ORACLE}

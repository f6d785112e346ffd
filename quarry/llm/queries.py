"""The operators' queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (chat_format, conversation_repair, decontamination, html_extract, language_id, lm_scoring, mixing, ngram_join,
                        quality_rules, source_divergence, token_store, url_filters, warc)
from quarry.llm.common import scratch, ship, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.line_first_rules(table(spark, sf_dir, "documents"), with_text=False)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_format.digests(chat_format.format_conversations(turns))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"), html_extract.train(spark))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")
    return url_filters.url_filter(table(spark, sf_dir, "pages"), rules)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out(F.col("doc_id"))
    prototypes = language_id.learn(docs.filter(~out))
    return language_id.predict(docs, prototypes).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.read_archives(spark, path, with_payload=False)
    return found.filter(F.col("kind") == "record").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit_conversations(table(spark, sf_dir, "conversations"))


#: The id that the query puts behind each document.
END_ID = 2


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "tokens")
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, END_ID)
    return token_store.read_documents(spark, path)


def _shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(ship(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _shipping(query) for name, query in {
    "op1_quality_rules": op1_quality_rules,
    "op2_chat_format": op2_chat_format,
    "op3_html_extract": op3_html_extract,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_ngram_join": op7_ngram_join,
    "op8_url_filters": op8_url_filters,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_ids": op13_token_ids,
}.items()}

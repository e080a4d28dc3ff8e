"""The registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.llm import (
    chat_format,
    conversation_repair,
    decontaminate,
    jaccard_rtree,
    language_id,
    line_quality,
    line_templates,
    merkle,
    mixture,
    ppm,
    sentence_pieces,
    token_files,
    warc,
)
from stepforge.storage import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_line_templates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_index(token_files.write(table(spark, sf_dir, "documents"), tokenizer_path()))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id"), 3, 1))
    model = language_id.learn(docs.where("NOT held_out AND doc_id IS NOT NULL"))
    return language_id.predict(docs, model, ("doc_id", "held_out"))


@query("op4_ppm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id"), 7, 2))
    return ppm.score(docs, ppm.learn(docs.where("NOT held_out AND doc_id IS NOT NULL")))


@query("op5_chat_format", chat_format.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    written = materialize(chat_format.format_turns(turns.unionByName(chat_format.injected(spark))), "conversations")
    return chat_format.digests(written)


@query("op6_warc", warc.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages")))


@query("op7_mixture", mixture.sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.choose(table(spark, sf_dir, "documents")).drop("text_key")


@query("op8_jaccard_rtree")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_rtree.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op9_line_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words",
    )


@query("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "end_word", "n_seeds")


@query("op11_merkle_manifest", merkle.sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair", conversation_repair.sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(turns), turns)


@query("op13_sentence_pieces")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    return sentence_pieces.digests(sentence_pieces.decode(sentence_pieces.encode(table(spark, sf_dir, "documents"), path), path))

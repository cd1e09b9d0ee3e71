"""Registered queries opN_<name>: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, ball_search, bpe, chat, conversation_repair, decontaminate, html_text, jaccard, langid,
               lattice, line_dedup, token_files, warc)
from .common import crc_fold, shared_path, table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    events = chat.conversation_events(rows.unionByName(probe))
    return chat.digests(chat.render(chat.reconstruct(events)))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), k=20, is_query=F.col("vec_id") % 20 == 0)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = token_files.library_encoder(spark, public_tokenizers.path("word_bpe_49k.json"))
    path = token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"),
                             shared_path(spark, "token-files"), make, end_id=2, n_ids=49408)
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_fold("doc_id", 4) == 2
    model = langid.train(docs.where(~held))
    found = langid.label(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = lattice.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    held = crc_fold("doc_id", 7) == 2
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", held.alias("held_out"), (~held).alias("learn"))
    return lattice.score(docs, pieces, ["doc_id", "held_out"])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_audits(table(spark, sf_dir, "conversations"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), ["doc_id"], min_docs=10, min_chars=1)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_ball_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_ann, op3_token_files, op4_html_text, op5_jaccard_join, op6_byte_bpe, op7_decontaminate, op8_language,
    op9_lattice, op10_warc, op11_conversation_repair, op12_line_dedup,
    op13_ball_search)}

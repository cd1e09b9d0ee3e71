"""Corpus pipeline: documents -> language ID -> near-duplicate removal -> decontamination -> token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet in the shared folder and reads it back, so a lost executor costs one stage at most. All but the
last stage return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm import bpe, decontaminate, jaccard, langid
from kgspark.llm.common import table, written

#: A document is rejected if it has no language, or if less than this is sure of it. Mixed and short texts
#: stay; see ``langid`` for the score.
LEAST_SCORE = 0.2
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from all labelled rows.

    Null or empty texts and texts without letters have no language and go; a null ``lang`` is not learned from, and
    without any labelled row nothing stays; repeated rows stay as often as they occur; an empty table stays empty;
    other columns are handed on, whatever their names.
    """
    model = langid.train(docs)
    others = [c for c in docs.columns if c != "text"]
    found = langid.label(docs.select(F.struct(*others).alias("others"), "text"), model, ["others", "text"])
    sure = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return sure.select(*[F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id.

    Of rows that repeat id and text one stays; a row without an id stays only if its group has none with one; texts
    without words (null and empty ones too) are near none and all stay; an empty table stays empty; other columns
    are handed on, whatever their names.
    """
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by items of ``benchmark``.

    Null and empty texts have no words and stay; null items match nothing; without items all rows stay; repeated rows
    are judged alike; an empty table stays empty; other columns are handed on, whatever their names.
    """
    rows = docs.select(F.struct(*docs.columns).alias("whole"), "text")
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), ["whole"])
    return found.where(~F.col("contaminated")).select(*[F.col("whole")[c].alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text.

    A null text is encoded as the empty one (no ids); repeated rows and null ids are rows of their own; an empty table
    stays empty; columns other than ``doc_id`` and ``text`` are left out.
    """
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    both = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("encoding", encoding)]

#: SQL cannot express the first and last stage; see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

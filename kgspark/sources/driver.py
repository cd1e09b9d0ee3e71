"""Source scans (S1) over the given parquet tables.

A source is any table with ``data_id`` and ``full_conversation``; the two readers
below derive it from the driver's ``documents`` and ``conversations`` tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents(doc_id, text) -> (data_id, full_conversation); only two columns scanned."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("data_id"), F.col("text").alias("full_conversation"))


def source_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> one transcript per conversation.

    Lines are ``role: text`` in turn order, joined by newlines. A conversation is a
    single document, so gathering its turns is bounded by the document itself.
    """
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    line = F.concat(F.coalesce(F.col("role"), F.lit("")), F.lit(": "),
                    F.coalesce(F.col("text"), F.lit("")))
    return (conv.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("turn"), line.alias("line"))))
                 .alias("turns"))
            .select(F.col("conv_id").alias("data_id"),
                    F.array_join(F.transform("turns", lambda t: t["line"]), "\n")
                    .alias("full_conversation")))


def read_source(spark: SparkSession, kind: str, path: str) -> DataFrame:
    if kind == "documents":
        return source_from_documents(spark, path)
    if kind == "conversations":
        return source_from_conversations(spark, path)
    return spark.read.parquet(path).select("data_id", "full_conversation")

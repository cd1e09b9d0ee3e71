"""Step 1: documents from a source table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, truthy_text


def project_documents(source: DataFrame) -> DataFrame:
    """Source row -> (id, title, raw_content) with the reference's defaults."""
    id_type = source.schema["data_id"].dataType
    text = F.coalesce(F.col("full_conversation").cast("string"), F.lit(""))
    return source.select(
        content_hash(text).alias("id"),
        truthy_text("data_id", id_type).alias("title"),
        text.alias("raw_content"),
    )


def dedup_documents(source: DataFrame) -> DataFrame:
    """A1: exact dedup by content hash; the smallest title wins (Q1).

    One hash aggregation: the partial aggregate collapses copies inside each map
    task, so even a text repeated in a third of all rows ships one row per task.
    """
    docs = project_documents(source)
    return docs.groupBy("id").agg(
        F.min("title").alias("title"),
        F.any_value("raw_content").alias("raw_content"),
    )

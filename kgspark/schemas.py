"""Explicit table schemas (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
ARR_S = T.ArrayType(S, containsNull=True)
VEC = T.ArrayType(T.FloatType(), containsNull=True)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


SOURCE = T.StructType([_f("data_id", S), _f("full_conversation", S)])

DOCUMENTS = T.StructType([_f("id", S, False), _f("title", S), _f("raw_content", S)])

REQUESTS = lambda key: T.StructType([_f(key, S), _f("request", S)])
RESULTS = lambda key: T.StructType([_f(key, S), _f("response", S), _f("status", S)])

ENTITIES_RAW = T.StructType([
    _f("id", S, False), _f("title", S), _f("type", S), _f("description", S),
    _f("document_ids", ARR_S),
])

RELATIONSHIPS_RAW = T.StructType([
    _f("id", S, False), _f("source", S), _f("target", S), _f("description", S),
    _f("weight", D), _f("document_ids", ARR_S),
])

ENTITIES = T.StructType(list(ENTITIES_RAW.fields) + [_f("human_readable_id", L), _f("degree", L)])

RELATIONSHIPS = T.StructType(list(RELATIONSHIPS_RAW.fields) + [
    _f("source_entity_id", S), _f("target_entity_id", S), _f("human_readable_id", L),
])

COMMUNITIES = T.StructType([
    _f("id", S, False), _f("level", L), _f("entity_ids", ARR_S), _f("relationship_ids", ARR_S),
    _f("document_ids", ARR_S), _f("parent_community_id", S), _f("child_community_ids", ARR_S),
])

REPORT_FIELDS = [
    _f("title", S), _f("summary", S), _f("full_content", S), _f("rating", D),
    _f("rating_explanation", S), _f("findings", S),
]
COMMUNITY_REPORTS = T.StructType(list(COMMUNITIES.fields) + REPORT_FIELDS)

# Model payload shapes. Numbers are read as STRING and cast leniently.
EXTRACTION_PAYLOAD = T.StructType([
    _f("entities", T.ArrayType(T.StructType([
        _f("name", S), _f("type", S), _f("description", S)]))),
    _f("relationships", T.ArrayType(T.StructType([
        _f("source", S), _f("target", S), _f("description", S), _f("weight", S)]))),
])
SUMMARY_PAYLOAD = T.StructType([_f("description", S)])
REPORT_PAYLOAD = T.StructType([
    _f("title", S), _f("summary", S), _f("rating", S), _f("rating_explanation", S),
    _f("findings", T.ArrayType(T.StructType([_f("summary", S), _f("explanation", S)]))),
])

# Sink tables (S13-S16): column order is the upsert column list.
SINK_KEYS = {"documents": "id", "entities": "id", "relationships": "id", "communities": "id"}


def sink_documents(dim: int) -> T.StructType:
    return T.StructType([
        _f("id", S, False), _f("title", S), _f("raw_content", S), _f("entity_ids", ARR_S),
        _f("relationship_ids", ARR_S), _f("content_embedding", VEC),
    ])


def sink_entities(dim: int) -> T.StructType:
    return T.StructType([
        _f("id", S, False), _f("title", S), _f("type", S), _f("description", S),
        _f("human_readable_id", L), _f("degree", L), _f("document_ids", ARR_S),
        _f("community_ids", ARR_S), _f("description_embedding", VEC),
    ])


def sink_relationships(dim: int) -> T.StructType:
    return T.StructType([
        _f("id", S, False), _f("source_entity_id", S, False), _f("target_entity_id", S, False),
        _f("description", S), _f("weight", D), _f("human_readable_id", L),
        _f("document_ids", ARR_S),
    ])


def sink_communities(dim: int) -> T.StructType:
    return T.StructType([
        _f("id", S, False), _f("level", L), _f("title", S), _f("summary", S),
        _f("full_content", S), _f("rating", D), _f("rating_explanation", S),
        _f("entity_ids", ARR_S), _f("relationship_ids", ARR_S), _f("document_ids", ARR_S),
        _f("parent_community_id", S), _f("child_community_ids", ARR_S),
        _f("full_content_embedding", VEC),
    ])


# Sink DDL constraints (S17): (column, max length) for bounded strings, key,
# NOT NULL columns, vector column.
SINK_CONSTRAINTS = {
    "documents": {"key": "id", "not_null": ["id"], "max_len": {"id": 64},
                  "array_max_len": {"entity_ids": 36, "relationship_ids": 36},
                  "vector": "content_embedding"},
    "entities": {"key": "id", "not_null": ["id"], "max_len": {"id": 36, "type": 256},
                 "array_max_len": {"document_ids": 64, "community_ids": 36},
                 "vector": "description_embedding"},
    "relationships": {"key": "id", "not_null": ["id", "source_entity_id", "target_entity_id"],
                      "max_len": {"id": 36, "source_entity_id": 36, "target_entity_id": 36},
                      "array_max_len": {"document_ids": 64}, "vector": None},
    "communities": {"key": "id", "not_null": ["id"],
                    "max_len": {"id": 36, "parent_community_id": 36},
                    "array_max_len": {"entity_ids": 36, "relationship_ids": 36,
                                      "document_ids": 64, "child_community_ids": 36},
                    "vector": "full_content_embedding"},
}

"""Lazy builders that chain the operators of steps 1-3 without table writes.

The pipeline (``pipeline.py``) runs the same operators but writes every step's
output as a table; these builders serve ad-hoc queries and tests. Model results
are always materialised (see ``model.call_model``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ..config import ModelConfig
from ..operators import documents as D
from ..operators import extract as X
from ..operators import graph as G
from ..operators import model as M
from ..schemas import EXTRACTION_PAYLOAD
from ..session import cut_lineage
from ..sources.driver import read_source


@dataclass
class Extraction:
    documents: DataFrame
    results: DataFrame
    parsed: DataFrame
    elements: DataFrame
    entity_mentions: DataFrame
    relationship_mentions: DataFrame
    entities_merged: DataFrame
    relationships_merged: DataFrame
    summary_requests: DataFrame
    summary_results: DataFrame
    summaries: DataFrame
    entities_raw: DataFrame
    relationships_raw: DataFrame


def extract_graph(documents: DataFrame, backend=None, cfg: ModelConfig | None = None,
                  max_rows: int | None = None, store=None) -> Extraction:
    cfg = cfg or ModelConfig()
    backend = backend or M.OfflineBackend()
    req = M.build_extraction_requests(documents, cfg, max_rows)
    if store is not None:
        store.write_request_table(req, "extraction_requests", ["document_id"])
        req = store.read("extraction_requests")
    res = M.call_model(req, backend, ["document_id"], store,
                       "extraction_results" if store is not None else None)
    parsed = M.parse_results(res, ["document_id"], EXTRACTION_PAYLOAD)
    # elements feed the merges, the summary prompts and the quarantine: parsed once, reused
    found = X.elements(parsed)
    if store is not None:
        store.write(found, "extraction_elements")
        found = store.read("extraction_elements")
    else:
        found = cut_lineage(found)
    em, rm = X.entity_mentions(found), X.relationship_mentions(found)
    # merged rows feed the summary prompts and the raw tables: merged once, reused
    ent, rel = X.merge_entities(em), X.merge_relationships(rm)
    if store is not None:
        store.write(ent, "entities_merged")
        store.write(rel, "relationships_merged")
        ent, rel = store.read("entities_merged"), store.read("relationships_merged")
    else:
        ent, rel = cut_lineage(ent), cut_lineage(rel)
    sreq = X.summary_requests(em, ent, rm, rel, cfg)
    if store is not None:
        store.write_request_table(sreq, "summarization_requests", X.SUMMARY_KEYS)
        sreq = store.read("summarization_requests")
    sres = M.call_model(sreq, backend, X.SUMMARY_KEYS, store,
                        "summarization_results" if store is not None else None)
    summ = X.parse_summaries(sres)
    return Extraction(documents, res, parsed, found, em, rm, ent, rel, sreq, sres, summ,
                      X.entities_raw(ent, summ), X.relationships_raw(rel, summ))


_CACHE: dict = {}


def cached_extraction(spark: SparkSession, sf_dir: str, source: str = "documents") -> Extraction:
    """One extraction per (session, folder, source) in this process."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, source)
    if key not in _CACHE:
        docs = D.dedup_documents(read_source(spark, source, sf_dir))
        ex = extract_graph(docs)
        # as in the pipeline, where they are tables: read again by most queries
        _CACHE[key] = replace(ex, entities_raw=cut_lineage(ex.entities_raw), relationships_raw=cut_lineage(ex.relationships_raw))
    return _CACHE[key]


def cached_ranked(spark: SparkSession, sf_dir: str, source: str = "documents"):
    """Entities and relationships of the graph without descriptions and document lists."""
    key = ("ranked", id(spark), spark.sparkContext.applicationId, sf_dir, source)
    if key not in _CACHE:
        ex = cached_extraction(spark, sf_dir, source)
        _CACHE[key] = G.ranked(ex.entities_raw, ex.relationships_raw)
    return _CACHE[key]


def cached_graph(spark: SparkSession, sf_dir: str, source: str = "documents"):
    key = ("graph", id(spark), spark.sparkContext.applicationId, sf_dir, source)
    if key not in _CACHE:
        ex = cached_extraction(spark, sf_dir, source)
        _CACHE[key] = G.with_texts(*cached_ranked(spark, sf_dir, source), ex.entities_raw, ex.relationships_raw)
    return _CACHE[key]

"""Registered queries: one per operator group, each over the whole given tables.

Every query returns a flat DataFrame (no array columns: arrays are joined after
sorting) whose column names match the DuckDB oracle in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..operators import documents as D
from ..operators import graph as G
from ..operators import model as M
from ..sources.driver import read_source
from . import edge_cases
from .build import cached_extraction, cached_graph, cached_ranked


def _r6(c):
    return F.round(F.col(c), 6)


# ---------------------------------------------------------------- step 1


def q_doc_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.dedup_documents(read_source(spark, "documents", sf))
    return docs.select("id", "title", F.length("raw_content").cast("bigint").alias("n_chars"))


def q_doc_title_min(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.dedup_documents(read_source(spark, "conversations", sf))
    return docs.select("id", "title", F.length("raw_content").cast("bigint").alias("n_chars"),
                       content_hash("raw_content").alias("content_sha"))


# ---------------------------------------------------------------- step 2


def q_prompt_extraction(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.dedup_documents(read_source(spark, "documents", sf))
    p = M.extraction_prompt("raw_content")
    return docs.select(F.col("id").alias("document_id"), F.sha2(p, 256).alias("prompt_sha"),
                       F.length(p).cast("bigint").alias("prompt_len"))


def q_request_fields(spark: SparkSession, sf: str) -> DataFrame:
    from ..config import ModelConfig
    docs = D.dedup_documents(read_source(spark, "documents", sf))
    req = M.build_extraction_requests(docs, ModelConfig())
    j = F.col("request")
    return req.select(
        "document_id",
        F.get_json_object(j, "$.contents[0].role").alias("role"),
        F.sha2(M.request_prompt(j), 256).alias("prompt_sha"),
        F.get_json_object(j, "$.generationConfig.temperature").cast("double").alias("temperature"),
        F.get_json_object(j, "$.generationConfig.maxOutputTokens").cast("bigint")
        .alias("max_output_tokens"),
        F.get_json_object(j, "$.generationConfig.responseMimeType").alias("mime_type"),
        F.get_json_object(j, "$.generationConfig.responseSchema.required[1]")
        .alias("second_required"),
        F.sha2(F.get_json_object(j, "$.system_instruction.parts[0].text"), 256)
        .alias("system_sha"))


def q_result_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.parsed.select(
        "document_id", F.coalesce("reason", F.lit("ok")).alias("reason"),
        F.size("payload.entities").cast("bigint").alias("n_entities"),
        F.size("payload.relationships").cast("bigint").alias("n_relationships"))


def q_result_status_route(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction results routed to usable / quarantine, counted by reason."""
    ex = cached_extraction(spark, sf)
    return ex.parsed.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.size("payload.entities")).cast("bigint").alias("n_entities"))


def q_entity_mentions(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.entity_mentions.select("document_id", F.col("pos").cast("bigint").alias("pos"),
                                     "title", "type", "description")


def q_entity_merge(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.entities_merged.select(
        "title", "type", "n_descriptions",
        F.size("document_ids").cast("bigint").alias("n_documents"),
        F.array_join("document_ids", ",").alias("document_ids"))


def q_entity_first_desc(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.entities_merged.select("title", "type", "first_description")


def q_rel_merge_avg_weight(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.relationships_merged.select(
        "source", "target", "n_descriptions", _r6("weight").alias("weight"),
        F.size("document_ids").cast("bigint").alias("n_documents"),
        "first_description")


def q_needs_summary(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.summary_requests.select(
        "entity_or_rel_key", "kind", "a", "b",
        F.sha2(M.request_prompt("request"), 256).alias("prompt_sha"))


def q_summary_attach(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.entities_raw.select("id", "title", "type", "description",
                                  F.size("document_ids").cast("bigint").alias("n_documents"))


def q_rel_summary_attach(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    return ex.relationships_raw.select("id", "source", "target", "description",
                                       _r6("weight").alias("weight"))


# ---------------------------------------------------------------- step 3


def q_title_collapse(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    kept = G.collapse_titles(ex.entities_raw)
    n_types = ex.entities_raw.groupBy("title").agg(F.count(F.lit(1)).alias("n_types"))
    return kept.join(n_types, "title").select("title", F.col("type").alias("kept_type"),
                                              F.col("id").alias("kept_id"),
                                              F.col("n_types").cast("bigint"))


def q_rel_endpoint_resolve(spark: SparkSession, sf: str) -> DataFrame:
    _, rels = cached_ranked(spark, sf)
    return rels.select("id", "source", "target", "source_entity_id", "target_entity_id")


def q_entity_degree(spark: SparkSession, sf: str) -> DataFrame:
    ents, _ = cached_ranked(spark, sf)
    return ents.select("title", "degree")


def q_entity_rank(spark: SparkSession, sf: str) -> DataFrame:
    ents, _ = cached_ranked(spark, sf)
    return ents.select("id", "title", "type", "degree", "human_readable_id")


def q_rel_rank(spark: SparkSession, sf: str) -> DataFrame:
    _, rels = cached_ranked(spark, sf)
    return rels.select("id", "source", "target", _r6("weight").alias("weight"),
                       "human_readable_id")


def q_doc_inverse_index(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.sink import document_inverse_index
    ex = cached_extraction(spark, sf)
    ents, rels = cached_graph(spark, sf)
    inv = document_inverse_index(ex.documents, ents, rels)
    return inv.select(F.col("id").alias("document_id"),
                      F.size("entity_ids").cast("bigint").alias("n_entities"),
                      F.size("relationship_ids").cast("bigint").alias("n_relationships"),
                      F.sha2(F.array_join("entity_ids", ","), 256).alias("entity_ids_sha"))


# ---------------------------------------------------------------- step 4 (given partition)


def _given(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import communities as C
    ents, rels = cached_graph(spark, sf)
    return C.assemble(C.given_membership(ents), ents, rels)


def q_community_edges(spark: SparkSession, sf: str) -> DataFrame:
    c = _given(spark, sf)
    return c.select("id", "level", F.size("entity_ids").cast("bigint").alias("n_entities"),
                    F.size("relationship_ids").cast("bigint").alias("n_relationships"),
                    F.sha2(F.array_join("relationship_ids", ","), 256).alias("rel_sha"))


def q_community_documents(spark: SparkSession, sf: str) -> DataFrame:
    c = _given(spark, sf)
    return c.select("id", "level", F.size("document_ids").cast("bigint").alias("n_documents"),
                    F.sha2(F.array_join("document_ids", ","), 256).alias("doc_sha"))


def q_community_parent(spark: SparkSession, sf: str) -> DataFrame:
    c = _given(spark, sf)
    return c.select("id", "level", "parent_community_id")


def q_community_children(spark: SparkSession, sf: str) -> DataFrame:
    c = _given(spark, sf)
    return c.select("id", "level", F.size("child_community_ids").cast("bigint")
                    .alias("n_children"),
                    F.array_join("child_community_ids", ",").alias("children"))


def q_community_level_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = _given(spark, sf)
    return c.groupBy("level").agg(F.count(F.lit(1)).cast("bigint").alias("n_communities"),
                                  F.sum(F.size("entity_ids")).cast("bigint")
                                  .alias("n_memberships"))


def q_modularity_given_partition(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import communities as C
    from ..session import cut_lineage
    ents, rels = cached_ranked(spark, sf)
    e = cut_lineage(C.weighted_edges(ents, rels))
    a = ents.select(F.col("human_readable_id").alias("node"), F.col("type").alias("c"))
    return C.modularity(e, a).select(_r6("modularity").alias("modularity"))


def q_report_context(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import reports as RP
    ents, rels = cached_graph(spark, sf)
    ctx = RP.community_context(_given(spark, sf), ents, rels, None)
    return ctx.select(F.col("community_id").alias("id"), F.sha2("context", 256).alias("ctx_sha"),
                      F.length("context").cast("bigint").alias("ctx_len"))


def q_report_body(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import reports as RP
    ents, rels = cached_graph(spark, sf)
    rep = RP.generate_reports(_given(spark, sf), ents, rels)
    return rep.select("id", "title", _r6("rating").alias("rating"),
                      F.sha2("full_content", 256).alias("body_sha"), "findings")


def q_reports_two_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts of both levels, the upper one with the reports of its children."""
    from ..operators import reports as RP
    from ..session import cut_lineage
    ents, rels = cached_graph(spark, sf)
    comm = cut_lineage(_given(spark, sf))  # read for the reports and for the contexts of both levels
    reports = RP.generate_reports(comm, ents, rels)
    leaf, upper = F.size("child_community_ids") == 0, F.size("child_community_ids") > 0
    ctx = RP.community_context(comm.where(leaf), ents, rels, None).unionByName(
        RP.community_context(comm.where(upper), ents, rels, reports))
    return ctx.select(F.col("community_id").alias("id"), F.col("level").cast("bigint").alias("level"),
                      F.sha2("context", 256).alias("ctx_sha"))


# ---------------------------------------------------------------- search, sink, views


def q_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.search import cosine_topk
    from ..sources.driver import table
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    cent = (emb.select("label", F.posexplode("embedding").alias("i", "x"))
            .groupBy("label", "i").agg(F.avg("x").alias("x"))
            .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("p"))
            .select(F.col("label").cast("string").alias("id"),
                    F.transform("p", lambda t: t["x"]).alias("vector")))
    items = emb.select(F.col("vec_id").cast("string").alias("id"),
                       F.col("embedding").alias("vector"))
    return cosine_topk(cent, items, 5).select(
        "query_id", "rank", "item_id", _r6("score").alias("score"))


def q_sink_topk(spark: SparkSession, sf: str) -> DataFrame:
    """L5 over the sink: vectors upserted as documents, every twentieth searched among all of them."""
    import uuid

    from ..operators import sink as SK
    from ..operators.search import cosine_topk
    from ..session import ensure_checkpoint_dir
    from ..sources.driver import table
    from ..sources.tables import TableStore
    emb = table(spark, sf, "embeddings")
    dim = 64 if emb.isEmpty() else len(emb.select("embedding").where("embedding is not null").first()[0])
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/kgspark-search-{uuid.uuid4().hex}")
    rows = SK.sink_documents(emb.select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("content_embedding")), dim)
    docs = SK.checked_upsert(store, "documents", rows, dim).select("id", F.col("content_embedding").alias("vector"))
    return cosine_topk(docs.where(F.col("id").cast("bigint") % 20 == 0), docs, 5).select(
        "query_id", "rank", "item_id", _r6("score").alias("score"))


def q_upsert_update(spark: SparkSession, sf: str) -> DataFrame:
    """S12 through the committed tables: a second batch with changed, new and repeated keys over a first one."""
    import uuid

    from ..operators import sink as SK
    from ..session import ensure_checkpoint_dir
    from ..sources.driver import table
    from ..sources.tables import TableStore
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/kgspark-upsert-{uuid.uuid4().hex}")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id", F.col("text").alias("raw_content"))
    batch = lambda rows, title: SK.sink_documents(rows.select("id", F.lit(title).alias("title"), "raw_content"), 4)
    SK.upsert_table(store, "documents", batch(docs.where("doc_id % 3 <> 0"), "first"))
    second = docs.where("doc_id % 4 <> 0")
    done = SK.upsert_table(store, "documents", batch(second.unionByName(second.where("doc_id % 8 = 1")), "second"))
    return done.select("id", "title", F.length("raw_content").cast("bigint").alias("n_chars"))


def q_sink_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Sink documents with a fault of each rule, chosen by the document's id."""
    from ..operators import sink as SK
    from ..sources.driver import table
    n = F.col("doc_id")
    every = lambda k, then: F.when(n % k == 1, then)
    rows = table(spark, sf, "documents").select(
        F.when(n % 7 == 1, F.lit(None)).when(n % 11 == 1, F.concat(F.repeat(F.lit("k"), 64), n.cast("string")))
        .when(n % 5 == 1, F.lit("same")).otherwise(n.cast("string")).alias("id"),
        F.lit("").alias("title"), F.lit("").alias("raw_content"),
        F.coalesce(every(13, F.array(F.lit("ok"), F.repeat(F.lit("e"), 37))), F.array(F.lit("ok"))).alias("entity_ids"),
        every(17, F.array(F.repeat(F.lit("r"), 40))).alias("relationship_ids"),
        F.when(n % 3 == 0, F.array_repeat(F.lit(0.5), 4)).when(n % 3 == 1, F.array_repeat(F.lit(0.5), 3)).alias("content_embedding"))
    return SK.constraint_violations(SK.sink_documents(rows, 4), "documents", 4).select(
        F.coalesce("key", F.lit("(null)")).alias("key"), "rule", "column", "n_rows")


def q_upsert_entities(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import sink as SK
    ents, _ = cached_graph(spark, sf)
    rows = SK.sink_entities(ents, 768)
    once = SK.upsert(None, rows)
    twice = SK.upsert(once, rows)  # the same batch twice equals once
    return twice.select("id", "title", "type", "degree", "human_readable_id",
                        F.size("document_ids").cast("bigint").alias("n_documents"))


def q_constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import sink as SK
    from ..sources.driver import table
    ents, rels = cached_graph(spark, sf)
    emb = table(spark, sf, "embeddings")
    docs = emb.select(F.col("vec_id").cast("string").alias("id"),
                      F.lit(None).cast("string").alias("title"),
                      F.lit(None).cast("string").alias("raw_content"),
                      F.col("embedding").alias("content_embedding"))
    v = (SK.constraint_violations(SK.sink_documents(docs, 768), "documents", 768)
         .unionByName(SK.constraint_violations(SK.sink_entities(ents, 768), "entities", 768))
         .unionByName(SK.constraint_violations(SK.sink_relationships(rels, 768),
                                               "relationships", 768)))
    return v.groupBy("table", "rule", "column").agg(F.sum("n_rows").cast("bigint").alias("n"))


def q_node_union(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import sink as SK
    ex = cached_extraction(spark, sf)
    ents, _ = cached_graph(spark, sf)
    nodes = SK.node_table(ents, ex.documents, _given(spark, sf))
    return nodes.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                      F.countDistinct("id").cast("bigint").alias("n_ids"))


def q_neighbors_one_hop(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import sink as SK
    ents, rels = cached_graph(spark, sf)
    edges, bad = SK.edge_table(rels, ents)
    nb = SK.neighbors(edges).groupBy("v").agg(F.count(F.lit(1)).cast("bigint")
                                               .alias("n_neighbors"))
    return nb.select(F.col("v").alias("entity_id"), "n_neighbors")


def _n_odd(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """One row: how many rows one of two tables has more often than the other; each is computed once."""
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    return both.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).agg(F.coalesce(F.sum(F.abs("_n")), F.lit(0)).cast("bigint").alias(name))


def q_communities_detected(spark: SparkSession, sf: str) -> DataFrame:
    """Detected communities, as facts that hold for any right detection: whom they cover, and how many rows
    have another id, other relationships or other documents than their members give."""
    from ..functions.text import stable_id
    from ..operators import communities as C
    from ..session import cut_lineage
    # descriptions take no part: relationships need no join with their texts, entities one for their documents
    ents, rels = cached_graph(spark, sf)[0], cached_ranked(spark, sf)[1]
    ents = cut_lineage(ents.select("id", "title", "human_readable_id", "document_ids"))
    found = cut_lineage(C.detect(ents, rels))
    member = found.select(F.col("id").alias("cid"), "level", F.explode("entity_ids").alias("eid"))
    ends = rels.select("id", F.col("source_entity_id").alias("s"), F.col("target_entity_id").alias("t"))
    inside = (ends.join(member.select("cid", F.col("eid").alias("s")), "s").join(member.select("cid", F.col("eid").alias("t")), ["cid", "t"])
              .select("cid", "id"))
    listed = found.select(F.col("id").alias("cid"), F.explode("relationship_ids").alias("id"))
    papers = (member.join(ents.select(F.col("id").alias("eid"), F.explode("document_ids").alias("doc")), "eid")
              .select("cid", "doc").distinct())
    listed_papers = found.select(F.col("id").alias("cid"), F.explode("document_ids").alias("doc"))
    facts = member.where("level = 0").agg(F.count(F.lit(1)).alias("n_memberships"), F.countDistinct("eid").alias("n_entities"))
    ids = found.where(F.col("id") != stable_id("community", F.col("level"), F.element_at("entity_ids", 1))).agg(
        F.count(F.lit(1)).alias("n_odd_ids"))
    for one_row in (ids, _n_odd(inside, listed, "n_odd_relationships"), _n_odd(papers, listed_papers, "n_odd_documents")):
        facts = facts.crossJoin(one_row)  # one row each
    return facts


def q_communities_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Invariants of a detection that splits clusters of more than 60 members again."""
    from ..operators import communities as C
    from ..session import cut_lineage
    ents, rels = cached_ranked(spark, sf)
    e = cut_lineage(C.weighted_edges(ents, rels))
    return C.hierarchy_invariants(e, cut_lineage(C.hierarchical_communities(e, max_cluster_size=60)))


def q_rel_dangling(spark: SparkSession, sf: str) -> DataFrame:
    ex = cached_extraction(spark, sf)
    kept = G.collapse_titles(ex.entities_raw)
    return G.dangling_relationships(ex.relationships_raw, kept).select("id", "source", "target")


def q_connected_components(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import communities as C
    ents, rels = cached_ranked(spark, sf)
    e = C.weighted_edges(ents, rels).withColumn("part", F.lit(0))
    nodes = ents.select(F.lit(0).alias("part"), F.col("human_readable_id").alias("node"))
    cc = C.connected_components(e, nodes)
    return (cc.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("size").agg(F.count(F.lit(1)).cast("bigint").alias("n_components")))


def q_pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Whole six-step job into a fresh folder under the checkpoint directory."""
    import uuid

    from ..config import CommunityConfig, PipelineConfig, SourceConfig, StorageConfig
    from ..session import ensure_checkpoint_dir
    from ..sources.tables import TableStore
    from .pipeline import run_pipeline
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kgspark-e2e-{uuid.uuid4().hex}"
    cfg = PipelineConfig(source=SourceConfig("documents", sf), storage=StorageConfig(base),
                         community=CommunityConfig())
    run_pipeline(spark, cfg)
    sink = TableStore(spark, base + "/sink")
    n, none = F.count(F.lit(1)).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_without_vector")
    without = lambda c: F.sum(F.col(c).isNull().cast("bigint")).alias("n_without_vector")
    rows = [("documents", (n, without("content_embedding"))), ("entities", (n, without("description_embedding"))),
            ("relationships", (n, none)),
            ("communities", (F.sum(F.size("entity_ids")).cast("bigint").alias("n"), without("full_content_embedding")))]
    out = None
    for name, counts in rows:
        one = sink.read(name).agg(*counts).select(F.lit(name).alias("table"), "n", "n_without_vector")
        out = one if out is None else out.unionByName(one)
    return out


def q_run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the first three steps record."""
    import uuid

    from ..config import PipelineConfig, SourceConfig, StorageConfig
    from ..session import ensure_checkpoint_dir
    from .pipeline import Pipeline
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kgspark-counts-{uuid.uuid4().hex}"
    job = Pipeline(spark, PipelineConfig(source=SourceConfig("documents", sf), storage=StorageConfig(base)))
    job.run(steps=[1, 2, 3])
    return job.store.read("run_counts").select(F.col("step").cast("bigint").alias("step"), "name", "value")


QUERIES = {
    "doc_dedup": q_doc_dedup,
    "doc_title_min": q_doc_title_min,
    "prompt_extraction": q_prompt_extraction,
    "request_fields": q_request_fields,
    "result_json_parse": q_result_json_parse,
    "result_status_route": q_result_status_route,
    "entity_mentions": q_entity_mentions,
    "entity_merge": q_entity_merge,
    "entity_first_desc": q_entity_first_desc,
    "rel_merge_avg_weight": q_rel_merge_avg_weight,
    "needs_summary": q_needs_summary,
    "summary_attach": q_summary_attach,
    "rel_summary_attach": q_rel_summary_attach,
    "title_collapse": q_title_collapse,
    "rel_endpoint_resolve": q_rel_endpoint_resolve,
    "entity_degree": q_entity_degree,
    "entity_rank": q_entity_rank,
    "rel_rank": q_rel_rank,
    "doc_inverse_index": q_doc_inverse_index,
    "community_edges": q_community_edges,
    "community_documents": q_community_documents,
    "community_parent": q_community_parent,
    "community_children": q_community_children,
    "community_level_counts": q_community_level_counts,
    "modularity_given_partition": q_modularity_given_partition,
    "report_context": q_report_context,
    "report_body": q_report_body,
    "reports_two_levels": q_reports_two_levels,
    "cosine_topk": q_cosine_topk,
    "sink_topk": q_sink_topk,
    "upsert_update": q_upsert_update,
    "sink_violations": q_sink_violations,
    "upsert_entities": q_upsert_entities,
    "constraint_violations": q_constraint_violations,
    "node_union": q_node_union,
    "neighbors_one_hop": q_neighbors_one_hop,
    "communities_detected": q_communities_detected,
    "communities_hierarchy": q_communities_hierarchy,
    "rel_dangling": q_rel_dangling,
    "connected_components": q_connected_components,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "run_counts": q_run_counts,
    **edge_cases.QUERIES,
}

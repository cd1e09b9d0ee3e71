"""Independent DuckDB SQL for the registered queries (the correctness gate).

Written from the semantics in the docstrings of the operators, over the raw given
tables; nothing here calls Spark. The offline model's fixed rules are restated in
SQL (``OfflineBackend``).
"""

from __future__ import annotations


from ..config import ModelConfig
from ..functions import prompts as P
from . import edge_cases


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sid(kind: str, a: str, b: str) -> str:
    key = (f"'{kind}:' || length({a}) || ':' || {a} || ':' || length({b}) || ':' || {b}")
    h = f"sha256({key})"
    return (f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||"
            f"substr({h},17,4)||'-'||substr({h},21,12))")


TYPES = "[" + ", ".join(lit(t) for t in P.ENTITY_TYPES) + "]"

DOCS = """
docs AS (
  SELECT sha256(coalesce(text, '')) AS id,
         min(CASE WHEN doc_id IS NULL OR doc_id = 0 THEN '' ELSE CAST(doc_id AS VARCHAR) END)
           AS title,
         any_value(coalesce(text, '')) AS raw_content
  FROM documents GROUP BY 1)"""

EXTRACT = DOCS + f""",
nm AS (SELECT id AS document_id,
              regexp_extract_all(raw_content, '([A-Z][a-z]{{3,}})', 1) AS n FROM docs),
em AS (
  SELECT document_id, pos, upper(name) AS title, {TYPES}[length(name) % 8 + 1] AS type,
         name || ' is mentioned as term ' || CAST(pos + 1 AS VARCHAR) AS description
  FROM (SELECT document_id, unnest(n) AS name, unnest(range(len(n))) AS pos FROM nm)),
rm AS (
  SELECT document_id, i - 1 AS pos, upper(n[i]) AS source, upper(n[i + 1]) AS target,
         n[i] || ' is followed by ' || n[i + 1] AS description,
         CAST((length(n[i]) + length(n[i + 1])) % 10 + 1 AS DOUBLE) / 10.0 AS weight
  FROM (SELECT document_id, n, unnest(range(1, len(n))) AS i FROM nm)),
ent AS (
  SELECT title, type, count(*) AS n_descriptions,
         first(description ORDER BY document_id, pos) AS first_description,
         list_sort(list(DISTINCT document_id)) AS document_ids
  FROM em GROUP BY title, type),
rel AS (
  SELECT source, target, count(*) AS n_descriptions,
         first(description ORDER BY document_id, pos) AS first_description,
         list_sort(list(DISTINCT document_id)) AS document_ids,
         -- integer sums become doubles by way of text: a direct cast rounds those beyond 64 bits twice
         coalesce(CAST(CAST(sum(CAST(weight * pow(2, 53) AS BIGINT)) FILTER (weight >= 1) AS VARCHAR) AS DOUBLE)
                  / count(*) * pow(2, -53), 0)
         + coalesce(CAST(CAST(sum(CAST(weight * pow(2, 61) AS BIGINT)) FILTER (weight < 1) AS VARCHAR) AS DOUBLE)
                    / count(*) * pow(2, -61), 0) AS weight
  FROM rm GROUP BY source, target),
eraw AS (
  SELECT {sid('entity', 'title', 'type')} AS id, title, type,
         CASE WHEN n_descriptions > 1 THEN 'Merged from ' || n_descriptions
              || ' descriptions: ' || first_description ELSE first_description END
           AS description, document_ids
  FROM ent),
rraw AS (
  SELECT {sid('rel', 'source', 'target')} AS id, source, target,
         CASE WHEN n_descriptions > 1 THEN 'Merged from ' || n_descriptions
              || ' descriptions: ' || first_description ELSE first_description END
           AS description, weight, document_ids
  FROM rel)"""

GRAPH = EXTRACT + """,
ecol AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY title ORDER BY len(document_ids) DESC, type, id)
      AS rn FROM eraw) WHERE rn = 1),
rval AS (
  SELECT r.*, s.id AS source_entity_id, t.id AS target_entity_id
  FROM rraw r JOIN ecol s ON r.source = s.title JOIN ecol t ON r.target = t.title),
deg AS (
  SELECT title, count(*) AS degree
  FROM (SELECT source AS title FROM rval UNION ALL SELECT target FROM rval) GROUP BY title),
ents AS (
  SELECT e.*, CAST(coalesce(d.degree, 0) AS BIGINT) AS degree,
         CAST(row_number() OVER (ORDER BY coalesce(d.degree, 0) DESC, e.title, e.id) - 1
              AS BIGINT) AS human_readable_id
  FROM ecol e LEFT JOIN deg d ON e.title = d.title),
rels AS (
  SELECT r.*, CAST(row_number() OVER (ORDER BY round(weight, 9) DESC, source, target, id) - 1
                   AS BIGINT) AS human_readable_id
  FROM rval r)"""


def _summary_prompt_sql(kind: str) -> str:
    parts = P.ENTITY_SUMMARY_PARTS if kind == "entity" else P.RELATIONSHIP_SUMMARY_PARTS
    a, b = ("title", "type") if kind == "entity" else ("source", "target")
    src = "em" if kind == "entity" else "rm"
    grp = "ent" if kind == "entity" else "rel"
    return f"""
  SELECT {lit(kind + '::')} || k.{a} || '::' || k.{b} AS entity_or_rel_key,
         {lit(kind)} AS kind, k.{a} AS a, k.{b} AS b,
         sha256({lit(parts[0])} || k.{a} || {lit(parts[1])} || k.{b} || {lit(parts[2])}
                || k.lines || {lit(P.SUMMARY_PROMPT_TAIL)}) AS prompt_sha
  FROM (
    SELECT {a}, {b}, string_agg(CAST(rn AS VARCHAR) || '. ' || description, chr(10)
                                ORDER BY rn) AS lines
    FROM (SELECT m.*, row_number() OVER (PARTITION BY m.{a}, m.{b}
                                         ORDER BY m.document_id, m.pos) AS rn
          FROM {src} m JOIN {grp} g ON m.{a} = g.{a} AND m.{b} = g.{b}
          WHERE g.n_descriptions > 1)
    GROUP BY {a}, {b}) k"""


def oracles() -> dict[str, str]:
    cfg = ModelConfig()
    sys_text = P.extraction_system_instruction()
    head, tail = lit(P.EXTRACTION_PROMPT_HEAD), lit(P.EXTRACTION_PROMPT_TAIL)
    q: dict[str, str] = {}
    q["doc_dedup"] = f"WITH {DOCS} SELECT id, title, CAST(length(raw_content) AS BIGINT) AS n_chars FROM docs"
    q["doc_title_min"] = """
WITH src AS (
  SELECT conv_id AS data_id,
         string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) ORDER BY turn)
           AS full_conversation
  FROM conversations GROUP BY conv_id),
docs AS (
  SELECT sha256(coalesce(full_conversation, '')) AS id,
         min(CASE WHEN data_id IS NULL OR data_id = 0 THEN '' ELSE CAST(data_id AS VARCHAR) END)
           AS title,
         any_value(coalesce(full_conversation, '')) AS raw_content
  FROM src GROUP BY 1)
SELECT id, title, CAST(length(raw_content) AS BIGINT) AS n_chars,
       sha256(raw_content) AS content_sha FROM docs"""
    q["prompt_extraction"] = f"""WITH {DOCS}
SELECT id AS document_id, sha256({head} || raw_content || {tail}) AS prompt_sha,
       CAST(length({head} || raw_content || {tail}) AS BIGINT) AS prompt_len FROM docs"""
    q["request_fields"] = f"""WITH {DOCS}
SELECT id AS document_id, 'user' AS role, sha256({head} || raw_content || {tail}) AS prompt_sha,
       CAST({cfg.temperature} AS DOUBLE) AS temperature,
       CAST({cfg.max_output_tokens} AS BIGINT) AS max_output_tokens,
       'application/json' AS mime_type, 'relationships' AS second_required,
       sha256({lit(sys_text)}) AS system_sha FROM docs"""
    q["result_json_parse"] = f"""WITH {EXTRACT}
SELECT document_id, 'ok' AS reason, CAST(len(n) AS BIGINT) AS n_entities,
       CAST(greatest(len(n) - 1, 0) AS BIGINT) AS n_relationships FROM nm"""
    q["result_status_route"] = f"""WITH {EXTRACT}
SELECT 'ok' AS reason, CAST(count(*) AS BIGINT) AS n, CAST(sum(len(n)) AS BIGINT) AS n_entities
FROM nm"""
    q["entity_mentions"] = f"""WITH {EXTRACT}
SELECT document_id, CAST(pos AS BIGINT) AS pos, title, type, description FROM em"""
    q["entity_merge"] = f"""WITH {EXTRACT}
SELECT title, type, CAST(n_descriptions AS BIGINT) AS n_descriptions,
       CAST(len(document_ids) AS BIGINT) AS n_documents,
       array_to_string(document_ids, ',') AS document_ids FROM ent"""
    q["entity_first_desc"] = f"WITH {EXTRACT} SELECT title, type, first_description FROM ent"
    q["rel_merge_avg_weight"] = f"""WITH {EXTRACT}
SELECT source, target, CAST(n_descriptions AS BIGINT) AS n_descriptions,
       round(weight, 6) AS weight, CAST(len(document_ids) AS BIGINT) AS n_documents,
       first_description FROM rel"""
    q["needs_summary"] = (f"WITH {EXTRACT} " + _summary_prompt_sql("entity")
                          + "\nUNION ALL" + _summary_prompt_sql("rel"))
    q["summary_attach"] = f"""WITH {EXTRACT}
SELECT id, title, type, description, CAST(len(document_ids) AS BIGINT) AS n_documents FROM eraw"""
    q["rel_summary_attach"] = f"""WITH {EXTRACT}
SELECT id, source, target, description, round(weight, 6) AS weight FROM rraw"""
    q["title_collapse"] = f"""WITH {GRAPH}
SELECT c.title, c.type AS kept_type, c.id AS kept_id, CAST(n.n_types AS BIGINT) AS n_types
FROM ecol c JOIN (SELECT title, count(*) AS n_types FROM eraw GROUP BY title) n
  ON c.title = n.title"""
    q["rel_endpoint_resolve"] = f"""WITH {GRAPH}
SELECT id, source, target, source_entity_id, target_entity_id FROM rval"""
    q["entity_degree"] = f"WITH {GRAPH} SELECT title, degree FROM ents"
    q["entity_rank"] = f"WITH {GRAPH} SELECT id, title, type, degree, human_readable_id FROM ents"
    q["rel_rank"] = f"""WITH {GRAPH}
SELECT id, source, target, round(weight, 6) AS weight, human_readable_id FROM rels"""
    q["doc_inverse_index"] = f"""WITH {GRAPH},
ei AS (SELECT doc, list_sort(list(id)) AS l FROM (SELECT id, unnest(document_ids) AS doc FROM ents)
       GROUP BY doc),
ri AS (SELECT doc, count(*) AS n FROM (SELECT id, unnest(document_ids) AS doc FROM rels)
       GROUP BY doc)
SELECT d.id AS document_id, CAST(coalesce(len(ei.l), 0) AS BIGINT) AS n_entities,
       CAST(coalesce(ri.n, 0) AS BIGINT) AS n_relationships,
       sha256(coalesce(array_to_string(ei.l, ','), '')) AS entity_ids_sha
FROM docs d LEFT JOIN ei ON d.id = ei.doc LEFT JOIN ri ON d.id = ri.doc"""
    q.update(_more())
    q["rel_dangling"] = f"""WITH {GRAPH}
SELECT r.id, r.source, r.target FROM rraw r
WHERE r.source NOT IN (SELECT title FROM ecol) OR r.target NOT IN (SELECT title FROM ecol)"""
    # G9 by min-label propagation in a keyed recursive CTE: a vertex takes a smaller
    # neighbour label until no label changes
    q["connected_components"] = f"""WITH RECURSIVE {GRAPH},
we AS (
  SELECT least(s.human_readable_id, t.human_readable_id) AS u,
         greatest(s.human_readable_id, t.human_readable_id) AS v
  FROM rels r JOIN ents s ON r.source = s.title JOIN ents t ON r.target = t.title
  WHERE r.weight > 0 GROUP BY 1, 2),
sym AS (SELECT u AS a, v AS b FROM we WHERE u <> v UNION ALL SELECT v, u FROM we WHERE u <> v),
cc(node, comp) USING KEY (node) AS (
  SELECT human_readable_id, human_readable_id FROM ents
  UNION
  SELECT s.a, min(c.comp)
  FROM cc c JOIN sym s ON s.b = c.node JOIN recurring.cc r ON r.node = s.a
  GROUP BY s.a, r.comp HAVING min(c.comp) < r.comp)
SELECT size, CAST(count(*) AS BIGINT) AS n_components
FROM (SELECT comp, CAST(count(*) AS BIGINT) AS size FROM cc GROUP BY comp) GROUP BY size"""
    q["constraint_violations"] = """
SELECT 'documents' AS "table", 'vector_len_768' AS rule, 'content_embedding' AS "column",
       CAST(count(*) AS BIGINT) AS n
FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) <> 768 HAVING count(*) > 0"""
    return q


GIVEN = GRAPH + f""",
mem AS (
  SELECT 0 AS level, type AS cluster, id AS entity_id, CAST(NULL AS VARCHAR) AS parent_cluster
  FROM ents
  UNION ALL
  SELECT 1, type || '/' || substr(title, 1, 1), id, type FROM ents),
base AS (
  SELECT level, cluster, list_sort(list(entity_id)) AS entity_ids,
         max(parent_cluster) AS parent_cluster
  FROM mem GROUP BY level, cluster),
cid AS (SELECT *, {sid('community', 'CAST(level AS VARCHAR)', 'entity_ids[1]')} AS id FROM base),
crel AS (
  SELECT m1.level, m1.cluster, list_sort(list(r.id)) AS rids
  FROM rels r JOIN mem m1 ON r.source_entity_id = m1.entity_id
  JOIN mem m2 ON r.target_entity_id = m2.entity_id AND m1.level = m2.level
               AND m1.cluster = m2.cluster
  GROUP BY m1.level, m1.cluster),
cdoc AS (
  SELECT level, cluster, list_sort(list(DISTINCT doc)) AS dids
  FROM (SELECT m.level, m.cluster, unnest(e.document_ids) AS doc
        FROM mem m JOIN ents e ON m.entity_id = e.id)
  GROUP BY level, cluster),
cpar AS (
  SELECT c.level, c.cluster, p.id AS parent_community_id
  FROM cid c JOIN cid p ON p.level = c.level - 1 AND p.cluster = c.parent_cluster
  WHERE c.level > 0),
cch AS (
  SELECT p.level, p.cluster, list_sort(list(c.id)) AS kids
  FROM cid c JOIN cid p ON c.level = p.level + 1 AND c.parent_cluster = p.cluster
  GROUP BY p.level, p.cluster),
comm AS (
  SELECT c.id, CAST(c.level AS BIGINT) AS level, c.cluster, c.entity_ids,
         coalesce(crel.rids, []) AS rids, coalesce(cdoc.dids, []) AS dids,
         cpar.parent_community_id, coalesce(cch.kids, []) AS kids
  FROM cid c
  LEFT JOIN crel ON c.level = crel.level AND c.cluster = crel.cluster
  LEFT JOIN cdoc ON c.level = cdoc.level AND c.cluster = cdoc.cluster
  LEFT JOIN cpar ON c.level = cpar.level AND c.cluster = cpar.cluster
  LEFT JOIN cch ON c.level = cch.level AND c.cluster = cch.cluster)"""

REPORT_CTX = GIVEN + """,
el AS (
  SELECT l.id, e.title, e.degree,
         '- **' || e.title || '** (type: ' || e.type || ', degree: ' || CAST(e.degree AS VARCHAR)
         || '): ' || e.description AS line
  FROM (SELECT id, unnest(entity_ids) AS eid FROM comm) l JOIN ents e ON l.eid = e.id),
rl AS (
  SELECT l.id, r.weight, r.source, r.target,
         '- ' || r.source || ' -> ' || r.target || ' (weight: ' || CAST(r.weight AS VARCHAR)
         || '): ' || r.description AS line
  FROM (SELECT id, unnest(rids) AS rid FROM comm) l JOIN rels r ON l.rid = r.id),
es AS (
  SELECT id, '## Entities' || chr(10) || chr(10)
         || string_agg(line, chr(10) || chr(10) ORDER BY degree DESC, title) AS sec,
         count(*) AS n_ent,
         list(title ORDER BY degree DESC, title) AS titles
  FROM el GROUP BY id),
rs AS (
  SELECT id, '## Relationships' || chr(10) || chr(10)
         || string_agg(line, chr(10) || chr(10) ORDER BY weight DESC, source, target) AS sec,
         count(*) AS n_rel
  FROM rl GROUP BY id),
ctx AS (
  SELECT c.id, c.level, concat_ws(chr(10) || chr(10), es.sec, rs.sec) AS context,
         coalesce(es.n_ent, 0) AS n_ent, coalesce(rs.n_rel, 0) AS n_rel, es.titles,
         c.kids
  FROM comm c LEFT JOIN es ON c.id = es.id LEFT JOIN rs ON c.id = rs.id)"""


def _more() -> dict[str, str]:
    nl2 = "chr(10) || chr(10)"
    q: dict[str, str] = {}
    q["community_edges"] = f"""WITH {GIVEN}
SELECT id, level, CAST(len(entity_ids) AS BIGINT) AS n_entities,
       CAST(len(rids) AS BIGINT) AS n_relationships,
       sha256(coalesce(array_to_string(rids, ','), '')) AS rel_sha FROM comm"""
    q["community_documents"] = f"""WITH {GIVEN}
SELECT id, level, CAST(len(dids) AS BIGINT) AS n_documents,
       sha256(coalesce(array_to_string(dids, ','), '')) AS doc_sha FROM comm"""
    q["community_parent"] = f"WITH {GIVEN} SELECT id, level, parent_community_id FROM comm"
    q["community_children"] = f"""WITH {GIVEN}
SELECT id, level, CAST(len(kids) AS BIGINT) AS n_children,
       coalesce(array_to_string(kids, ','), '') AS children FROM comm"""
    q["community_level_counts"] = f"""WITH {GIVEN}
SELECT level, CAST(count(*) AS BIGINT) AS n_communities,
       CAST(sum(len(entity_ids)) AS BIGINT) AS n_memberships FROM comm GROUP BY level"""
    q["modularity_given_partition"] = f"""WITH {GRAPH},
we AS (
  SELECT least(s.human_readable_id, t.human_readable_id) AS u,
         greatest(s.human_readable_id, t.human_readable_id) AS v, sum(r.weight) AS w
  FROM rels r JOIN ents s ON r.source = s.title JOIN ents t ON r.target = t.title
  WHERE r.weight > 0 GROUP BY 1, 2),
mm AS (SELECT sum(w) AS m FROM we),
asg AS (SELECT human_readable_id AS node, type AS c FROM ents),
ins AS (SELECT a.c, sum(w) AS l FROM we JOIN asg a ON we.u = a.node JOIN asg b ON we.v = b.node
        WHERE a.c = b.c GROUP BY a.c),
st AS (SELECT node, sum(w) AS k FROM (SELECT u AS node, w FROM we UNION ALL SELECT v, w FROM we)
       GROUP BY node),
tot AS (SELECT a.c, sum(k) AS kc FROM st JOIN asg a ON st.node = a.node GROUP BY a.c)
SELECT round(sum(coalesce(l, 0) / m - power(kc / (2 * m), 2)), 6) AS modularity
FROM tot LEFT JOIN ins ON tot.c = ins.c, mm"""
    q["report_context"] = f"""WITH {REPORT_CTX}
SELECT id, sha256(context) AS ctx_sha, CAST(length(context) AS BIGINT) AS ctx_len FROM ctx"""
    q["report_body"] = f"""WITH {REPORT_CTX},
rep AS (
  SELECT id, 'Community of ' || coalesce(titles[1], 'sub-communities') AS title,
         CAST(n_ent AS VARCHAR) || ' entities, ' || CAST(n_rel AS VARCHAR)
           || ' relationships, ' || CAST(len(kids) AS VARCHAR) || ' sub-community reports.' AS summary,
         least(10.0, CAST(n_ent AS DOUBLE) / 2.0) AS rating,
         'Based on ' || CAST(n_ent AS VARCHAR) || ' member entities.' AS expl,
         coalesce(titles, []) AS f, level, context, kids
  FROM ctx)
SELECT id, title, round(rating, 6) AS rating,
       sha256('# ' || title || {nl2} || summary || {nl2} || 'Rating: '
              || CAST(rating AS VARCHAR) || ' - ' || expl || {nl2} || '## Findings'
              || coalesce(list_aggregate(list_transform(f, lambda t: {nl2} || '### About ' || t
                 || chr(10) || t || ' belongs to this community.'), 'string_agg', ''), ''))
         AS body_sha,
       '[' || coalesce(list_aggregate(list_transform(f, lambda t: '{{"summary":"About ' || t
              || '","explanation":"' || t || ' belongs to this community."}}'),
              'string_agg', ','), '') || ']' AS findings
FROM rep"""
    q["reports_two_levels"] = f"""WITH {REPORT_CTX},
rep AS (
  SELECT id, 'Community of ' || coalesce(titles[1], 'sub-communities') AS title,
         CAST(n_ent AS VARCHAR) || ' entities, ' || CAST(n_rel AS VARCHAR)
           || ' relationships, ' || CAST(len(kids) AS VARCHAR) || ' sub-community reports.' AS summary,
         least(10.0, CAST(n_ent AS DOUBLE) / 2.0) AS rating,
         'Based on ' || CAST(n_ent AS VARCHAR) || ' member entities.' AS expl,
         coalesce(titles, []) AS f, level, context, kids
  FROM ctx),
sub AS (
  SELECT r.id, '## Sub-Community Reports' || {nl2}
         || string_agg('### ' || k.title || chr(10) || k.summary || chr(10) || 'Rating: '
                       || CAST(k.rating AS VARCHAR) || chr(10), {nl2} ORDER BY k.id) AS sec
  FROM (SELECT id, unnest(kids) AS kid FROM rep) r JOIN rep k ON r.kid = k.id GROUP BY r.id)
SELECT rep.id, rep.level, sha256(concat_ws({nl2}, sub.sec, nullif(rep.context, ''))) AS ctx_sha
FROM rep LEFT JOIN sub ON rep.id = sub.id"""
    q["cosine_topk"] = """
WITH x AS (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS v
  FROM embeddings),
cent AS (
  SELECT label, list(v ORDER BY i) AS c
  FROM (SELECT label, i, avg(v) AS v FROM x GROUP BY label, i) GROUP BY label),
s AS (
  SELECT CAST(c.label AS VARCHAR) AS query_id, CAST(e.vec_id AS VARCHAR) AS item_id,
         list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.c) AS score
  FROM embeddings e, cent c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)
        AS rk FROM s)
SELECT query_id, CAST(rk AS BIGINT) AS rank, item_id, round(score, 6) AS score
FROM r WHERE rk <= 5"""
    q["upsert_entities"] = f"""WITH {GRAPH}
SELECT id, title, type, degree, human_readable_id,
       CAST(len(document_ids) AS BIGINT) AS n_documents FROM ents"""
    q["node_union"] = f"""WITH {GIVEN}
SELECT 'Entity' AS label, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT id) AS BIGINT) AS n_ids
FROM ents
UNION ALL SELECT 'Document', count(*), count(DISTINCT id) FROM docs
UNION ALL SELECT 'Community', count(*), count(DISTINCT id) FROM comm"""
    q["communities_hierarchy"] = f"""WITH {GRAPH},
v AS (SELECT source_entity_id AS id FROM rels WHERE weight > 0
      UNION SELECT target_entity_id FROM rels WHERE weight > 0)
SELECT CAST(count(*) AS BIGINT) AS n_vertices, CAST(count(*) AS BIGINT) AS n_level0,
       CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_uncovered,
       CAST(0 AS BIGINT) AS n_disconnected, true AS as_good_as_components
FROM v"""
    q["neighbors_one_hop"] = f"""WITH {GRAPH},
sym AS (SELECT source_entity_id AS v, target_entity_id AS n FROM rels
        UNION SELECT target_entity_id, source_entity_id FROM rels)
SELECT v AS entity_id, CAST(count(*) AS BIGINT) AS n_neighbors FROM sym WHERE v <> n GROUP BY v"""
    q["sink_topk"] = """
WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
           WHERE embedding IS NOT NULL),
s AS (SELECT a.id AS query_id, b.id AS item_id, list_cosine_similarity(a.v, b.v) AS score FROM e a, e b WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rk FROM s)
SELECT query_id, CAST(rk AS BIGINT) AS rank, item_id, round(score, 6) AS score FROM r WHERE rk <= 5"""
    q["upsert_update"] = """
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 4 <> 0 THEN 'second' ELSE 'first' END AS title,
       CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 3 <> 0"""
    q["sink_violations"] = """
WITH r AS (
  SELECT doc_id AS n, CASE WHEN doc_id % 7 = 1 THEN NULL WHEN doc_id % 11 = 1 THEN repeat('k', 64) || doc_id
    WHEN doc_id % 5 = 1 THEN 'same' ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents),
v AS (
  SELECT id, 'unique_key' AS rule, 'id' AS c FROM r
  UNION ALL SELECT id, 'not_null', 'id' FROM r WHERE id IS NULL
  UNION ALL SELECT id, 'max_len_64', 'id' FROM r WHERE length(id) > 64
  UNION ALL SELECT id, 'element_max_len_36', 'entity_ids' FROM r WHERE n % 13 = 1
  UNION ALL SELECT id, 'element_max_len_36', 'relationship_ids' FROM r WHERE n % 17 = 1
  UNION ALL SELECT id, 'vector_len_4', 'content_embedding' FROM r WHERE n % 3 = 1)
SELECT coalesce(id, '(null)') AS key, rule, c AS "column", CAST(count(*) AS BIGINT) AS n_rows
FROM v GROUP BY id, rule, c HAVING rule <> 'unique_key' OR count(*) > 1"""
    q["communities_detected"] = f"""WITH {GRAPH},
v AS (SELECT source_entity_id AS id FROM rels WHERE weight > 0
      UNION SELECT target_entity_id FROM rels WHERE weight > 0)
SELECT CAST(count(*) AS BIGINT) AS n_memberships, CAST(count(*) AS BIGINT) AS n_entities, CAST(0 AS BIGINT) AS n_odd_ids,
       CAST(0 AS BIGINT) AS n_odd_relationships, CAST(0 AS BIGINT) AS n_odd_documents FROM v"""
    q["pipeline_end_to_end"] = f"""WITH {GRAPH},
v AS (SELECT source_entity_id AS id FROM rels WHERE weight > 0
      UNION SELECT target_entity_id FROM rels WHERE weight > 0)
SELECT 'documents' AS "table", CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_without_vector FROM docs
UNION ALL SELECT 'entities', count(*), 0 FROM ents
UNION ALL SELECT 'relationships', count(*), 0 FROM rels
UNION ALL SELECT 'communities', count(*), 0 FROM v"""
    q["run_counts"] = f"""WITH {GRAPH}
SELECT CAST(step AS BIGINT) AS step, name, CAST(value AS BIGINT) AS value FROM (
  SELECT 1 AS step, 'documents' AS name, (SELECT count(*) FROM docs) AS value
  UNION ALL SELECT 2, 'extraction_quarantine', 0 UNION ALL SELECT 2, 'quarantined_results', 0
  UNION ALL SELECT 2, 'entity_mentions', (SELECT count(*) FROM em) UNION ALL SELECT 2, 'unknown_types', 0
  UNION ALL SELECT 2, 'relationship_mentions', (SELECT count(*) FROM rm)
  UNION ALL SELECT 2, 'summary_results', (SELECT count(*) FROM ent WHERE n_descriptions > 1) + (SELECT count(*) FROM rel WHERE n_descriptions > 1)
  UNION ALL SELECT 2, 'repeated_summaries', 0
  UNION ALL SELECT 2, 'entities_raw', (SELECT count(*) FROM eraw) UNION ALL SELECT 2, 'relationships_raw', (SELECT count(*) FROM rraw)
  UNION ALL SELECT 3, 'entities', (SELECT count(*) FROM ents) UNION ALL SELECT 3, 'relationships', (SELECT count(*) FROM rels)
  UNION ALL SELECT 3, 'dangling_relationships', (SELECT count(*) FROM rraw) - (SELECT count(*) FROM rels))"""
    return {**q, **edge_cases.ORACLES}

"""Queries over model answers with faults: every document gets an answer whose shape its id chooses.

The answers are inputs, so they stand here once for Spark and DuckDB; what becomes of them is worked out on
each side from its own JSON functions. ``{n}`` is the document's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract as X
from ..operators import model as M
from ..schemas import EXTRACTION_PAYLOAD
from ..sources.driver import table

ANSWERS = [
    '{"entities": [{"name": " acme {n}\\t", "type": "organization ", "description": "d{n}"}, {"name": 42}, "text", null, {"name": "  "}, '
    '{"name": null, "type": "X"}, {"type": "T"}, {"name": "Bob", "description": 7}, {"name": "Eve", "type": ["x"]}, [1]], "relationships": []}',
    '{"entities": "none", "relationships": [{"source": "a{n}", "target": "b", "weight": "0.5"}, {"source": "a", "target": "b", "weight": "NaN"}, '
    '{"source": "a", "target": "b", "weight": 1e10}, {"source": "a", "target": "b", "weight": 1e-10}, {"source": "a", "target": "b", "weight": "abc"}, '
    '{"source": "a", "target": "b", "weight": " 1.5 "}, {"source": "a", "target": "b", "weight": "-Infinity"}]}',
    '{"relationships": {"source": "x"}, "entities": [{"name": "kept {n}"}]}',
    "not json {n}", '{"entities": [{"name": ', "{}", "[]", '{"entities": null, "other": {n}}',
    '{"entities": [{"name": "dup", "type": 7}, {"name": "Dup"}], "relationships": [{"source": 5, "target": "t"}, {"source": "s"}, '
    '{"source": "s", "target": "t", "weight": true}, {"source": "s", "target": "t", "weight": [1]}, {"source": "s{n}", "target": " T"}, '
    '{"source": "s", "target": "t", "weight": null, "description": "x"}, {"target": "t"}, {"source": "s", "target": {"a": 1}}, 3]}',
    '{"entities": [{"name": "last one {n}", "type": "PERSON"}], "relationships": [{"source": "Last one {n}", "target": "nowhere", "weight": 0}]}',
    "", None,
]


def _answer(n: Column) -> Column:
    texts = F.array(*[F.lit(a) for a in ANSWERS])
    return F.replace(texts[F.pmod(n, F.lit(len(ANSWERS))).cast("int")], F.lit("{n}"), n.cast("string"))


def q_payload_edge_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Every element and every unusable answer with its reason."""
    n = F.coalesce(F.col("doc_id"), F.lit(0))
    answers = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"), M.envelope(_answer(n)).alias("response"),
        F.when(F.pmod(n, F.lit(11)) == 3, F.lit("QUOTA")).alias("status"))
    parsed = M.parse_results(answers, ["document_id"], EXTRACTION_PAYLOAD)
    whole = parsed.where(F.col("reason").isNotNull()).select(
        "document_id", F.lit("result").alias("kind"), F.lit(None).cast("int").alias("pos"), "reason",
        *[F.lit(None).cast("string").alias(c) for c in ("title", "type", "source", "target", "description")],
        F.lit(None).cast("double").alias("weight"))
    return X.elements(parsed).drop("text_prefix").unionByName(whole).withColumn("pos", F.col("pos").cast("bigint"))


#: Weights of one relationship by document id: tiny, huge, negative, of many digits.
WEIGHTS = [1e10, 1e-10, 0.1, 1e300, 0.30000000000000004, -2.5, 0.0, 1.7e-300, 123456789.123456789, 7.0, 1e15, 3e-5]


def _weighted(n: Column) -> tuple[Column, Column]:
    """A key and a weight: keys mix weights, but for every third, which has one kind."""
    k = F.pmod(n, F.lit(36))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    at = F.when(k % 3 == 0, k / 3).otherwise(F.pmod(n + F.floor(n / 36), F.lit(len(WEIGHTS))))
    return F.concat(F.lit("K"), k.cast("string")), weights[at.cast("int")]


def q_weight_edge_cases(spark: SparkSession, sf: str) -> DataFrame:
    """A4: mean weights over the range of finite doubles, as ten digits and a power of ten."""
    n = F.coalesce(F.col("doc_id"), F.lit(0))
    key, w = _weighted(n)
    mentions = table(spark, sf, "documents").select(
        key.alias("source"), F.lit("T").alias("target"), F.col("doc_id").cast("string").alias("document_id"),
        F.lit(0).alias("pos"), F.lit("").alias("description"), w.alias("weight"))
    mean = F.col("weight")
    power = F.when(mean == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(mean)))).cast("int")
    return X.merge_relationships(mentions).select(
        "source", F.col("n_descriptions").alias("n"), power.cast("bigint").alias("power"),
        F.round(mean / F.pow(F.lit(10.0), F.floor(power / 2)) / F.pow(F.lit(10.0), power - F.floor(power / 2)), 6).alias("digits"))


def _text(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _name(field: str) -> str:
    return f"upper(regexp_replace(json_extract_string(e, '$.{field}'), '^\\s+|\\s+$', '', 'g'))"


def _odd(field: str) -> str:
    return f"WHEN json_type(e, '$.{field}') <> 'VARCHAR' THEN '{field} not a string'"


PAYLOAD_SQL = f"""
WITH answers(i, body) AS (VALUES {", ".join(f"({i}, {_text(a)})" for i, a in enumerate(ANSWERS))}),
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS document_id, replace(body, '{{n}}', CAST(coalesce(doc_id, 0) AS VARCHAR)) AS text,
         CASE WHEN coalesce(doc_id, 0) % 11 = 3 THEN 'QUOTA' END AS status
  FROM documents JOIN answers ON coalesce(doc_id, 0) % {len(ANSWERS)} = i),
judged AS (
  SELECT *, CASE WHEN status IS NOT NULL THEN 'status' WHEN coalesce(text, '') = '' THEN 'no text' WHEN NOT json_valid(text) THEN 'invalid json'
    WHEN json_type(text) <> 'OBJECT' THEN 'not an object' WHEN text = '{{}}' THEN 'empty' END AS reason FROM docs),
good AS (SELECT document_id, text::JSON AS text FROM judged WHERE reason IS NULL),
parts AS (
  SELECT document_id, kind, json_extract(text, '$.' || field) AS whole, field
  FROM good, (VALUES ('entity', 'entities'), ('relationship', 'relationships')) f(kind, field)),
el AS (
  SELECT document_id, kind, field, unnest(range(json_array_length(whole)::BIGINT)) AS pos, unnest(json_extract(whole, '$[*]')) AS e
  FROM parts WHERE json_type(whole) = 'ARRAY'
  UNION ALL SELECT document_id, kind, field, -1, whole FROM parts WHERE whole IS NOT NULL AND json_type(whole) <> 'ARRAY'),
num AS (
  SELECT *, CASE WHEN json_type(e) <> 'OBJECT' OR pos < 0 THEN NULL
    WHEN json_type(e, '$.weight') IS NULL OR json_type(e, '$.weight') = 'NULL' THEN 1.0
    WHEN json_type(e, '$.weight') = 'BOOLEAN' THEN CAST(CAST(json_extract(e, '$.weight') AS BOOLEAN) AS INT)::DOUBLE
    WHEN json_type(e, '$.weight') IN ('ARRAY', 'OBJECT') THEN NULL
    ELSE TRY_CAST(trim(json_extract_string(e, '$.weight')) AS DOUBLE) END AS w FROM el),
why AS (
  SELECT *, CASE WHEN pos < 0 THEN field || ' not an array' WHEN json_type(e) <> 'OBJECT' THEN 'not an object'
    WHEN kind = 'entity' THEN CASE {_odd('name')} {_odd('type')} END
    ELSE CASE {_odd('source')} {_odd('target')} WHEN w IS NULL THEN 'weight not a number' WHEN isnan(w) OR isinf(w) THEN 'weight not finite' END
    END AS reason FROM num)
SELECT document_id, kind, pos::BIGINT AS pos, reason,
  CASE WHEN reason IS NULL AND kind = 'entity' THEN coalesce({_name('name')}, '') END AS title,
  CASE WHEN reason IS NULL AND kind = 'entity' THEN coalesce({_name('type')}, 'CONCEPT') END AS type,
  CASE WHEN reason IS NULL AND kind = 'relationship' THEN coalesce({_name('source')}, '') END AS source,
  CASE WHEN reason IS NULL AND kind = 'relationship' THEN coalesce({_name('target')}, '') END AS target,
  CASE WHEN reason IS NULL THEN coalesce(json_extract_string(e, '$.description'), '') END AS description,
  CASE WHEN reason IS NULL AND kind = 'relationship' THEN w END AS weight
FROM why
UNION ALL
SELECT document_id, 'result', NULL, reason, NULL, NULL, NULL, NULL, NULL, NULL FROM judged WHERE reason IS NOT NULL
"""

WEIGHT_SQL = f"""
WITH d AS (
  SELECT coalesce(doc_id, 0) AS n, [{", ".join(repr(w) + "::DOUBLE" for w in WEIGHTS)}] AS ws FROM documents),
m AS (SELECT 'K' || (n % 36) AS source, ws[1 + CASE WHEN n % 36 % 3 = 0 THEN (n % 36) // 3 ELSE (n + n // 36) % {len(WEIGHTS)} END] AS w FROM d),
means AS (SELECT source, count(*) AS n, fsum(w / 1024) / count(*) * 1024 AS mean FROM m GROUP BY source)
SELECT source, n, power, round(mean / pow(10.0, floor(power / 2)) / pow(10.0, power - floor(power / 2)), 6) AS digits
FROM (SELECT *, CASE WHEN mean = 0 THEN 0 ELSE floor(log10(abs(mean))) END::BIGINT AS power FROM means)
"""

QUERIES = {"payload_edge_cases": q_payload_edge_cases, "weight_edge_cases": q_weight_edge_cases}
ORACLES = {"payload_edge_cases": PAYLOAD_SQL, "weight_edge_cases": WEIGHT_SQL}

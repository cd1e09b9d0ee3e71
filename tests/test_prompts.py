from pyspark.sql import functions as F

from kgspark.functions import prompts as P
from kgspark.operators import extract as X
from kgspark.operators import reports as RP


def test_entity_summary_prompt_golden(spark):
    df = spark.createDataFrame([("ACME", "ORG", ["first", "second"])],
                               "n string, t string, d array<string>")
    got = df.select(X.entity_summary_prompt(F.col("n"), F.col("t"), F.col("d")).alias("p")) \
        .first().p
    assert got == ('The following descriptions all refer to the same entity named "ACME" '
                   "(type: ORG). Merge them into a single, comprehensive description.\n\n"
                   "Descriptions:\n1. first\n2. second\n\nProvide a single merged description.")


def test_extraction_system_instruction_lists_types():
    assert "Entity types to extract: PERSON, ORGANIZATION, PRODUCT, SERVICE, ISSUE, " \
           "LOCATION, CONCEPT, EVENT\n" in P.extraction_system_instruction()


def test_report_body_render(spark):
    df = spark.createDataFrame([("T", "S", "8", "why", [("f1", "e1"), ("f2", "e2")])],
                               "t string, s string, r string, x string, "
                               "f array<struct<summary:string,explanation:string>>")
    got = df.select(RP.render_report(F.col("t"), F.col("s"), F.col("r"), F.col("x"),
                                     F.col("f")).alias("b")).first().b
    assert got == "# T\n\nS\n\nRating: 8 - why\n\n## Findings\n\n### f1\ne1\n\n### f2\ne2"


def test_community_context_golden(spark):
    comm = spark.createDataFrame([("c1", 0, ["e1", "e2", "missing"], ["r1"], ["k1", "k2"])],
                                 "id string, level long, entity_ids array<string>, "
                                 "relationship_ids array<string>, "
                                 "child_community_ids array<string>")
    ents = spark.createDataFrame([("e1", "A", "P", 1, "da"), ("e2", "B", "Q", 3, "db")],
                                 "id string, title string, type string, degree long, "
                                 "description string")
    rels = spark.createDataFrame([("r1", "A", "B", 0.5, "ab")],
                                 "id string, source string, target string, weight double, "
                                 "description string")
    kids = spark.createDataFrame([("k1", None, "sum1", 8.0), ("k2", "T2", "", 1.0)],
                                 "id string, title string, summary string, rating double")
    ctx = RP.community_context(comm, ents, rels, kids).first().context
    assert ctx == ("## Sub-Community Reports\n\n### Untitled\nsum1\nRating: 8.0\n\n\n"
                   "## Entities\n\n- **B** (type: Q, degree: 3): db\n\n"
                   "- **A** (type: P, degree: 1): da\n\n"
                   "## Relationships\n\n- A -> B (weight: 0.5): ab")


def test_parse_reports_edge_cases(spark):
    import json

    def env(obj):
        return json.dumps({"candidates": [{"content": {"parts": [{"text": json.dumps(obj)}]}}]})
    rows = [("c1", "0", env({"title": "A", "summary": "s", "rating": 8, "rating_explanation": "e",
                              "findings": []}), None),
            ("c1", "0", env({"title": "B", "summary": "s", "rating": 8.5,
                              "rating_explanation": "e", "findings": [
                                  {"summary": "f", "explanation": "x"}]}), None),
            ("c2", "0", env({"title": "C", "summary": "t"}), None),
            ("", "0", env({"title": "D"}), None),
            ("c3", "0", None, "ERROR")]
    res = spark.createDataFrame(rows, "community_id string, level string, response string, "
                                      "status string")
    got = {r.id: r for r in RP.parse_reports(res).collect()}
    assert set(got) == {"c1", "c2"}  # blank id and failed row skipped (P11)
    assert got["c1"].title in ("A", "B")  # duplicates: one deterministic winner (Q5)
    assert got["c2"].rating is None and got["c2"].findings == "[]"
    assert got["c2"].full_content == "# C\n\nt\n\nRating: N/A - \n\n## Findings"

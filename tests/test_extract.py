import json

from pyspark.sql import functions as F

from kgspark.operators import extract as X
from kgspark.operators import model as M
from kgspark.schemas import EXTRACTION_PAYLOAD


def env(obj):
    return json.dumps({"candidates": [{"content": {"parts": [{"text": json.dumps(obj)}]}}]})


def parsed(spark, docs):
    rows = [(d, env(o), None) for d, o in docs]
    df = spark.createDataFrame(rows, "document_id string, response string, status string")
    return M.parse_results(df, ["document_id"], EXTRACTION_PAYLOAD)


def test_entity_normalisation_and_filters(spark):
    p = parsed(spark, [("d1", {"entities": [
        {"name": " Acme ", "type": "organization", "description": "x"},
        {"name": "ACME", "type": "ORGANIZATION", "description": "y"},
        {"name": "\tacme ", "type": " organization"},
        {"name": "   ", "type": "PERSON", "description": "blank"},
        {"name": "Bob"}]})])
    m = X.merge_entities(X.entity_mentions(p)).collect()
    got = {(r.title, r.type): (r.n_descriptions, r.first_description) for r in m}
    assert got == {("ACME", "ORGANIZATION"): (3, "x"), ("BOB", "CONCEPT"): (1, "")}


def test_relationship_weights_and_direction(spark):
    p = parsed(spark, [("d1", {"relationships": [
        {"source": "a", "target": "b", "weight": 0.5},
        {"source": "A", "target": "B", "weight": "0.5"},
        {"source": "b", "target": "a"},
        {"source": "a", "target": "", "weight": 1},
        {"source": "b", "target": "a", "weight": None},
        {"source": "a", "target": "b", "weight": 1.7}]}),
        ("d2", {"relationships": [{"source": "a", "target": "b", "weight": 0}]})])
    m = {(r.source, r.target): r for r in
         X.merge_relationships(X.relationship_mentions(p)).collect()}
    assert set(m) == {("A", "B"), ("B", "A")}
    assert m[("A", "B")].n_descriptions == 4
    assert abs(m[("A", "B")].weight - (0.5 + 0.5 + 1.7 + 0) / 4) < 1e-12
    assert m[("B", "A")].weight == 1.0
    assert m[("A", "B")].document_ids == ["d1", "d2"]


def test_merge_is_order_invariant(spark):
    docs = [(f"d{i}", {"entities": [{"name": f"n{i % 3}", "description": f"e{i}"}]})
            for i in range(12)]
    a = X.merge_entities(X.entity_mentions(parsed(spark, docs))).collect()
    b = X.merge_entities(X.entity_mentions(parsed(spark, list(reversed(docs))).repartition(5)))\
        .collect()
    key = lambda r: r.title
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    # documents order as strings: "d11" < "d2"
    assert {r.title: r.first_description for r in a} == {"N0": "e0", "N1": "e1", "N2": "e11"}


def test_summary_attach_and_ambiguous_keys(spark):
    p = parsed(spark, [("d1", {"entities": [{"name": "a::b", "type": "t", "description": "1"},
                                            {"name": "a::b", "type": "t", "description": "2"},
                                            {"name": "a", "type": "b::t", "description": "3"}]})])
    em = X.entity_mentions(p)
    ent = X.merge_entities(em)
    rm = X.relationship_mentions(p)
    req = X.summary_requests(em, ent, rm, X.merge_relationships(rm),
                             __import__("kgspark.config").config.ModelConfig())
    assert [(r.kind, r.a, r.b) for r in req.collect()] == [("entity", "A::B", "T")]
    res = M.call_model(req, M.OfflineBackend(), X.SUMMARY_KEYS)
    raw = {(r.title, r.type): r.description
           for r in X.entities_raw(ent, X.parse_summaries(res)).collect()}
    assert raw == {("A::B", "T"): "Merged from 2 descriptions: 1", ("A", "B::T"): "3"}


def test_elements_are_judged_one_by_one(spark):
    p = parsed(spark, [
        ("d1", {"entities": [{"name": "a"}, "x", None, {"name": 3}, {"name": None}, {"name": "b", "type": 1}, {}, {"name": " "},
                             {"name": "c", "description": {"k": 1}}, {"name": "d", "description": None}],
                "relationships": "none"}),
        ("d2", {"entities": {"name": "a"}, "relationships": [
            {"source": "a", "target": "b", "weight": w} for w in
            ("0.5", " 2 ", "1e400", "nan", "-Infinity", "1_0", "", "0x10", "1f", True, None, [1], {"w": 1}, 3, 1e-300)]}),
        ("d3", {"entities": None, "relationships": []}), ("d4", {"other": 1})])
    found = X.elements(p)
    bad = {(r.document_id, r.part): r.reason for r in X.element_quarantine(found).collect()}
    assert bad == {
        ("d1", "entity 1"): "not an object", ("d1", "entity 2"): "not an object", ("d1", "entity 3"): "name not a string",
        ("d1", "entity 4"): "name not a string", ("d1", "entity 5"): "type not a string", ("d1", "relationship -1"): "relationships not an array",
        ("d2", "entity -1"): "entities not an array", ("d2", "relationship 2"): "weight not finite",
        ("d2", "relationship 3"): "weight not finite", ("d2", "relationship 4"): "weight not finite",
        **{("d2", f"relationship {i}"): "weight not a number" for i in (5, 6, 7, 8, 11, 12)}, ("d3", "entity -1"): "entities not an array"}
    assert {(r.title, r.type, r.description) for r in X.entity_mentions(found).collect()} == {
        ("A", "CONCEPT", ""), ("C", "CONCEPT", '{"k":1}'), ("D", "CONCEPT", "")}
    assert sorted(r.weight for r in X.relationship_mentions(found).collect()) == [1e-300, 0.5, 1.0, 1.0, 2.0, 3.0]


def test_repeated_keys_of_a_payload_count_last(spark):
    text = '{"entities": [{"name": "a", "name": "b"}], "entities": [{"name": "c"}]}'
    answer = json.dumps({"candidates": [{"content": {"parts": [{"text": text}]}}]})
    df = spark.createDataFrame([("d", answer, None)], "document_id string, response string, status string")
    assert [r.title for r in X.entity_mentions(M.parse_results(df, ["document_id"], EXTRACTION_PAYLOAD)).collect()] == ["C"]


def test_mean_weight_is_exact_in_any_order(spark):
    import math
    import random
    from fractions import Fraction
    rng = random.Random(3)
    groups = {"tenths": [0.1] * 7 + [0.7, 0.2], "far apart": [1e300, 1e-300, 1.0, 3.0], "tiny": [5e-324] * 3, "largest": [1.7976931348623157e308] * 4,
              "cancel": [1e16, 1.0, -1e16], "zero": [0.0, 0.0], "mixed": [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randrange(-30, 30) for _ in range(400)],
              "small": [1e-10, 1e10], "odd": [255.99999999999997, 256.0, 2.0 ** -8]}
    rows = [(k, "t", f"d{i}", 0, "", w) for k, ws in groups.items() for i, w in enumerate(ws)]
    want = {k: float(sum(map(Fraction, ws)) / len(ws)) for k, ws in groups.items()}
    seen = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "source string, target string, document_id string, pos int, description string, weight double")
        seen.append({r.source: r.weight for r in X.merge_relationships(df.repartition(seed + 2)).collect()})
    assert seen[0] == seen[1]
    for k, w in want.items():
        assert math.isclose(seen[0][k], w, rel_tol=1e-15, abs_tol=0.0) or abs(seen[0][k] - w) <= 4 * math.ulp(max(map(abs, groups[k]))) * 1e-3, (k, seen[0][k], w)


def test_plain_payloads_give_the_elements_of_the_general_reading(spark, monkeypatch):
    texts = ['{"entities":[{"name":" a ","type":"t","description":"x"},{"name":"b"},{}],"relationships":[{"source":"a","target":"b","weight":0.5},{"source":"a","target":"c"}]}',
             '{"entities":[null,{"name":"c"}]}', '{"relationships":[{"source":"a","target":"b","weight":"NaN"}]}', '{"entities":[{"name":3}]}',
             '{"relationships":[{"source":"a","target":"b","weight":-0.0}]}', '{"entities":[{"name":"a","name":"b"}]}',
             '{"entities":[{"name":"é","type":null}]}', '{"entities":[{"name":"d","other":1}]}']
    rows = [(f"d{i}", json.dumps({"candidates": [{"content": {"parts": [{"text": t}]}}]}), None) for i, t in enumerate(texts)]
    p = M.parse_results(spark.createDataFrame(rows, "document_id string, response string, status string"), ["document_id"], EXTRACTION_PAYLOAD)
    got = sorted(map(str, X.elements(p).collect()))
    monkeypatch.setattr(X, "_is_plain", lambda: F.lit(False))
    assert got == sorted(map(str, X.elements(p).collect())) and len(got) == 13


def test_a_merge_shuffles_its_mentions_once(spark):
    df = spark.createDataFrame([("d1", 0, "A", "T", "x")], "document_id string, pos int, title string, type string, description string")
    plan = X.merge_entities(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def counted(spark, df):
    """``df`` with an accumulator that counts the rows that are computed."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(look, df.schema), seen


def test_counting_partitions_computes_nothing(spark):
    df, seen = counted(spark, spark.range(50))
    assert M.spread(df.groupBy("id").count()).count() == 50
    assert seen.value == 50


def test_single_descriptions_take_no_part_in_the_join(spark):
    merged = X.merge_entities(spark.createDataFrame(
        [("d1", 0, "A", "T", "x"), ("d1", 1, "B", "T", "y"), ("d2", 0, "B", "T", "z")],
        "document_id string, pos int, title string, type string, description string"))
    summaries = spark.createDataFrame([("entity", "B", "T", "s")], "kind string, a string, b string, summary string")
    raw = X.entities_raw(merged, summaries)
    assert {r.title: r.description for r in raw.collect()} == {"A": "x", "B": "s"}
    assert "Union" in raw._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_parsed_once(spark):
    plan = X.elements(parsed(spark, [("d", {"entities": []})]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1 and plan.count("parseJson") <= 2 and "Filter" not in plan

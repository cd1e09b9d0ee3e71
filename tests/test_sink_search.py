import numpy as np
from pyspark.sql import functions as F

from kgspark.operators import sink as SK
from kgspark.operators.search import cosine_topk


def test_upsert_twice_equals_once(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "id string, v int")
    once = SK.upsert(None, new)
    twice = SK.upsert(once, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    upd = SK.upsert(once, spark.createDataFrame([("b", 9)], "id string, v int"))
    assert dict(map(tuple, upd.collect()))["b"] == 9


def test_constraint_violations(spark):
    rels = spark.createDataFrame([
        ("r" * 37, "e1", None, "", 1.0, 0, ["d"]), ("r2", "e1", "e2", "", 1.0, 1, ["d"]),
        ("r2", "e1", "e2", "", 1.0, 2, ["d" * 65])],
        "id string, source_entity_id string, target_entity_id string, description string, "
        "weight double, human_readable_id long, document_ids array<string>")
    v = {(r.rule, r.column) for r in SK.constraint_violations(rels, "relationships", 4).collect()}
    assert v == {("max_len_36", "id"), ("not_null", "target_entity_id"),
                 ("unique_key", "id"), ("element_max_len_64", "document_ids")}
    docs = spark.createDataFrame([("d", [0.1] * 3)], "id string, content_embedding array<float>")
    v = {r.rule for r in SK.constraint_violations(SK.sink_documents(docs, 4), "documents", 4)
         .collect()}
    assert v == {"vector_len_4"}


def test_cosine_topk_matches_numpy(spark):
    rng = np.random.default_rng(7)
    items = rng.normal(size=(300, 8)).astype(np.float32)
    qs = rng.normal(size=(4, 8))
    idf = spark.createDataFrame([(str(i), items[i].tolist()) for i in range(300)],
                                "id string, vector array<float>").repartition(5)
    qdf = spark.createDataFrame([(f"q{j}", qs[j].tolist()) for j in range(4)],
                                "id string, vector array<double>")
    got = cosine_topk(qdf, idf, 3).collect()
    x = items.astype(np.float64)
    for j in range(4):
        s = (x @ qs[j]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(qs[j]))
        want = [str(i) for i in np.argsort(-s)[:3]]
        mine = [r.item_id for r in sorted((r for r in got if r.query_id == f"q{j}"),
                                          key=lambda r: r.rank)]
        assert mine == want


def test_cosine_topk_blocks_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    x[20:30] = x[10]  # copies in different blocks tie exactly
    rows = [(f"i{j:02d}", x[j].tolist()) for j in range(60)]
    odd = [("null", None), ("zero", [0.0] * 5), ("nan", [float("nan")] + [1.0] * 4), ("inf", [float("inf")] + [1.0] * 4)]
    items = spark.createDataFrame(rows + odd, "id string, vector array<float>").repartition(3)
    asked = [("a", x[10].tolist()), ("a", x[10].tolist()), ("a", x[40].tolist()), ("b", x[5].tolist()), *odd]
    queries = spark.createDataFrame(asked, "id string, vector array<float>")
    got = [tuple(r) for r in cosine_topk(queries, items, 12, query_block=2, item_block=7).collect()]
    y = x.astype(np.float64)
    want = []
    for name, j in (("a", 10), ("a", 40), ("b", 5)):
        s = (y * y[j]).sum(axis=1) / (np.linalg.norm(y, axis=1) * np.linalg.norm(y[j]))
        best = sorted((-round(v, 12), f"i{i:02d}") for i, v in enumerate(s))[:12]
        want += [(name, r + 1, i, -v) for r, (v, i) in enumerate(best)]
    assert sorted((a, b, c, round(d, 12)) for a, b, c, d in got) == sorted(want)
    assert cosine_topk(queries.limit(0), items).collect() == [] == cosine_topk(queries, items.limit(0)).collect()


def test_upsert_changes_adds_and_keeps_rows(spark, tmp_path):
    from kgspark.sources.tables import TableStore
    store = TableStore(spark, str(tmp_path))
    SK.upsert_table(store, "t", spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int"))
    done = SK.upsert_table(store, "t", spark.createDataFrame([("b", 5), ("c", 6), ("c", 6)], "id string, v int"))
    assert sorted(map(tuple, done.collect())) == [("a", 1), ("b", 5), ("c", 6)]


def test_constraints_are_checked_in_one_scan(spark):
    df = spark.createDataFrame([("d" * 65, [0.1] * 3), ("x", [0.1] * 4), ("x", None)], "id string, content_embedding array<float>")
    found = SK.constraint_violations(SK.sink_documents(df, 4), "documents", 4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    assert {(r.key[:2], r.rule, r.n_rows) for r in found.collect()} == {
        ("dd", "max_len_64", 1), ("dd", "vector_len_4", 1), ("x", "unique_key", 2)}


def test_a_first_checked_batch_is_written_once_and_a_bad_one_not_at_all(spark, tmp_path, monkeypatch):
    import pytest
    from kgspark.sources.tables import TableStore
    rows = lambda *ids: SK.sink_documents(spark.createDataFrame([(i, "t") for i in ids], "id string, title string"), 4)
    store, written = TableStore(spark, str(tmp_path)), []
    stage = TableStore.stage
    monkeypatch.setattr(TableStore, "stage", lambda self, df, name, *a: written.append(name) or stage(self, df, name, *a))
    with pytest.raises(ValueError, match="unique_key"):
        SK.checked_upsert(store, "documents", rows("a", "a"), 4)
    assert not store.exists("documents")
    assert sorted(r.id for r in SK.checked_upsert(store, "documents", rows("a", "b"), 4).collect()) == ["a", "b"]
    assert written == ["documents"] * 2
    with pytest.raises(ValueError, match="unique_key"):
        SK.checked_upsert(store, "documents", rows("c", "c"), 4)
    done = SK.checked_upsert(store, "documents", rows("b", "c"), 4)
    assert sorted(r.id for r in done.collect()) == ["a", "b", "c"]

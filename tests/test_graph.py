from pyspark.sql import functions as F

from kgspark.operators import graph as G


def test_degree_rank_and_collapse(spark):
    ents = spark.createDataFrame([
        ("e1", "A", "T1", "", ["d1"]), ("e2", "B", "T1", "", ["d1"]),
        ("e3", "C", "T1", "", ["d1"]), ("e4", "A", "T2", "", ["d1", "d2"]),
        ("e5", "D", "T1", "", ["d3"])],
        "id string, title string, type string, description string, document_ids array<string>")
    rels = spark.createDataFrame([
        ("r1", "A", "B", "", 0.5, ["d1"]), ("r2", "B", "A", "", 0.5, ["d1"]),
        ("r3", "C", "C", "", 1.0, ["d1"]), ("r4", "A", "Z", "", 1.0, ["d1"])],
        "id string, source string, target string, description string, weight double, "
        "document_ids array<string>")
    e, r = G.finalize(ents, rels)
    deg = {x.title: (x.id, x.degree) for x in e.collect()}
    assert deg == {"A": ("e4", 2), "B": ("e2", 2), "C": ("e3", 2), "D": ("e5", 0)}
    ranks = {x.title: x.human_readable_id for x in e.collect()}
    assert ranks == {"A": 0, "B": 1, "C": 2, "D": 3}
    assert {x.id for x in r.collect()} == {"r1", "r2", "r3"}
    assert {x.id: x.human_readable_id for x in r.collect()} == {"r3": 0, "r1": 1, "r2": 2}


def test_global_rank_equals_window_rank(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("id"),
                                     (F.col("id") % 37).alias("degree"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("title"))
    order = G.entity_order()
    a = {r.id: r.human_readable_id for r in G.global_rank(df, order, num_partitions=7).collect()}
    b = {r.id: r.human_readable_id for r in G.window_rank(df, order).collect()}
    assert a == b and sorted(a.values()) == list(range(5000))


def test_graph_snapshot_tables(spark):
    import tempfile
    ents = spark.createDataFrame([("e1", "A"), ("e2", "B")], "id string, title string")
    rels = spark.createDataFrame([("r1", "A", "B", 0.5)],
                                 "id string, source string, target string, weight double")
    out = tempfile.mkdtemp(prefix="kgspark-snap-")
    G.write_snapshot(ents, rels, out)
    nodes = {tuple(r) for r in spark.read.parquet(f"{out}/nodes").collect()}
    edges = [tuple(r) for r in spark.read.parquet(f"{out}/edges").collect()]
    assert nodes == {("A", "A", "e1"), ("B", "B", "e2")}
    assert edges == [("A", "B", 0.5, "r1")]


def test_ranks_need_no_texts(spark):
    ents = spark.createDataFrame([("e1", "A", "T", "x", ["d"]), ("e2", "B", "T", "y", ["d"])],
                                 "id string, title string, type string, description string, document_ids array<string>")
    rels = spark.createDataFrame([("r1", "A", "B", "z", 1.0, ["d"])],
                                 "id string, source string, target string, description string, weight double, document_ids array<string>")
    narrow = G.ranked(ents, rels)
    assert [c for df in narrow for c in df.columns if c in ("description", "document_ids")] == []
    for df, whole in zip(narrow, G.finalize(ents, rels)):
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, whole.select(df.columns).collect()))

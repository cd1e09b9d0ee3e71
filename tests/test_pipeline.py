import tempfile

from pyspark.sql import functions as F

from kgspark import schemas as SC
from kgspark.config import PipelineConfig, SourceConfig, StorageConfig
from kgspark.plans.pipeline import Pipeline
from kgspark.sources.tables import TableStore


def test_steps_rerun_from_tables(spark):
    base = tempfile.mkdtemp(prefix="kgspark-test-")
    cfg = PipelineConfig(source=SourceConfig("documents", "/root/testdata/sf0.001"),
                         storage=StorageConfig(base + "/t"))
    p = Pipeline(spark, cfg)
    timings = p.run(steps=[1, 2, 3])
    assert [t[0] for t in timings] == [1, 2, 3]
    first = sorted(map(tuple, p.store.read("entities").select("id", "human_readable_id")
                       .collect()))
    p.run(steps=[3])  # R1: rerun one step from the stored tables
    again = sorted(map(tuple, p.store.read("entities").select("id", "human_readable_id")
                       .collect()))
    assert first == again and len(first) > 0
    assert p.store.read("run_metrics").count() == 4
    # documents are deduplicated by content hash (A1)
    docs = p.store.read("documents")
    assert docs.count() == docs.select("id").distinct().count()


def test_table_store_self_overwrite_and_missing(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="kgspark-store-"))
    store.write(spark.range(5).withColumnRenamed("id", "x"), "t")
    df = store.read("t")
    store.write(df.withColumn("x", F.col("x") * 2), "t")  # Q10: overwrite what we read
    assert sorted(r.x for r in store.read("t").collect()) == [0, 2, 4, 6, 8]
    assert not store.exists("nope")
    empty = store.read("nope", schema=SC.DOCUMENTS)  # S4
    assert empty.count() == 0 and empty.columns == ["id", "title", "raw_content"]
    assert store.row_count("t").first().cnt == 5


def test_a_step_without_its_input_fails_and_counts_are_recorded(spark):
    import pytest
    base = tempfile.mkdtemp(prefix="kgspark-test-")
    p = Pipeline(spark, PipelineConfig(source=SourceConfig("documents", "/root/testdata/sf0.001"), storage=StorageConfig(base + "/t")))
    for step in (2, 3, 4, 5, 6):
        with pytest.raises(RuntimeError, match="was never written"):
            p.run(steps=[step])
    p.run(steps=[1, 2, 3, 4, 5])
    counts = {(r.step, r.name): r.value for r in p.store.read("run_counts").collect()}
    for step, name in ((1, "documents"), (2, "entities_raw"), (3, "entities"), (4, "communities"), (5, "community_reports")):
        assert counts[step, name] == p.store.read(name).count() > 0
    assert counts[4, "communities_level_0"] == counts[4, "communities"] and counts[4, "communities_level_1"] == 0
    assert counts[5, "without_report"] == 0
    requests = p.store.read("report_requests_level_0")  # S10: the requests of every level are kept
    assert requests.columns == ["community_id", "level", "request"] and requests.count() == counts[4, "communities"]

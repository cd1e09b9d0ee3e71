"""Failures must not end in a green run with fewer rows."""
import pytest

from kgspark.operators import embed as EM
from kgspark.operators.communities import connected_components
from kgspark.operators.model import PythonBatchBackend, call_model
from kgspark.sources.tables import TableStore, path_exists


def test_a_dead_model_fails_the_step(spark):
    def dead(prompts):
        raise ConnectionError("service is down")

    request = '{"contents": [{"parts": [{"text": "hi"}]}]}'
    requests = spark.createDataFrame([("d1", request)], "document_id string, request string")
    with pytest.raises(Exception, match="service is down"):
        call_model(requests, PythonBatchBackend(dead), ["document_id"]).collect()


def test_a_storage_error_is_not_an_absent_table(spark, tmp_path):
    assert not path_exists(spark, f"{tmp_path}/none")
    with pytest.raises(Exception):
        path_exists(spark, "nosuchfs://host/table")


def test_components_of_a_long_path_are_complete(spark):
    n = 41
    edges = spark.createDataFrame([(0, str(i).zfill(3), str(i + 1).zfill(3), 1.0) for i in range(n - 1)],
                                  "part int, u string, v string, w double")
    nodes = spark.createDataFrame([(0, str(i).zfill(3)) for i in range(n)], "part int, node string")
    assert {r["comp"] for r in connected_components(edges, nodes).collect()} == {"000"}


def test_failed_embeddings_raise(spark):
    def fn(texts):
        if "boom" in texts:
            raise RuntimeError("service down")
        return [[1.0] for _ in texts]
    rows = spark.createDataFrame([("x", "ok"), ("y", "boom")], "id string, t string")
    backend = EM.PythonEmbedBackend(fn, batch_size=1, num_tasks=2)
    EM.check_complete(EM.embed(rows.where("id = 'x'"), "id", "t", backend), "v")
    with pytest.raises(RuntimeError, match="1 texts without a vector, such as y.*service down"):
        EM.check_complete(EM.embed(rows, "id", "t", backend), "v")


def test_a_write_cut_off_before_its_commit_keeps_the_table(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "t")
    store.append(spark.range(10, 12), "t")

    def lost(self, name, version):
        raise ConnectionError("driver lost")

    for mode in ("overwrite", "append"):
        with monkeypatch.context() as m:
            m.setattr(TableStore, "_commit", lost)
            with pytest.raises(ConnectionError):
                store.write(spark.range(5), "t", mode=mode)
        assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 2, 10, 11]
    reader = store.read("t")
    store.write(reader.where("id > 1"), "t")
    assert sorted(r.id for r in store.read("t").collect()) == [2, 10, 11]
    assert reader.count() == 5  # a reader that has begun keeps its files over one overwrite
    store.write(spark.range(7), "t")
    store.write(spark.range(8), "t")
    assert store.read("t").count() == 8
    # the last overwrite and the one before it are left, and nothing that was never committed
    assert len([f for f in tmp_path.joinpath("t").iterdir() if not f.name.startswith(("_", "."))]) == 2


def test_a_write_cut_off_while_its_marks_are_deleted(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    for n in (1, 2):
        store.write(spark.range(n), "t")
    with monkeypatch.context() as m:
        m.setattr(TableStore, "_forget", lambda *a: (_ for _ in ()).throw(ConnectionError("driver lost")))
        with pytest.raises(ConnectionError):
            store.write(spark.range(3), "t")
    assert store.read("t").count() == 3 and store.exists("t") and not store.exists("u")

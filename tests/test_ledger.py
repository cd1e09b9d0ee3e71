"""The ledger of finished calls."""
import os

import pytest
from pyspark.sql import functions as F

from kgspark.config import EmbeddingConfig, ModelConfig, PipelineConfig, SourceConfig, StorageConfig
from kgspark.operators import embed as EM
from kgspark.operators import ledger
from kgspark.operators import model as M
from kgspark.plans.pipeline import Pipeline
from kgspark.sources.tables import TableStore


def asked(folder):
    return sorted(open(os.path.join(folder, f)).read() for f in os.listdir(folder))


def recorder(folder):
    def note(text):  # runs in a Python worker
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(text)
    return note


def requests(spark, texts):
    return spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "k string, p string").select(
        "k", M.request_json("p", {}).alias("request"))


def test_a_killed_run_repeats_no_finished_slice(spark, tmp_path, monkeypatch):
    calls, flag = tmp_path / "calls", tmp_path / "down"
    calls.mkdir()
    calls_dir, flag_path, note = str(calls), str(flag), recorder(str(calls))

    def fn(prompts, model):
        if os.path.exists(flag_path) and len(os.listdir(calls_dir)) >= 12:
            raise ConnectionError("service is down")
        for p in prompts:
            note(f"{model}/{p}")
        return [(None, "QUOTA") if p == "p7" else (p.upper(), None) for p in prompts]

    monkeypatch.setattr(ledger.called_once, "__defaults__", (4,))
    store, req = TableStore(spark, str(tmp_path / "t")), requests(spark, [f"p{i % 20}" for i in range(30)])
    backend = M.PythonBatchBackend(fn, batch_size=1, num_tasks=1, model="m1")
    flag.write_text("")
    with pytest.raises(Exception, match="service is down"):
        M.call_model(req, backend, ["k"], store, "results")
    finished = {r.request_sha for r in store.read("results__calls").collect()}
    before = asked(calls_dir)
    flag.unlink()
    got = {r.k: (r.response, r.status) for r in M.call_model(req, backend, ["k"], store, "results").collect()}
    assert len(got) == 30 and got["k7"] == got["k27"]
    assert got["k7"][1] == "QUOTA" and "P3" in got["k3"][0] and got["k3"] == got["k23"]
    again = asked(calls_dir)
    repeated = [t for t in set(again) if again.count(t) > 1]
    assert finished and len(again) - len(before) <= 20 - len(finished) + 1 and len(repeated) <= 4
    M.call_model(req, backend, ["k"], store, "results")  # only the failed one is asked for again
    assert len(asked(calls_dir)) == len(again) + 1
    M.call_model(req, M.PythonBatchBackend(fn, 1, 1, model="m2"), ["k"], store, "results")  # another model's answers are its own
    assert len(asked(calls_dir)) == len(again) + 1 + 20


def test_nothing_to_ask_calls_nothing(spark, tmp_path):
    def fn(prompts):
        raise AssertionError("called")

    store = TableStore(spark, str(tmp_path))
    res = M.call_model(requests(spark, ["x"]).limit(0), M.PythonBatchBackend(fn), ["k"], store, "results")
    assert res.count() == 0 and res.columns == ["k", "response", "status"]


def test_settings_reach_the_functions(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    calls_dir, note = str(calls), recorder(str(calls))

    def embed(texts, model, task_type, dimensions):
        note(f"{model} {task_type} {dimensions} {len(texts) <= 3}")
        return [[1.0] * dimensions for _ in texts]

    cfg = PipelineConfig(source=SourceConfig("documents", "/root/testdata/sf0.001"), storage=StorageConfig(str(tmp_path / "t")),
                         llm=ModelConfig(model="big"), embedding=EmbeddingConfig("small", 4, "QUERY", 3, 2))
    job = Pipeline(spark, cfg, lambda prompts, model: [(model, None) for _ in prompts], embed)
    assert job.model.settings == {"model": "big"} and job.model.num_tasks == 10
    docs = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None), ("d", " ")], "id string, raw_content string")
    found = EM.document_vectors(docs, job.embedder, job.store, "v")
    assert {r.id: len(r.vector) for r in found.collect()} == {"a": 4, "b": 4, "c": 4, "d": 4}
    assert set(asked(calls_dir)) == {"small QUERY 4 True"}
    assert job.store.read("v__calls").where(F.col("error").isNull()).count() == 2

"""Benchmark: the six pipeline steps plus search queries at one scale factor.

Prints ONE JSON line:
{"metric": "pipeline_total", "value": sec, "unit": "sec", "queries": {...}, "sf": ...}

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Model and embedding calls use the offline backends (see kgspark.operators.model).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kgspark.config import (CommunityConfig, EmbeddingConfig, PipelineConfig,  # noqa: E402
                            SourceConfig, StorageConfig)
from kgspark.plans.pipeline import Pipeline  # noqa: E402
from kgspark.plans.queries import q_cosine_topk, q_doc_dedup  # noqa: E402
from kgspark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    work = tempfile.mkdtemp(prefix="kgspark-bench-", dir="/tmp")
    cfg = PipelineConfig(
        source=SourceConfig("documents", sf_dir),
        storage=StorageConfig(base_path=f"{work}/tables"),
        community=CommunityConfig(),
        embedding=EmbeddingConfig(dimensions=768),
    )
    pipe = Pipeline(spark, cfg)
    timings: dict[str, float] = {}
    for step, name in ((1, "load_documents"), (2, "extract_graph"), (3, "finalize_graph"),
                       (4, "create_communities"), (5, "community_reports"),
                       (6, "embed_and_sync")):
        t0 = time.time()
        pipe.run(steps=[step])
        timings[name] = round(time.time() - t0, 3)
    for name, fn in (("doc_dedup", q_doc_dedup), ("cosine_topk", q_cosine_topk)):
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "pipeline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
                      "shuffle_partitions": max(cpus, 8)}))
    spark.stop()


if __name__ == "__main__":
    main()

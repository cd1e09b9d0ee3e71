"""Pipeline configuration (R4): typed sections with the reference's defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class ModelConfig:
    # model and embedding model names are passed to every call of the user-supplied function
    model: str = "default"
    temperature: float = 0.0
    max_output_tokens: int = 8192
    # prompts of one call, and tasks calling the service at once
    batch_size: int = 250
    max_concurrent: int = 10


@dataclass(frozen=True)
class EmbeddingConfig:
    model: str = "default"
    dimensions: int = 768
    task_type: str = "RETRIEVAL_DOCUMENT"
    batch_size: int = 250
    # number of tasks calling the embedding service at once
    max_concurrent: int = 10


@dataclass(frozen=True)
class CommunityConfig:
    max_levels: int = 5
    resolution: float = 1.0
    # None = number of vertices, as the reference passes it (only level 0 appears)
    max_cluster_size: int | None = None
    include_isolates: bool = False


@dataclass(frozen=True)
class StorageConfig:
    # base folder for every intermediate and sink table (one parquet dir each)
    base_path: str = "/tmp/kgspark-tables"
    sink_path: str | None = None


@dataclass(frozen=True)
class SourceConfig:
    # "documents": driver documents(doc_id, text);
    # "conversations": turns joined per conv_id;
    # otherwise a parquet path with data_id / full_conversation columns
    kind: str = "documents"
    path: str = "/root/testdata/sf0.01"


@dataclass(frozen=True)
class PipelineConfig:
    source: SourceConfig = field(default_factory=SourceConfig)
    storage: StorageConfig = field(default_factory=StorageConfig)
    llm: ModelConfig = field(default_factory=ModelConfig)
    embedding: EmbeddingConfig = field(default_factory=EmbeddingConfig)
    community: CommunityConfig = field(default_factory=CommunityConfig)
    # step-2 document limit (L3); None/0 = all documents
    max_rows: int | None = None
    # A8: "title" collapses one entity per title as the reference does; "none" keeps all
    collapse: str = "title"
    # Q7: "descending" builds child reports first; "ascending" is the as-written order
    report_level_order: str = "descending"

    def with_(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

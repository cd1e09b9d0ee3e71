"""The pipeline against plain versions of its stages on a small table."""
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from kgspark.llm import bpe, langid
from kgspark.llm.oracles import OP7
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "123 !!", "en", "s", 6), (10 ** 6 + 2, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = kept.collect()
    model = langid.train(docs)
    sure = langid.label(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= corpus_pipeline.LEAST_SCORE))
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in sure.collect())
    assert len(rows) >= docs.count() - 3 and max(r["doc_id"] for r in rows) < 10 ** 6
    one = corpus_pipeline.near_duplicates(spark, kept, SF)
    ids = {r["doc_id"] for r in one.collect()}
    assert one.columns == docs.columns and {str(i) for i in ids} == {c for _, c, _ in brute([(r["doc_id"], r["text"]) for r in rows])}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    dirty = {r[0] for r in con.execute(f"SELECT doc_id FROM ({OP7}) WHERE contaminated").fetchall()}
    clean = corpus_pipeline.decontamination(spark, one, SF)
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == docs.columns and set(left) == ids - dirty and dirty
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)))
    for r in corpus_pipeline.encoding(spark, clean, SF).collect():
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == enc.encode_ordinary(left[r["doc_id"]])
        assert r["decoded_sha256"] == hashlib.sha256(left[r["doc_id"]].encode()).hexdigest()


def test_run_reads_the_documents(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


AWKWARD = ("score double, _text string, lang_pred string, n_words int, items string, row int, h int, packed string, "
           "c0 int, _d int, _x int, others string, whole string, contaminated boolean, ids string")


def test_stages_hand_on_any_columns_nulls_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    odd = [(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "", "en", "s", 0), (None, rows[0][1], None, None, None), (None, rows[0][1], None, None, None),
           (10 ** 6 + 2, "the and of " * 40_000, None, "long", 1)]
    extra = (0.5, "t", "x", 1, "i", 2, 3, "p", 4, 5, 6, "o", "w", True, "z")
    schema = docs.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    table = spark.createDataFrame([(*r, *extra) for r in rows + odd], f"{schema}, {AWKWARD}")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, table, SF)
        got = found.collect()
        assert stage(spark, table.limit(0), SF).collect() == []
        if name == "encoding":
            assert len(got) == len(rows) + len(odd) and sum(r["n_tokens"] == 0 for r in got) >= 2
            continue
        assert found.columns == table.columns and {tuple(r)[len(docs.columns):] for r in got} == {extra}
        whole = {(*r, *extra) for r in rows + odd}
        assert {tuple(r) for r in got} <= whole
        kept = [r["doc_id"] for r in got]
        if name == "language":
            assert 10 ** 6 not in kept and 10 ** 6 + 2 in kept and kept.count(None) == 2
        elif name == "near_duplicates":
            assert None not in kept and 10 ** 6 in kept and 10 ** 6 + 1 in kept and len(kept) == len(set(kept))
        else:
            assert 10 ** 6 in kept and 10 ** 6 + 1 in kept

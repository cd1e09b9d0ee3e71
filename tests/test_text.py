import hashlib

from pyspark.sql import functions as F

from kgspark.functions.text import (content_hash, is_blank, normalize_name, numbered_lines,
                                    stable_id, truthy_text)

SAMPLES = [" Acme ", "ACME", "\tacme ", "", "   ", "a b", "　x　", "Ünï ", None]


def test_content_hash_matches_hashlib(spark):
    rows = spark.createDataFrame([(s,) for s in SAMPLES], "t string").select(
        "t", content_hash("t").alias("h")).collect()
    for r in rows:
        assert r.h == hashlib.sha256((r.t or "").encode("utf-8")).hexdigest()


def test_normalize_like_python_strip_upper(spark):
    rows = spark.createDataFrame([(s,) for s in SAMPLES if s is not None], "t string").select(
        "t", normalize_name("t").alias("n"), is_blank("t").alias("b")).collect()
    for r in rows:
        assert r.n == r.t.strip().upper()
        assert r.b == (r.t.strip() == "")


def test_truthy_text_numeric_zero(spark):
    df = spark.createDataFrame([(0,), (7,), (None,)], "x long")
    got = [r.s for r in df.select(truthy_text("x", df.schema["x"].dataType).alias("s")).collect()]
    assert got == ["", "7", ""]


def test_stable_id_shape_and_determinism(spark):
    df = spark.createDataFrame([("A", "B"), ("A", "B"), ("A:", "B")], "a string, b string")
    ids = [r.i for r in df.select(stable_id("entity", "a", "b").alias("i")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert len(ids[0]) == 36 and [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]


def test_numbered_lines(spark):
    df = spark.createDataFrame([(["x", "y", "z"],)], "a array<string>")
    assert df.select(numbered_lines("a").alias("s")).first().s == "1. x\n2. y\n3. z"

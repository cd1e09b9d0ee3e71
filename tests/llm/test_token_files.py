import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kgspark.llm import token_files as tf
from kgspark.llm.common import shared_path
from kgspark.llm.queries import op3_token_files

from llm_fixtures import TEXTS, docs


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _make(spark):
    return tf.library_encoder(spark, public_tokenizers.path("word_bpe_49k.json"))


def _want(tokenizer, rows):
    return {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}


def test_awkward_rows(spark, tokenizer):
    path = tf.write(docs(spark).select("doc_id", "text"), shared_path(spark, "t"), _make(spark), 2, 49408)
    rows = tf.read(spark, path).orderBy("start").collect()
    want = _want(tokenizer, TEXTS)
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted((d for d, _ in TEXTS), key=lambda x: (x is not None, x or 0))
    start = 0
    for r in rows:
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == want[r["doc_id"]]
        assert r["start"] == start and r["n_tokens"] == len(want[r["doc_id"]])
        start += r["n_tokens"]


def test_empty_table(spark):
    path = tf.write(docs(spark, []).select("doc_id", "text"), shared_path(spark, "t"), _make(spark), 2, 49408)
    assert tf.read(spark, path).collect() == []


def test_query_on_documents(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op3_token_files(spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(_want(tokenizer, [(0, r["text"])])[0], "<u4")
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=2000), st.integers(9, 20))
def test_code_round_trip_and_limit(ids, most):
    ids = np.array(ids, np.int64)
    lengths = tf.code_lengths(np.bincount(ids, minlength=301), most)
    assert lengths.max(initial=0) <= most
    assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
    bits, checkpoints = tf.pack(ids, lengths, tf.canonical(lengths))
    if len(ids):
        assert tf.Reader(lengths).unpack(bits, checkpoints, len(ids)).tolist() == ids.tolist()


def test_lengths_are_optimal():
    import heapq
    rng = np.random.default_rng(0)
    counts = rng.zipf(1.5, 200)
    heap = [int(c) for c in counts]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    assert int((tf.code_lengths(counts, 40) * counts).sum()) == cost
    short = tf.code_lengths(counts, 8)
    assert short.max() == 8 and (short * counts).sum() >= cost


ODD = ["", "a\x1cb 12\x85c", "ÀÉ'S it'LL we've", "<|endoftext|>x a<|startoftext|>", "</w> </w>a <w/>", "İstanbul ΣΑΣ é",
       "日本 語'x", "½²x µ ß", "  ", "#" * 300, " x y", "\x00\x7f\x80\xad", "A" * 5000, " a　b", "Haedon$$$ haedon, HAEDON"]


def test_encoder_equals_library_on_odd_words(spark, tokenizer):
    encode = _make(spark)()
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]
    for _ in range(2):  # with an empty table, and from it
        assert [x.tolist() for x in encode([t.encode() for t in ODD])] == want
    assert [x.tolist() for x in encode([" \n".join(ODD).encode()])] == \
        [tokenizer.encode(" \n".join(ODD), add_special_tokens=False).ids]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0xff), st.sampled_from("AbÉß'sİ́日 ")), max_size=60), max_size=5))
def test_encoder_equals_library_on_any_text(spark, tokenizer, texts):
    got = _make(spark)()([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoders_of_a_worker_can_be_dropped():
    # the stages that count, code and read do so first: Spark hands them the workers that encoded
    tf._ENCODERS[1] = lambda texts: []
    tf.drop_encoders()
    assert not tf._ENCODERS


def test_words_are_split_in_one_text(monkeypatch):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        model = f.read()

    def one_by_one(pattern):
        def split(text):
            raise AssertionError(f"{text!r} was split alone")
        return split
    monkeypatch.setattr(tf, "splitter", one_by_one)
    texts = ["It's 2024, isn't it? (Größe: 12µm²) ÀÉ x\u0085y -- ...", "", "don't!! don't!! 'S 'll", "  \u0085", "plain words only"]
    encode, whole = tf._encoder(model), Tokenizer.from_file(path)
    for _ in range(2):  # the second time from the table
        got = encode([t.encode() for t in texts])
        assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from kgspark.llm import bpe, common, jaccard

from llm_fixtures import TEXTS, docs


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def brute(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_brute_force_and_round_trip(spark, ranks, brute):
    rows = bpe.decode(bpe.encode(docs(spark), ranks, public_tokenizers.PATTERN), ranks).collect()
    want = sorted((str(i), np.array(brute.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())
                  for i, t in TEXTS)
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == want
    assert all(r["valid"] and r["n_tokens"] * 4 == len(r["ids"]) for r in rows)


def test_empty_table(spark, ranks):
    out = bpe.decode(bpe.encode(docs(spark, []), ranks, public_tokenizers.PATTERN), ranks)
    assert out.collect() == [] and out.columns == ["doc_id", "ids", "n_tokens", "decoded", "valid"]


def test_random_bytes_and_a_full_state_table(ranks, brute):
    machine, rng, tokens = bpe.Transducer(ranks), random.Random(5), list(ranks)
    machine.MOST_MOVES, machine.LOOKAHEAD = 50, 20
    for i in range(400):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 5)))
        if i % 2:
            piece = bytes(rng.choice(b"aeinrst \xc3\xa9\xff") for _ in range(rng.randint(1, 60)))
        assert machine.run(piece) == [ranks[t] for t in bpe.merge(piece, ranks)]
        assert machine.encode(piece) == brute._core_bpe.encode_single_piece(piece)


def test_decoder_streams_whole_characters(ranks, brute):
    text = "é日🙂 ñ — ok" * 30
    ids = np.array(brute.encode_ordinary(text) + [ranks[b"\xc3"]])
    tokens = [b""] * len(ranks)
    for t, i in ranks.items():
        tokens[i] = t
    table = bpe.compose(tokens)
    for step in (1, 2, 7, 1000):
        d = bpe.Decoder(tokens, table)
        parts = [d.feed(ids[i:i + step]) for i in range(0, len(ids), step)]
        assert all(p.decode() is not None for p in parts)
        assert b"".join(parts) + d.finish() == text.encode() + b"\xc3" and not d.valid


def test_utf8_machine_agrees_with_python():
    steps = bpe.utf8_steps()
    rng = random.Random(1)
    for _ in range(20_000):
        data = bytes(rng.choice([0x41, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC1, 0xC2, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF1, 0xF4, 0xF5])
                     for _ in range(rng.randint(1, 5)))
        state = 0
        for b in data:
            state = int(steps[state, b])
        try:
            data.decode()
            assert state == bpe.ACCEPT
        except UnicodeDecodeError:
            assert state != bpe.ACCEPT


def test_query_on_documents(spark, brute):
    from kgspark.llm.queries import op6_byte_bpe
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op6_byte_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = brute.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_tables_grow_little_with_the_moves(ranks):
    machine, rng = bpe.PieceIds(bpe.Transducer(ranks)), random.Random(7)
    letters = b"eeeaaattiinnoosshrdlucmfwygpb"
    tracemalloc.start()
    for _ in range(30_000):
        machine[bytes(rng.choice(letters) for _ in range(rng.randint(4, 12))).decode()]
    made, small = machine.machine.n_moves, tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert made > 100_000 and small < 200 * made  # measured: 113 bytes a move beside the fixed arrays, 331 with dictionaries


def test_a_worker_keeps_one_works_tables():
    hashes = common.kept("word hashes", dict)
    assert common.kept("word hashes", dict) is hashes
    assert common.kept("other", list) == [] and common.kept("word hashes", dict) is not hashes
    common.kept()
    assert not common._KEPT


def test_later_work_drops_the_encoder(ranks):
    for later in (lambda: jaccard.shingles(b"a b c"), common.kept):
        common.kept(("bpe", 1), lambda: bpe.PieceIds(bpe.Transducer(ranks)))
        later()
        assert ("bpe", 1) not in common._KEPT

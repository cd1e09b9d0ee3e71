"""Conversation repair against a search over all edit strings."""
import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kgspark.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, dup string, place int"


def by_turn(rows):
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest(rows):
    """The first complete edit string that a search in order of (cost, string) meets."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, initials, out = heapq.heappop(heap)
        pairs = initials[1:] if initials.startswith("s") else initials
        if i == len(rows) and (not initials or pairs and len(pairs) % 2 == 0):
            return faults, cost, audit, "\n".join(out)
        want = "a" if len(pairs) % 2 else "u"
        name = {"u": "user", "a": "assistant"}[want]
        heapq.heappush(heap, (cost + 3, audit + "I", i, initials + want, out + (name + ":",)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, initials, out))
            if faults[i] not in ("blank", "duplicate"):
                more = cost + 3 * (faults[i] == "truncated")
                heapq.heappush(heap, (more + 3, audit + "R", i + 1, initials + want, out + (f"{name}:{text}",)))
                if role[:1] == want or role[:1] == "s" and not initials:
                    heapq.heappush(heap, (more, audit + "K", i + 1, initials + role[0], out + (f"{role}:{text}",)))


def expected(rows):
    rows = by_turn(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    faults, cost, audit, text = cheapest(rows)
    starts = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:])), cost, audit, text)


def talks(seed, count, most):
    rng = random.Random(seed)
    texts = ["a.", "b?", "no end", " ", "", None, "c!\n ", "x ", "é. "]
    out = {}
    for conv in range(count):
        turns = [rng.choice([None, rng.randrange(8), i]) if rng.random() < 0.3 else i for i in range(rng.randrange(1, most))]
        out[conv] = [(t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)) for t in turns]
    return out


@pytest.mark.parametrize("held,batch", [(8 << 20, 10_000), (8, 3)])
def test_against_search(spark, held, batch):
    data = talks(held, 150, 6) | {None: [(0, "user", "q."), (1, "assistant", "no")]}
    rows = spark.createDataFrame([(c, *r, "x", 1) for c, rs in data.items() for r in rs], SCHEMA)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r["conv_id"]: tuple(r)[1:] for r in cr.audits(rows, held).collect()}
        turns = {}
        for r in cr.repair(rows, held).orderBy("conv_id", "place").collect():
            turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == set(data)
    for conv, rs in data.items():
        want = expected(rs)
        assert got[conv] == (*want[:-1], hashlib.sha256(want[-1].encode()).hexdigest()), (conv, rs)
        assert "\n".join(turns.get(conv, [])) == want[-1]


def test_long_conversation_in_one_stream(spark):
    rows = spark.range(30_000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                          "concat('text ', id, '.') as text")
    one = cr.audits(rows.where("turn <> 15001")).first()
    assert one["audit"] == "K" * 15001 + "I" + "K" * 14998 and one["cost"] == 3 and one["gaps"] == 1
    assert one["illegal"] == 1


def test_damage_by_checksum_and_lost_conversations(spark):
    rows = [(c, t, "assistant", "A. b? c!") for c in range(60) for t in range(2)] + [(None, None, None, None)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "A b c" if kind == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(str, map(tuple, cr.damage(table).collect()))) == sorted(map(str, want))
    found = cr.damaged_audits(table)
    assert found.count() == 61 and found.where(F.col("conv_id").isNull()).count() == 1
    assert cr.damaged_audits(table.limit(0)).collect() == []
    gone = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    twice = spark.createDataFrame([(c, 0, "user", "x.", "", 0) for c in gone for _ in range(2)], SCHEMA)
    assert len(gone) > 2 and cr.damaged_audits(twice).count() == len(gone)
    for r in cr.damaged_audits(twice).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())

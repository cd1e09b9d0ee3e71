"""Event-sourced conversations against a fold over the sorted log."""
import random

from kgspark.llm import chat

SCHEMA = "conv_id long, seq long, kind string, turn long, role string, text string, cut long"


def fold(events):
    key = lambda e: (e[0], e[2] is not None, e[2] or 0, e[1] or "message", e[3] or "", e[4] or "")
    turns = {}
    for seq, kind, turn, role, text in sorted(events, key=key):
        kind, role, text = kind or "message", role or "", text or ""
        if kind == "regenerate" and turn is not None:
            for later in [t for t in turns if t is not None and t > turn]:
                del turns[later]
        old = turns.get(turn, {"pos": seq, "roles": [], "text": ""})
        if kind == "delta":
            turns[turn] = {"pos": old["pos"], "roles": old["roles"] + [role], "text": old["text"] + text}
        else:
            turns[turn] = {"pos": old["pos"], "roles": [role], "text": "" if kind == "regenerate" else text}
    return sorted(((str(t), v["pos"], max(v["roles"]), v["text"]) for t, v in turns.items()))


def check(spark, logs):
    events = spark.createDataFrame([(c, *e, 9) for c, es in logs.items() for e in es], SCHEMA)
    got = {}
    for r in chat.reconstruct(events).collect():
        got.setdefault(r["conv_id"], []).append((str(r["turn"]), r["pos"], r["role"], r["text"]))
    assert {c: sorted(rows) for c, rows in got.items()} == {c: fold(es) for c, es in logs.items()}


def test_late_deltas_and_events_of_equal_seq(spark):
    check(spark, {
        1: [(0, "message", 3, "assistant", "old follow-up"), (1, "regenerate", 2, "user", ""), (2, "delta", 3, "assistant", "new follow-up")],
        2: [(0, "message", 1, "user", "A"), (0, "message", 1, "user", "B")],
        3: [(0, "delta", 1, "user", "draft "), (0, "edit", 1, "user", "final")],
        4: [(0, "message", 1, "user", "x"), (1, "regenerate", 1, "user", ""), (1, "message", 2, "assistant", "same seq")]})


def test_random_logs(spark):
    rng = random.Random(4)
    logs = {}
    for conv in [*range(200), None]:
        logs[conv] = [(rng.randrange(8), rng.choice(["message", "delta", "delta", "edit", "regenerate", None]), rng.choice([None, 0, 1, 2, 3, 4]),
                       rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "c<|"])) for _ in range(rng.randrange(1, 14))]
    check(spark, logs)

"""Line dedup against a plain version."""
from collections import Counter

import pytest

from kgspark.llm import line_dedup
from llm_fixtures import TEXTS, docs

SPACE = " \t\n\x0b\x0c\r"
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, min_chars):
    keys = [[line.strip(SPACE).translate(CAPITALS) for line in (t or "").split("\n")] for _, t in rows]
    seen = Counter(k for ks in keys for k in set(ks))
    out = []
    for (i, t), ks in zip(rows, keys):
        gone = [len(k) >= min_chars and seen[k] >= min_docs for k in ks]
        out.append((str(i), "\n".join(x for x, g in zip((t or "").split("\n"), gone) if not g), len(ks), sum(gone)))
    return sorted(out)


ROWS = TEXTS + [
    (20, "Menu\nbody one\n menu\t\n\nend"), (21, "MENU\x0b\nÉTÉ\nété\r\n"), (21, "menu"), (21, "menu"), (22, "\nmenu\n\n"),
    (23, "é\né"), (24, " É"), (25, "É \nmenu "), (26, "\n".join(["x"] * 5000 + ["menu", "y"])), (27, "été"), (28, "é")]


@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (3, 1), (2, 2), (1, 1), (1, 0), (99, 1), (2, 5)])
def test_against_brute_force(spark, min_docs, min_chars):
    found = line_dedup.dedup_lines(docs(spark, ROWS), ["doc_id"], min_docs, min_chars)
    assert found.columns == ["doc_id", "kept", "n_lines", "n_dropped"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == brute(ROWS, min_docs, min_chars)


def test_clashing_names_keys_and_empty_table(spark):
    rows = docs(spark, [(None, "a\nb"), (1, "a"), (1, "a")]).selectExpr("doc_id as kept", "text", "ids as document", "n_tokens as place")
    found = line_dedup.dedup_lines(rows, ["document", "place"], 2)
    assert sorted((r[0], r[1], r[2]) for r in found.collect()) == [("extra", 1, ""), ("extra", 1, ""), ("extra", 1, "b")]
    assert line_dedup.dedup_lines(docs(spark).limit(0), min_docs=2).collect() == []

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.llm import jaccard
from kgspark.llm.graph import components
from kgspark.llm.queries import op5_jaccard_join

from llm_fixtures import docs


def brute(rows):
    """class_id and n_links by comparing all pairs of shingle sets."""
    def sh(t):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = lower.encode().split()
        return {tuple(w[i:i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)} if w else set()
    sets = [sh(t) for _, t in rows]
    up = list(range(len(rows)))
    find = lambda x: x if up[x] == x else find(up[x])
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return sorted((str(d), str(least[find(i)]), links[i]) for i, (d, _) in enumerate(rows))


def result(df):
    return sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in df.collect())


def copies(n_docs, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 200)))) for i in range(n_docs)]
    for i in range(n_docs, 3 * n_docs):
        ws = rng.choice(rows)[1].split()
        for _ in range(rng.randint(0, 3)):
            ws[rng.randrange(len(ws))] = rng.choice(words)
        rows.append((i, " ".join(ws)))
    return rows


def test_bands_reach_the_target():
    for rows in (2, 4, 6):
        b = jaccard.bands_for(0.8, rows)
        assert (1 - 0.8 ** rows) ** b <= jaccard.MISS < (1 - 0.8 ** rows) ** (b - 1)


@pytest.mark.parametrize("block, tile, singly", [(10 ** 6, 256, 500), (300, 4, 0), (300, 3, 10 ** 9)])
def test_same_as_all_pairs(spark, monkeypatch, block, tile, singly):
    # small blocks and tiles: groups of two blocks, both ways of comparing
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "SINGLY", singly)
    rows = copies(40, 3) + [(900, None), (901, ""), (902, " \n"), (None, "a b c"), (903, "A b  C"),
                            (903, "A b  C"), (904, "one"), (905, "x " * 30_000)]
    assert result(jaccard.near_duplicates(docs(spark, rows))) == brute(rows)


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = copies(15, 4) + [(500, None), (501, ""), (None, "q r s"), (700, "q r s"), (800, "same"), (800, "same")]
    kept = jaccard.one_of_each(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "ids", "n_tokens"]
    classes = {c for d, c, _ in brute([r for r in rows])}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(classes)


def test_empty_table(spark):
    assert jaccard.near_duplicates(docs(spark, [])).collect() == []
    assert jaccard.one_of_each(docs(spark, [])).collect() == []


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 2000), (7, 7)], "a long, b long")
    got = {r["id"]: r["comp"] for r in components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 2000: 1000}


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op5_jaccard_join(spark, sf)) == brute(rows)

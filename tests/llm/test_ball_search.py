"""Ranked search through ball trees against plain scoring of every document."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kgspark.llm import ball_search as bs
from llm_fixtures import TEXTS, docs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(CAPITALS))


def brute(rows, items, k=10):
    found = [(i, Counter(words(t))) for i, t in rows]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for doc, c in found:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(words(text)) if t in c)
            if s > 0:
                scores.append((-s, doc is not None, doc or 0, doc))
        out += [(str(item), r + 1, str(s[3]), -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out)


def corpus(seed, count):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)] + ["É", "é", "日本", "Ab", "AB", "12"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, weight, k=n))
    rows = [(i, text(rng.choice([1, 3, 20, 60]))) for i in range(count)]
    rows += [(count + i, rows[0][1]) for i in range(30)] + [(3, rows[3][1])] * 4 + [(None, rows[5][1]), (None, "w1 w2")]
    items = [(i, text(rng.choice([1, 5, 30]))) for i in range(25)] + [(0, "w1 w1 W1"), (90, None), (91, "..."), (92, "nowhere"), (93, rows[7][1])]
    return rows + TEXTS, items + [items[0]]


def items_table(spark, items):
    return spark.createDataFrame([(*i, "x", 1) for i in items], "item_id bigint, text string, doc_id string, score int")


@pytest.mark.parametrize("block,leaf,terms,k", [(2048, 48, 1 << 17, 10), (40, 3, 60, 10), (7, 1, 1 << 17, 3), (100, 5, 1 << 17, 1000)])
def test_against_brute_force(spark, block, leaf, terms, k):
    rows, items = corpus(block, 200)
    found = bs.search(docs(spark, rows), items_table(spark, items), k, block, leaf, terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in found.collect()) == brute(rows, items, k)


def test_empty_tables(spark):
    rows, items = corpus(1, 20)
    assert bs.search(docs(spark, rows).limit(0), items_table(spark, items)).collect() == []
    assert bs.search(docs(spark, rows), items_table(spark, items).limit(0)).collect() == []
    assert bs.search(docs(spark, [(1, None), (2, "")]), items_table(spark, items)).collect() == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.integers(1, 900_000, (40, 30))
    rows, offsets = [], [0]
    for i in range(1500):
        columns = np.sort(rng.choice(30, 12, replace=False)) + 30 * (i % 40)
        rows.append((columns, centres[i % 40][columns % 30] + rng.integers(0, 500, 12)))
        offsets.append(offsets[-1] + 12)
    cols, xs = (np.concatenate(x) for x in zip(*rows))
    ws = rng.integers(1, 9000, 1200)
    tree = bs.Builder(bs.Vectors(cols, np.sqrt(ws)[cols] * xs, np.array(offsets)), bs.bands(ws))
    order = np.concatenate(tree.order)
    at, _ = tree.rows.of(order)
    spans = np.concatenate([[0], np.cumsum([len(s) for s in tree.support])])
    made = bs.Tree({"docs": order.tolist(), "copies": np.ones(1500, int), "offsets": np.arange(1501) * 12, "cols": cols[at], "xs": xs[at],
                    "numbers": np.arange(1200), "ws": ws, "radius": np.concatenate(tree.radius), "right": np.array(tree.right),
                    "begin": np.array(tree.begin), "end": np.array(tree.end), "spans": spans,
                    "support": np.concatenate(tree.support), "centre": np.concatenate(tree.centre)})
    for group in range(40):
        asked = np.arange(30 * group, 30 * group + 30)
        exact = sorted(((int((ws[c] * x)[np.isin(c, asked)].sum()), -i) for i, (c, x) in enumerate(rows)), reverse=True)[:10]
        made.scored, best = 0, bs.Best(10)
        made.walk(asked, 1, best)
        best.rows.sort()
        assert [(-r[0], -r[2]) for r in best.rows] == exact
        assert made.scored < 600

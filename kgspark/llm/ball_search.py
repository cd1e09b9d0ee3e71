r"""Ranked lexical search: exact inner products of sparse vectors through ball trees.

Terms are the runs of digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. A document
is the vector of ``x = (10^9 tf) div (1000 tf + 8 m)`` over the terms that occur in any item (no other
term can add to a score), an item weighs its terms by ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, and
the score is the sum of ``w x``, in 64-bit integers.

``build_index`` deals the vectors by range of their heaviest term, so alike documents come together and
any key, hot or not, is cut into even parts; each run of ``BLOCK_DOCS`` vectors of a part becomes a ball
tree, one row of a table in the shared folder. ``search`` joins trees with blocks of items (bounded by
``ITEM_TERMS``, one block a round) and walks each tree best-first: the ball with the highest bound is
opened next, and a tree is left as soon as no bound reaches the item's k-th best score, which is
carried from tree to tree within a task. Only leaves are scored, exactly. A window that keeps k rows an
item merges the tasks' results.

Bounds: both sides are scaled by ``sqrt(w)``, and terms are dealt to bands by weight. A document's inner
product with an item is at most ``<q, c>`` plus the sum over bands of ``|q_b| r_b``, for centroid c, the radius
r_b of the ball in a band, and q_b the item's terms of the band that occur in the ball. All terms of these sums are at least 0, so doubles are off by a factor below ``1 + (T + 4) 2^-53`` for T terms; bounds are
raised by ``SAFE`` = 1e-6 (enough for T up to 10^9), radii by the same share of the norms they come from.
A ball goes only if its raised bound is below the k-th score, so ties are never lost.

Defined cases: null texts and texts without terms match nothing and are not counted in N; rows of equal
``doc_id`` and text are copies, each ranked; rows of equal ``item_id`` and text are one item, rows of equal
``item_id`` and other text are ranked on their own; equal scores are ordered by doc_id, null first; empty
tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import empty_text, shared_path, slices, small_batches, utf8, written

#: Documents of a tree, entries of its vectors, and documents of a leaf, at most.
BLOCK_DOCS, BLOCK_ENTRIES, LEAF = 2048, 1 << 19, 32
#: Bands of terms of like weight; a ball has a radius in each.
BANDS = 16
#: Rounds of two means when a ball is divided.
MEANS = 4
#: Distinct terms of all items of a block, about.
ITEM_TERMS = 1 << 17
#: Share by which bounds are raised for rounding.
SAFE = 1e-6
#: Bytes of terms, all others to a space, capitals to small letters.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Not a term: its row holds a document's own counts.
LENGTH = b""


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _term_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``n`` (terms of the text), ``term``, ``tf``; a row for ``LENGTH`` says n as tf. Texts without
    terms give no rows."""
    small_batches(rows.sparkSession)
    kinds = "".join(f"{k} {rows.schema[k].dataType.simpleString()}, " for k in keys)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = [Counter(terms(t)) for t in utf8(batch, "text")]
            sums = [sum(c.values()) for c in counts]
            for c, n in zip(counts, sums):
                if n:
                    c[LENGTH] = n
            offsets = pa.array(np.cumsum([0] + [len(c) for c in counts]), pa.int32())
            entries = pa.StructArray.from_arrays(
                [pa.array(list(chain.from_iterable(counts)), pa.binary()),
                 pa.array(list(chain.from_iterable(c.values() for c in counts)), pa.int64())], ["term", "tf"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(offsets, entries)],
                [*keys, "n", "entries"])

    found = rows.mapInArrow(work, f"{kinds}n bigint, entries array<struct<term: binary, tf: bigint>>")
    return found.select(*keys, "n", F.inline("entries"))


def _documents(docs: DataFrame, key: str) -> DataFrame:
    text = empty_text(F.col("text").cast("string"))
    return docs.select(F.col(key).alias("doc"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))


def weights(docs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, int, int]:
    """``term``, its number and weight, for terms of weight above 0; N and L."""
    found = _term_rows(docs.select(F.col("text").cast("string").alias("text")), [])
    every = vocabulary.unionByName(vocabulary.sparkSession.range(1).select(F.lit(LENGTH).alias("term")))
    sums = written(found.join(every, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), "df")
    whole = sums.where(F.col("term") == F.lit(LENGTH)).first()
    n, total = (whole["df"], whole["total"]) if whole else (0, 0)
    w = F.floor(1000 * F.ln(F.lit(2.0 * n + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    weighed = sums.where(F.col("term") != F.lit(LENGTH)).select("term", w.alias("w")).where("w > 0")
    return written(weighed.withColumn("number", F.monotonically_increasing_id()), "weights"), n, total


def vectors(docs: DataFrame, weighed: DataFrame, n_docs: int, total: int, key: str = "doc_id") -> DataFrame:
    """``doc``, ``copies``, ``entries`` (term number, w, x) of every document with a score above 0 for some item,
    and ``lead``, its heaviest entry."""
    rows = _term_rows(_documents(docs, key), ["doc", "digest"])
    m = F.lit(100 - 90) + F.expr(f"(90L * n * {n_docs}L) div {max(total, 1)}L")
    x = F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")
    hits = (rows.join(weighed, "term").withColumn("m", m).withColumn("x", x).where("x > 0")
            .select("doc", "digest", F.struct("number", "w", "x").alias("entry"),
                    F.struct((F.col("w") * F.col("x")).alias("wx"), "number").alias("heavy")))
    # a set, as copies of a document repeat its entries; it is combined before the shuffle
    return (hits.groupBy("doc", "digest").agg(F.collect_set("entry").alias("entries"), F.max("heavy").alias("lead"),
                                              F.count(F.lit(1)).alias("hits"))
            .select("doc", F.expr("hits div size(entries)").alias("copies"), "entries", "lead"))


class Vectors:
    """Rows of a sparse matrix."""

    def __init__(self, columns: np.ndarray, values: np.ndarray, offsets: np.ndarray):
        self.columns, self.values, self.offsets = columns, values, offsets

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries of some rows, and where each row begins among them."""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        starts = np.cumsum(sizes) - sizes
        return np.repeat(self.offsets[ids] - starts, sizes) + np.arange(sizes.sum()), starts


def bands(ws: np.ndarray) -> np.ndarray:
    """Band of each term of a block: as many terms in each, by weight."""
    out = np.empty(len(ws), np.int64)
    out[np.argsort(ws, kind="stable")] = np.arange(len(ws)) * BANDS // len(ws)
    return out


class Builder:
    """A ball tree of a block of vectors: nodes in the order in which they are met from the root, their centroids
    and radii, and for leaves their stretch of documents."""

    def __init__(self, rows: Vectors, bands: np.ndarray, leaf: int = LEAF):
        self.rows, self.bands, self.width, self.leaf = rows, bands, len(bands), leaf
        self.norms = np.add.reduceat(rows.values ** 2, rows.offsets[:-1])
        self.order: list[np.ndarray] = []
        self.placed = 0
        self.radius, self.right, self.begin, self.end = [], [], [], []
        self.support, self.centre = [], []
        self._node(np.arange(len(self.norms)))

    def _node(self, ids: np.ndarray) -> None:
        at, starts = self.rows.of(ids)
        columns, values, norms = self.rows.columns[at], self.rows.values[at], self.norms[ids]
        sizes = self.rows.offsets[ids + 1] - self.rows.offsets[ids]
        sums = np.bincount(columns, values, self.width)
        support = np.flatnonzero(np.bincount(columns, minlength=self.width))
        # any point serves as centre; this one is measured as it is stored
        centre = (sums[support] / len(ids)).astype(np.float32)
        dense = np.zeros(self.width)
        dense[support] = centre
        own = float((dense[support] ** 2).sum())
        far = norms - 2 * np.add.reduceat(values * dense[columns], starts) + own
        node = len(self.radius)
        doc = np.repeat(np.arange(len(ids)) * BANDS, sizes) + self.bands[columns]
        lengths = np.bincount(doc, values ** 2, len(ids) * BANDS).reshape(-1, BANDS)
        along = np.bincount(doc, values * dense[columns], len(ids) * BANDS).reshape(-1, BANDS)
        owns = np.bincount(self.bands[support], dense[support] ** 2, BANDS)
        away = np.maximum((lengths - 2 * along + owns).max(axis=0), 0.0)
        self.radius.append(np.sqrt(away + SAFE * (lengths.max(axis=0) + owns)))
        self.support.append(support)
        self.centre.append(centre)
        for column in (self.right, self.begin, self.end):
            column.append(-1)
        if len(ids) <= self.leaf:
            self.begin[node], self.end[node] = self.placed, self.placed + len(ids)
            self.order.append(ids)
            self.placed += len(ids)
            return

        def distance(to: int) -> np.ndarray:
            dense = np.zeros(self.width)
            one = slice(starts[to], starts[to + 1] if to + 1 < len(starts) else None)
            dense[columns[one]] = values[one]
            return norms - 2 * np.add.reduceat(values * dense[columns], starts) + norms[to]

        # two documents far apart, then two means: alike documents gather on one side
        first = distance(int(far.argmax()))
        lean = first - distance(int(first.argmax()))
        for _ in range(MEANS):
            side = lean < 0
            if not side.any() or side.all():
                break
            here = np.bincount(columns, values * np.repeat(side, sizes), self.width) / side.sum()
            there = (sums - here * side.sum()) / (~side).sum()
            lean = here @ here - there @ there - 2 * np.add.reduceat(values * (here - there)[columns], starts)
        side = lean < 0
        if not len(ids) // 16 <= side.sum() <= len(ids) - len(ids) // 16 or side.all() or not side.any():
            side = np.zeros(len(ids), bool)
            side[np.argsort(lean, kind="stable")[:len(ids) // 2]] = True
        self._node(ids[side])
        self.right[node] = len(self.radius)
        self._node(ids[~side])


#: Columns of a tree besides its documents.
TREE = ("copies array<bigint>, offsets array<int>, cols array<int>, xs array<int>, numbers array<bigint>, ws array<int>, "
        "radius array<double>, right array<int>, begin array<int>, end array<int>, spans array<int>, support array<int>, "
        "centre array<float>, every int")


def _tree(block: pa.Table, leaf: int) -> dict:
    """One row of the index from the vectors of a block."""
    entries = block.column("entries").combine_chunks()
    sizes = np.diff(entries.offsets.to_numpy())
    flat = entries.flatten()
    number, w, x = (flat.field(k).to_numpy() for k in ("number", "w", "x"))
    numbers, first, cols = np.unique(number, return_index=True, return_inverse=True)
    ws = w[first]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    rows = Vectors(cols, np.sqrt(ws.astype(np.float64))[cols] * x, offsets)
    tree = Builder(rows, bands(ws), leaf)
    order = np.concatenate(tree.order)
    at, _ = rows.of(order)
    docs = block.column("doc").combine_chunks().take(pa.array(order))
    return {"docs": docs, "copies": block.column("copies").combine_chunks().take(pa.array(order)),
            "offsets": np.concatenate([[0], np.cumsum(sizes[order])]), "cols": cols[at], "xs": x[at], "numbers": numbers, "ws": ws,
            "radius": np.concatenate(tree.radius), "right": np.array(tree.right), "begin": np.array(tree.begin),
            "end": np.array(tree.end), "spans": np.concatenate([[0], np.cumsum([len(s) for s in tree.support])]),
            "support": np.concatenate(tree.support), "centre": np.concatenate(tree.centre)}


def build_index(rows: DataFrame, block_docs: int = BLOCK_DOCS, leaf: int = LEAF) -> DataFrame:
    """The table of trees of ``vectors``, one row a block."""
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"docs array<{kind}>, {TREE}"
    near = [F.col("lead.number"), F.col("lead.wx"), F.col("doc")]
    dealt = rows.repartitionByRange(*near).sortWithinPartitions(*near).select("doc", "copies", "entries")
    types = {"copies": pa.int64(), "numbers": pa.int64(), "radius": pa.float64(), "centre": pa.float32()}

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = {k: v if isinstance(v, pa.Array) else pa.array(v, types.get(k, pa.int32()))
                   for k, v in _tree(pa.Table.from_batches(held), leaf).items()}
        lists = {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in columns.items()}
        return pa.RecordBatch.from_pydict(lists | {"every": pa.array([0], pa.int32())})

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, entries = [], 0, 0
        for batch in batches:
            lengths = np.diff(batch.column("entries").offsets.to_numpy())
            begin = 0
            for i, n in enumerate(lengths.tolist()):
                docs, entries = docs + 1, entries + n
                if docs >= block_docs or entries >= BLOCK_ENTRIES:
                    yield one([*held, batch.slice(begin, i + 1 - begin)])
                    held, docs, entries, begin = [], 0, 0, i + 1
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield one(held)

    return written(dealt.mapInArrow(work, schema), "ball-trees")


class Tree:
    """A tree row as arrays, and its best-first walk."""

    def __init__(self, row: dict[str, np.ndarray]):
        self.__dict__.update(row)
        self.xs, self.ws = self.xs.astype(np.int64), self.ws.astype(np.int64)
        self.roots = np.sqrt(self.ws.astype(np.float64))
        self.bands, self.radius = bands(self.ws), self.radius.reshape(-1, BANDS)
        self.weight, self.scaled = np.zeros(len(self.ws), np.int64), np.zeros(len(self.ws))
        self.scored = 0

    def bound(self, node: int) -> float:
        span = slice(self.spans[node], self.spans[node + 1])
        terms = self.support[span]
        q = self.scaled[terms]
        lengths = np.sqrt(np.bincount(self.bands[terms], q * q, BANDS))
        return float((q @ self.centre[span] + lengths @ self.radius[node]) * (1 + SAFE))

    def walk(self, columns: np.ndarray, least: int, best: "Best") -> None:
        """Offer ``best`` every document of the tree that can be among its k; ``columns`` are the item's terms."""
        self.weight[columns], self.scaled[columns] = self.ws[columns], self.roots[columns]
        heap = [(-self.bound(0), 0)]
        while heap and -heap[0][0] >= max(best.least, least):
            node = heappop(heap)[1]
            if self.right[node] >= 0:
                for child in (node + 1, int(self.right[node])):
                    heappush(heap, (-self.bound(child), child))
                continue
            begin, end = int(self.begin[node]), int(self.end[node])
            a, b = int(self.offsets[begin]), int(self.offsets[end])
            scores = np.add.reduceat(self.weight[self.cols[a:b]] * self.xs[a:b], self.offsets[begin:end] - a)
            self.scored += end - begin
            for i in np.flatnonzero(scores >= max(best.least, least)).tolist():
                best.offer(int(scores[i]), self.docs[begin + i], int(self.copies[begin + i]))
        self.weight[columns], self.scaled[columns] = 0, 0.0


class Best:
    """The k best documents of an item: highest score, then smallest id, null first."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 0

    def offer(self, score: int, doc: object, copies: int) -> None:
        self.rows.append((-score, doc is not None, doc, copies))
        if len(self.rows) > self.k:
            self.rows.sort(key=lambda r: r[:3] if r[1] else r[:2])
            del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.least = -max(r[0] for r in self.rows)


def _item_blocks(pairs: DataFrame, item_terms: int) -> tuple[DataFrame, int]:
    """One row a block of items, with their term numbers, and the number of blocks."""
    n = -(-max(pairs.count(), 1) // item_terms)
    of_item = pairs.groupBy("item").agg(F.collect_list("number").alias("numbers"))
    # ``every`` is a column of data in both tables: the join with a block stays a join by key
    blocks = of_item.groupBy(F.pmod(F.xxhash64("item"), F.lit(n)).cast("int").alias("item_block")).agg(
        F.collect_list("item").alias("items"), F.flatten(F.collect_list("numbers")).alias("item_numbers"),
        F.collect_list(F.size("numbers")).alias("item_sizes"), F.min(F.lit(0)).alias("every"))
    return written(blocks, "item-blocks"), n


def _search_block(trees: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """``item``, ``doc``, ``copies``, ``score``: the k best of every item of the block in each task."""
    kind = trees.schema["docs"].dataType.elementType.simpleString()
    joined = trees.join(F.broadcast(block), "every").drop("every", "item_block")
    arrays = [f.name for f in trees.schema if f.name not in ("docs", "every")]

    def rows(found: dict[int, Best], kind: pa.DataType) -> pa.RecordBatch:
        flat = [(item, r) for item, best in found.items() for r in best.rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in flat], pa.int64()), pa.array([r[2] for _, r in flat], kind),
             pa.array([r[3] for _, r in flat], pa.int64()), pa.array([-r[0] for _, r in flat], pa.int64())],
            ["item", "doc", "copies", "score"])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Best] = {}
        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field("docs").type.value_type
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy() for c in arrays}
                tree = Tree(row | {"docs": batch.column("docs")[i].values.to_pylist()})
                sizes = batch.column("item_sizes")[i].values.to_numpy()
                wanted = batch.column("item_numbers")[i].values.to_numpy()
                at = np.minimum(np.searchsorted(tree.numbers, wanted), len(tree.numbers) - 1)
                here = tree.numbers[at] == wanted
                ends = np.cumsum(sizes)
                for item, begin, end in zip(batch.column("items")[i].values.to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                    columns = at[begin:end][here[begin:end]]
                    if len(columns):
                        tree.walk(columns, 1, found.setdefault(item, Best(k)))
        if found:
            yield rows(found, doc_type)

    return joined.mapInArrow(work, f"item bigint, doc {kind}, copies bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_docs: int = BLOCK_DOCS, leaf: int = LEAF,
           item_terms: int = ITEM_TERMS) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the k best documents of every item."""
    spark = docs.sparkSession
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    asked = written(asked.withColumn("item", F.monotonically_increasing_id()), "items")
    pairs = written(_term_rows(asked.select("item", "text"), ["item"]).where(F.col("term") != F.lit(LENGTH))
                    .select("item", "term"), "item-terms")
    weighed, n, total = weights(docs, pairs.select("term").distinct())
    numbered = pairs.join(weighed, "term").select("item", "number")
    blocks, n_blocks = _item_blocks(numbered, item_terms)
    trees = build_index(vectors(docs, weighed, n, total), block_docs, leaf)
    path = shared_path(spark, "found")
    # a row of the index is some MB: few of them are read at once
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4")
    try:
        for b in range(n_blocks):
            found = _search_block(trees, blocks.where(F.col("item_block") == b), k)
            found.write.mode("append").parquet(path)
    finally:
        spark.conf.set(setting, before)
    found = spark.read.schema(found.schema).parquet(path)
    each = found.select("item", "doc", "score", F.explode(F.array_repeat(F.lit(0), F.least("copies", F.lit(k)).cast("int"))))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_first())
    best = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")

"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Words stand between ASCII white space, A-Z lower-cased; a document's set holds the hashes of all
its five-word shingles (all its words as one shingle if it has fewer, nothing if it has none).
Two documents are linked if the Jaccard similarity of their sets is 0.8 or more.

1. One pass over the texts writes narrow rows: a digest of the set, its size and the band keys of
   its MinHash signature. Rows and bands come from ``bands_for``: the fewest bands that miss a pair at the
   threshold with a probability of at most ``MISS``.
2. Documents with equal sets form one class (a partial aggregate), so copies of any number cost one
   row from here on.
3. Classes are shuffled on band keys. A bucket is a star around its smallest member, never a list of
   pairs; the connected components of these stars hold all candidate pairs.
4. The sets of classes in components are built from their texts and dealt to groups: a component
   is split by hash into blocks of about ``BLOCK`` shingles, and each pair of blocks is one group, so a
   hot component spreads over many tasks and none holds more than two blocks. In a group, pairs that
   share a band are compared on their full sets, few ones one by one, many ones by a product of
   incidence matrices. A group returns, per class, the links it found and one edge of a
   spanning forest; pairs are never written out.
5. Components of the forest's edges are the near-duplicate groups.

Result, one row per document: ``doc_id``, ``class_id`` (smallest doc_id of its group), ``n_links``
(documents linked with it, its copies included).

Defined cases: null or wordless texts have empty sets and are alone in a class; null ids take part,
``class_id`` is then null only if no member has an id; repeated rows are copies; texts of any length are
compared whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, kept, small_batches, slices, utf8, written
from .graph import components

N_GRAM = 5
#: Similarity at or above which documents are linked, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
#: Chance that banding misses a pair at the threshold.
MISS = 1e-4
ROWS = 4
#: Shingles per block: eight bytes each.
BLOCK = 1_000_000
#: Documents compared at once inside a group, and candidate pairs up to which they are compared singly.
TILE, SINGLY = 256, 500
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Fewest bands of ``rows`` rows that find a pair at the threshold but for a chance ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - threshold ** rows))


class _WordHashes(dict):
    """64-bit hashes of words, in a table of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_ODD = np.random.default_rng(5).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes, n: int = N_GRAM) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams."""
    words = text.translate(LOWER).split()
    hashes = kept("word hashes", _WordHashes)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    m = min(n, len(h))
    if not m:
        return h
    size = len(h) - m + 1
    x = np.full(size, m, np.uint64)
    for j in range(m):
        x += h[j:j + size] * _ODD[j]
    return np.unique(_mix(x))


def signature_bands(sets: list[np.ndarray], rows: int, bands: int) -> np.ndarray:
    """Band keys (documents x bands, int64) of sets that are not empty."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    flat = flat ^ (flat >> np.uint64(33))
    rng = np.random.default_rng(7)
    keys = np.empty((len(sets), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sets), b + 1, np.uint64)
        for _ in range(rows):
            odd, add = rng.integers(1, 1 << 62, 2, dtype=np.uint64)
            h = flat * (odd * np.uint64(2) + np.uint64(1)) + add
            key = _mix(key + np.minimum.reduceat(h, starts))
        keys[:, b] = key
    return keys.view(np.int64)


def signatures(docs: DataFrame, n: int = N_GRAM, rows: int = ROWS, bands: int | None = None) -> DataFrame:
    """``row``, ``doc_id``, ``h`` (hash of the text), ``key`` (digest of the set, null if empty),
    ``size``, ``bands`` of every document."""
    small_batches(docs.sparkSession)
    bands = bands or bands_for(NUMERATOR / DENOMINATOR, rows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingles(t, n) for t in utf8(batch, "text")]
            some = [i for i, s in enumerate(sets) if len(s)]
            values = signature_bands([sets[i] for i in some], rows, bands).tolist() if some else []
            keys: list = [None] * len(sets)
            for i, v in zip(some, values):
                keys[i] = v
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"),
                 pa.array([blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets], pa.string()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "h", "key", "size", "bands"])
        give_back()

    rows_ = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    out = rows_.mapInArrow(work, f"doc_id {kind}, h bigint, key string, size bigint, bands array<bigint>")
    return out.withColumn("row", F.monotonically_increasing_id())


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of wanted pairs (others may be 0)."""
    out = np.zeros((len(a), len(b)), np.int64)
    pairs = np.argwhere(wanted)
    if len(pairs) <= SINGLY:
        for i, j in pairs:
            x, y = (a[i], b[j]) if len(a[i]) >= len(b[j]) else (b[j], a[i])
            at = np.searchsorted(x, y)
            at[at == len(x)] = 0
            out[i, j] = int((x[at] == y).sum())
        return out
    # incidence of the shingles that both sides hold, a slice of them at a time
    left, right = wanted.any(axis=1), wanted.any(axis=0)
    fa = np.concatenate([x if k else x[:0] for x, k in zip(a, left)])
    fb = np.concatenate([x if k else x[:0] for x, k in zip(b, right)])
    da = np.repeat(np.arange(len(a)), [len(x) if k else 0 for x, k in zip(a, left)])
    db = np.repeat(np.arange(len(b)), [len(x) if k else 0 for x, k in zip(b, right)])
    common = np.intersect1d(fa, fb)
    if not len(common):
        return out

    def place(f: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(common, f)
        at[at == len(common)] = 0
        ok = common[at] == f
        order = np.argsort(at[ok], kind="stable")
        return at[ok][order], d[ok][order]

    (ca, da), (cb, db) = place(fa, da), place(fb, db)
    step = 8192
    total = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, len(common), step):
        ma, mb = np.zeros((len(a), step), np.float32), np.zeros((len(b), step), np.float32)
        for m, c, d in ((ma, ca, da), (mb, cb, db)):
            lo, hi = np.searchsorted(c, [start, start + step])
            m[d[lo:hi], c[lo:hi] - start] = 1
        total += ma @ mb.T
    return total.astype(np.int64)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _compare(rows: list[dict], both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links per row of a group and each row's root in the group's forest (an index). Rows are
    sorted by side and id; ``both``: the group joins two blocks, pairs inside one are found elsewhere."""
    sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
    bands = np.array([r["bands"] for r in rows], np.int64)
    sizes = np.array([len(s) for s in sets])
    copies = np.array([r["copies"] for r in rows], np.int64)
    side = np.array([r["side"] for r in rows])
    links, forest = np.zeros(len(rows), np.int64), _Forest(len(rows))
    first, second = (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    right = second if both else first
    for a in range(0, len(first), TILE):
        left = first[a:a + TILE]
        for b in range(0 if both else a, len(right), TILE):
            other = right[b:b + TILE]
            wanted = np.zeros((len(left), len(other)), bool)
            for k in range(bands.shape[1]):
                wanted |= bands[left, k][:, None] == bands[other, k][None, :]
            small, large = np.minimum(sizes[left][:, None], sizes[other]), np.maximum(sizes[left][:, None], sizes[other])
            wanted &= DENOMINATOR * small >= NUMERATOR * large  # sizes alone rule the others out
            if not both:
                wanted &= left[:, None] < other[None, :]
            if not wanted.any():
                continue
            shared = _overlaps([sets[i] for i in left], [sets[i] for i in other], wanted)
            union = sizes[left][:, None] + sizes[other][None, :] - shared
            linked = wanted & (DENOMINATOR * shared >= NUMERATOR * union)
            links[left] += linked @ copies[other]
            np.add.at(links, other, copies[left] @ linked)
            x, y = np.nonzero(linked)
            for i, j in zip(left[x].tolist(), other[y].tolist()):
                forest.join(i, j)
    return links, np.array([forest.find(i) for i in range(len(rows))])


def _verified(groups: DataFrame) -> DataFrame:
    """(id, links, root) per class and group; rows of a group stand together in a partition."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        held: list[dict] = []
        place = None

        def done() -> pa.RecordBatch:
            rows = list({(r["side"], r["id"]): r for r in held}.values())  # repeated rows of one text
            links, root = _compare(rows, place[1] != place[2])
            return pa.RecordBatch.from_arrays(
                [pa.array([r["id"] for r in rows], pa.int64()), pa.array(links),
                 pa.array([rows[k]["id"] for k in root], pa.int64())], ["id", "links", "root"])

        for batch in batches:
            for r in batch.to_pylist():
                if (at := (r["comp"], r["i"], r["j"])) != place:
                    if held:
                        yield done()
                    held, place = [], at
                held.append(r)
        if held:
            yield done()
        held = []
        give_back()

    return groups.mapInArrow(work, "id bigint, links bigint, root bigint")


def near_duplicates(docs: DataFrame, n: int = N_GRAM) -> DataFrame:
    """Rows of ``doc_id``, ``h`` (hash of the text), ``class_id``, ``n_links``, ``keep`` (one row per
    group and text; see the module's text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    signed = written(signatures(docs, n), "signatures")
    some = signed.where("key is not null")
    classes = written(
        some.groupBy("key").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"),
                                F.min("doc_id").alias("least")), "classes")
    own = some.join(classes.select("id", "copies"), F.col("row") == F.col("id")) \
        .select("id", "doc_id", "h", "size", "copies", "bands")
    own = written(own, "class-bands")
    keys = own.select("id", F.explode("bands").alias("b"))
    buckets = keys.groupBy("b").agg(F.min("id").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = keys.join(buckets, "b").where("id <> root").select("id", "root").distinct()
    found = components(written(stars, "stars"), "id", "root")  # id, comp; only ids in some bucket
    member = own.join(found, "id")
    totals = member.groupBy("comp").agg(F.sum("size").alias("total"))
    dealt = (member.join(totals, "comp")
             .withColumn("n_blocks", F.ceil(F.col("total") / F.lit(BLOCK)).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
             .select("id", F.col("doc_id").alias("d"), F.col("h").alias("g"), "comp", "copies", "bands",
                     "n_blocks", "block"))
    texts = (docs.withColumn("h", F.xxhash64("text"))
             .join(dealt, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")))
             .select("id", "comp", "copies", "bands", "n_blocks", "block", "text"))

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = pa.array([shingles(t, n).tobytes() for t in utf8(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.select(batch.schema.names[:-1]).columns, made],
                                             [*batch.schema.names[:-1], "set"])
        give_back()

    small_batches(spark)
    with_sets = texts.mapInArrow(sets, "id bigint, comp bigint, copies bigint, bands array<bigint>, "
                                       "n_blocks int, block int, set binary")
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    groups = (with_sets.withColumn("o", other)
              .select("comp", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "id",
                      "copies", "bands", "set", (F.col("block") > F.col("o")).cast("int").alias("side"))
              .repartition(F.col("comp"), F.col("i"), F.col("j"))
              .sortWithinPartitions("comp", "i", "j", "side", "id"))
    verified = written(_verified(groups), "verified")
    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    forest = components(written(verified.where("id <> root").select("id", "root").distinct(), "forest"),
                        "id", "root")
    named = (classes.join(links, "id", "left").join(forest, "id", "left")
             .select("key", "id", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("comp", "id").alias("comp")))
    named = written(named, "named")
    # the group's smallest document, and the row that stays
    group = named.groupBy("comp").agg(F.min("least").alias("class_id"))
    known = named.join(group, "comp").select(
        "key", "class_id", "comp", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    linked = some.join(known, "key").select("row", "doc_id", "h", "comp", "class_id", "n_links")
    alone = signed.where("key is null").select(
        "row", "doc_id", "h", F.col("row").alias("comp"), F.col("doc_id").alias("class_id"),
        F.lit(0).cast("bigint").alias("n_links"))
    every = written(linked.unionByName(alone), "linked")
    stays = every.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("comp").agg(
        F.min("row").alias("stay"))
    return (every.join(stays, "comp")
            .select("doc_id", "h", "class_id", "n_links", (F.col("row") == F.col("stay")).alias("keep")))


def one_of_each(docs: DataFrame, n: int = N_GRAM) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id (a single one of repeated
    rows); all columns stay."""
    names = docs.columns
    kept = near_duplicates(docs, n).where("keep").select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"))
    # numbered columns: no name of the table can clash with those of the join
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc, text = F.col(f"c{names.index('doc_id')}"), F.col(f"c{names.index('text')}").cast("string")
    hashed = plain.withColumn("_x", F.xxhash64(text)).join(kept, doc.eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h")))
    # rows that repeat id and text are the only ones that a kept pair can match more than once
    repeated = written(plain.select(doc.alias("_rd"), F.xxhash64(text).alias("_rh"))
                       .groupBy("_rd", "_rh").count().where("count > 1").drop("count"), "repeated")
    again = doc.eqNullSafe(F.col("_rd")) & (F.col("_x") == F.col("_rh"))
    single = hashed.join(repeated, again, "left_anti").select(*plain.columns)
    several = hashed.join(repeated, again, "left_semi").dropDuplicates(["_d", "_h"]).select(*plain.columns)
    return single.unionByName(several).toDF(*names)

"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash applies fast pseudo-rotations (``ROUNDS`` times random signs, then a Hadamard
transform) to a vector padded to a power of two and takes the nearest signed axis. Vectors are dealt to
ranges of their norm, ``1 / OCTAVE`` of a doubling each, and lifted to one length within their range (one more
coordinate, sqrt(M^2 - |x|^2), with M the range's own largest norm; a query gets 0 there), so the largest
inner product of a range is its smallest angle, and a long vector changes the hashes of no other range. A
query looks into the ``PROBES`` axes that are nearest to it in each of ``TABLES`` tables of every range;
candidates are reranked by exact inner products in double precision on the original vectors.
A range of fewer vectors than a table has axes is not hashed: every query meets all of it.

Queries that end with fewer than ``k`` neighbours, or fewer than all others if there are not ``k``, are
searched again exactly, in blocks against all vectors.

Equal vectors are one class, which keeps the ``k + 1`` smallest ids: no
more of them can be among a query's ``k`` nearest besides itself, as ties go to smaller ids. So a
vector that a third of all rows share is hashed, sent and compared once, and nothing is lost. Its
queries are rows of their own and meet the class's neighbours at the end.

Index rows and probes meet by (table, axis). Buckets are cut into blocks of about ``BLOCK`` vectors and
``QUERY_BLOCK`` queries by hash; the number of blocks follows from the bucket's counts (tables x axes rows). Each
pair of blocks is one task group: a matrix product, of which every query keeps its ``k`` best classes. Pairs
are never written out; per query k rows leave a group, and the groups' rows merge to the k best.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components take no part,
neither as queries nor as candidates; all others must have one length (else the job fails); null
ids take no part; rows that repeat an id and its vector are one vector; an id with several
vectors has several candidates and queries with each; fewer candidates than k are all returned; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

TABLES = 16
PROBES = 10
ROUNDS = 3
#: Norm ranges to a doubling, with 1.0 in the middle of one.
OCTAVE = 8
#: Range and table of the vectors that are not hashed.
WHOLE = -1_000_000
BLOCK = 20_000
QUERY_BLOCK = 4_000
ID_SLICE = 1_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of rows, in n log n steps."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


class Rotations:
    """Pseudo-rotations of all tables; the same everywhere for a given seed."""

    def __init__(self, dim: int, tables: int = TABLES, seed: int = 3):
        self.width = 1 << max(dim - 1, 1).bit_length()
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, ROUNDS, self.width))

    def __call__(self, x: np.ndarray) -> Iterator[np.ndarray]:
        padded = np.zeros((len(x), self.width))
        padded[:, :x.shape[1]] = x
        for signs in self.signs:
            y = padded
            for s in signs:
                y = hadamard(y * s)
            yield y


def axes(rotated: np.ndarray, n: int) -> np.ndarray:
    """The n nearest signed axes of each row, nearest first (axis, or axis + width if negative)."""
    both = np.concatenate([rotated, -rotated], axis=1)
    n = min(n, both.shape[1])
    if n == 1:
        return both.argmax(axis=1)[:, None]
    some = np.argpartition(-both, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(both, some, 1), axis=1, kind="stable"), 1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _classes(vectors: DataFrame, id_col: str, vector_col: str, k: int, is_query) -> tuple[DataFrame, DataFrame]:
    """Distinct usable vectors: ``class``, ``v``, ``asks`` (has queries), ``ids`` (the k + 1 smallest);
    and the queries: ``query`` (class), ``query_id``."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"), is_query.alias("q"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(ok)
            # -0.0 and 0.0 are one number
            .select("id", "q", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")))
    once = written(rows.groupBy("v", "id").agg(F.max("q").alias("q")), "ann-rows")
    named = written(once.groupBy("v").agg(F.count("*").alias("n"), F.max("q").alias("asks"))
                    .withColumn("class", F.monotonically_increasing_id()), "ann-vectors")
    members = written(once.join(named.select("v", "n", "class"), "v").select("class", "n", "id", "q"), "ann-members")
    # ids are cut to k + 1 in rounds, by slices whose number follows from the class's count: a list
    # holds about ``size`` ids, however many the class has
    size = max(ID_SLICE, 4 * (k + 1))
    ids, most, turn = members.select("class", "n", "id"), named.agg(F.max("n")).first()[0] or 0, 0
    few = F.slice(F.array_sort(F.collect_list("id")), 1, k + 1)
    while most > size:
        cut = F.ceil(F.col("n") / size)
        ids = (ids.groupBy("class", "n", F.pmod(F.xxhash64("id", F.lit(turn)), cut).alias("s")).agg(few.alias("f"))
               .select("class", F.when(F.col("n") > size, cut * (k + 1)).otherwise(F.col("n")).alias("n"), F.explode("f").alias("id")))
        most, turn = max(-(-most // size) * (k + 1), 1), turn + 1
    classes = named.select("class", "v", "asks").join(ids.groupBy("class").agg(few.alias("ids")), "class")
    return classes, members.where("q").select(F.col("class").alias("query"), F.col("id").alias("query_id"))


def search(vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           is_query=None, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k nearest found."""
    spark = vectors.sparkSession
    is_query = F.lit(True) if is_query is None else is_query
    classes, mine = _classes(vectors, id_col, vector_col, k, is_query)
    classes = written(classes, "ann-classes")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    # one row per range of norms: at most some thousand, as a double has 2048 exponents
    ranges = classes.groupBy(F.round(F.log2(square) * (OCTAVE / 2)).alias("range")).agg(
        F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b"), F.max(square).alias("m"),
        F.count("*").alias("n")).collect()
    few, many = min((r["a"] for r in ranges), default=1), max((r["b"] for r in ranges), default=1)
    if few != many:
        raise ValueError(f"vectors of {few} to {many} components")
    dim = few
    axes_of_table = 2 * Rotations(dim + 1, 1).width
    # squares that over- or underflow have no range
    largest = {r["range"]: r["m"] for r in ranges
               if r["n"] >= axes_of_table and r["range"] is not None and 0 < r["m"] < float("inf")}

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotate = Rotations(dim + 1, tables)
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            ask = np.array(batch.column("asks").to_pylist(), bool)
            ids = batch.column("class").to_numpy()
            data = np.array([r.tobytes() for r in x], object)
            at = batch.column("range").to_pylist()
            top = np.array([largest.get(r, 0.0) for r in at])
            dealt = top > 0
            place = np.array([int(r) if d else WHOLE for r, d in zip(at, dealt)])
            if not dealt.all():
                alone = ~dealt
                yield _rows(WHOLE, np.zeros((int(alone.sum()), 1), int), place[alone], ids[alone], data[alone], False)
            if ask.any():
                yield _rows(WHOLE, np.zeros((int(ask.sum()), 1), int), place[ask], ids[ask], data[ask], True)
            y = x[dealt]
            lifted = np.concatenate([y, np.sqrt(np.maximum(top[dealt] - (y * y).sum(axis=1), 0))[:, None]], axis=1)
            asked = np.concatenate([x[ask], np.zeros((int(ask.sum()), 1))], axis=1)
            for t, (y, z) in enumerate(zip(rotate(lifted), rotate(asked))):
                if len(y):
                    yield _rows(t, axes(y, 1), place[dealt], ids[dealt], data[dealt], False)
                if len(z):
                    yield _rows(t, axes(z, probes), place[ask], ids[ask], data[ask], True)

    def _rows(t: int, at: np.ndarray, place: np.ndarray, ids: np.ndarray, data: np.ndarray, asks: bool) -> pa.RecordBatch:
        n = at.shape[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(at.size, t), pa.int32()), pa.array(at.ravel(), pa.int32()),
             pa.array(np.repeat(place, n), pa.int32()), pa.array(np.repeat(ids, n)), pa.array([asks] * at.size), pa.array(np.repeat(data, n).tolist(), pa.binary())],
            ["t", "axis", "range", "class", "asks", "x"])

    meet = written(classes.select("class", "v", F.coalesce("asks", F.lit(False)).alias("asks"),
                                  F.round(F.log2(square) * (OCTAVE / 2)).alias("range"))
                   .mapInArrow(hashed, "t int, axis int, range int, class bigint, asks boolean, x binary"), "ann-hashes")
    # tables x axes x ranges rows; a query meets all ranges of its axis
    sizes = (meet.where(~F.col("asks")).groupBy("t", "axis", "range").agg(F.ceil(F.count("*") / BLOCK).alias("nv"))
             .join(meet.where("asks").groupBy("t", "axis").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("nq")), ["t", "axis"]))
    h = F.xxhash64("class")
    one = meet.where("asks").drop("range").join(sizes, ["t", "axis"]).select(
        "t", "axis", "range", F.pmod(h, "nq").alias("bq"), F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("bv"), "class", "x")
    two = meet.where("not asks").join(sizes, ["t", "axis", "range"]).select(
        F.col("t").alias("t2"), F.col("axis").alias("axis2"), F.col("range").alias("range2"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("bq2"),
        F.pmod(h, "nv").alias("bv2"), F.col("class").alias("class2"), F.col("x").alias("x2"))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "class", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "class": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        right = right.sort_by("class2")
        q, x = _matrix(left.column("x"), dim), _matrix(right.column("x2"), dim)
        ids = right.column("class2").to_numpy()
        s = q @ x.T
        n = min(k + 1, s.shape[1])  # a query's own class may be among them
        # all that reach the n-th best score: ties are cut by id, which only the merge knows
        floor = -np.partition(-s, n - 1, axis=1)[:, n - 1]
        rows, cols = np.nonzero(s >= (floor - 1e-9 * np.abs(floor))[:, None])
        return pa.Table.from_arrays([pa.array(left.column("class").to_numpy()[rows]), pa.array(ids[cols]),
                                     pa.array(s[rows, cols])], names)

    found = (one.groupBy("t", "axis", "range", "bq", "bv").cogroup(two.groupBy("t2", "axis2", "range2", "bq2", "bv2"))
             .applyInArrow(best, "query bigint, class bigint, score double"))
    pairs = found.groupBy("query", "class").agg(F.max("score").alias("near"))
    # exact inner products of the original vectors, in component order
    theirs = classes.select("class", "v", "ids")
    top = _top(pairs, ["query"], "near", "class", k + 1)
    product = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    full = (top.join(classes.select(F.col("class").alias("query"), F.col("v").alias("qv")), "query")
            .join(theirs, "class").select("query", product.alias("score"), "ids"))
    each = written(mine.join(full, "query")
                   .select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
                   .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "ann-found")
    # a class with more than k ids holds k + 1, so this counts all ids or more than k
    others = theirs.select(F.explode("ids").alias("i")).distinct().limit(k + 1).count() - 1
    enough = each.groupBy("query_id").count().where(F.col("count") >= min(k, others)).select("query_id")
    short = written(mine.join(enough, "query_id", "left_anti"), "ann-short")
    n_short = short.select("query").distinct().count()
    if n_short and others > 0:
        whole = _exact(classes, short.select("query").distinct(), n_short, k, dim)
        again = (short.join(whole, "query").where("query_id <> vec_id")
                 .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
        each = each.join(short, "query_id", "left_anti").unionByName(again)
    ordered = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k),
                          lambda r: r)
    return (each.groupBy("query_id").agg(ordered.alias("r"))
            .select("query_id", F.posexplode("r").alias("i", "r"))
            .select("query_id", (F.col("i") + 1).cast("int").alias("rank"), "r.vec_id", (-F.col("r.s")).alias("score")))


def _exact(classes: DataFrame, short: DataFrame, n_short: int, k: int, dim: int) -> DataFrame:
    """``query`` (class), ``vec_id``, ``score``: the k + 1 best ids of each class in ``short`` and
    their ties, from every block of all vectors."""
    nv = -(-classes.count() // BLOCK)
    nq = -(-n_short // QUERY_BLOCK)
    h = F.xxhash64("class")
    one = (classes.join(short.select(F.col("query").alias("class")), "class")
           .select(F.pmod(h, F.lit(nq)).alias("bq"), F.explode(F.sequence(F.lit(0), F.lit(nv - 1))).alias("bv"), "class", "v"))
    two = classes.select(F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("bq2"), F.pmod(h, F.lit(nv)).alias("bv2"),
                         F.col("v").alias("v2"), F.col("ids").alias("ids2"))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = (c.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                for c in (left.column("v"), right.column("v2")))
        if not len(q) or not len(x):
            return pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        lists = right.column("ids2").combine_chunks()
        ids, at = lists.flatten().to_numpy(), np.repeat(np.arange(len(x)), lists.value_lengths().to_numpy())
        order = np.argsort(ids, kind="stable")
        ids, at = ids[order], at[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        out = []
        for i, v in enumerate(q):
            near = (x @ v)[at]
            top = np.maximum.reduceat(near, first)  # an id with several vectors counts once
            n = min(k + 1, len(top))
            floor = -np.partition(-top, n - 1)[n - 1]
            keep = np.flatnonzero(near >= floor - 1e-9 * abs(floor))
            score = np.cumsum(x[at[keep]] * v, axis=1)[:, -1]  # in component order
            out.append((np.full(len(keep), i), ids[keep], score))
        rows, found, score = map(np.concatenate, zip(*out))
        return pa.table({"query": left.column("class").to_numpy()[rows], "vec_id": found, "score": score})

    return (one.groupBy("bq", "bv").cogroup(two.groupBy("bq2", "bv2"))
            .applyInArrow(best, "query bigint, vec_id bigint, score double")
            .groupBy("query", "vec_id").agg(F.max("score").alias("score")))


def _top(rows: DataFrame, by: list[str], score: str, tie: str, n: int) -> DataFrame:
    """The n best rows of each key and those that tie with the last of them. A key has at most
    tables x probes groups, each with few rows, so its list is of bounded size."""
    best = F.sort_array(F.collect_list(score), asc=False)
    floor = rows.groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b")[F.least(F.lit(n), F.size("b")) - 1].alias("floor"))
    return rows.join(floor, by).where(F.col(score) >= F.col("floor") - 1e-9 * F.abs("floor")).select(*by, tie)

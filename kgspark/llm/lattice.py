"""Subword-lattice language model: marginal probability of whole documents.

A document is its words between ASCII white space (A-Z lower-cased) and one end token. A word is a
path through a lattice: any segmentation of ``▁word`` into pieces of an existing vocabulary (a character
outside it is spelled in bytes), or, if training saw the word, one arc over the whole word. Weights:

* pieces: the vocabulary's own scores (log weights by rank) are the start; ``ROUNDS`` rounds of
  expectation-maximisation over the distinct training words refit them to the words' types, which
  is what unseen words resemble. Expected counts come from forward and backward sums in log space.
* whole words: absolute discounting. Seen c times of N: (c - D) / N; the mass D * V / N that this
  frees goes to spelling, with D = n1 / (n1 + 2 * n2) from the counts of words seen once and twice.

A word's probability is the sum over all paths (forward recursion in log space); a document's is the
product over its words and its end, so its score is the marginal over all segmentations.

How it runs. Documents become chunks of about ``CHUNK`` words, once: distinct words, each text as
indexes into them, and each word's training occurrences. Word counts are sums over chunks, so a
frequent word costs one row per chunk, not per occurrence. Every distinct word is scored once, in one
table; a chunk then fetches the rows of its words by a join and sums its texts. The driver sees
piece totals (one per vocabulary entry) and five sums. Nothing is dropped: all words of all texts count.

Defined cases: null text is empty (its one token is the end); repeated rows count and are scored
separately; null ids stay null; long words and texts are scored whole; without training rows
only spelling has weight; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, slices, utf8, written

SPACE = "▁"
CHUNK = 1_500_000
ROUNDS = 2
#: Log probability of each byte of a character outside the vocabulary.
BYTE = float(np.log(1e-6))
#: Expected count that every piece has besides those of training.
PRIOR = 0.1
#: Words whose lattices are summed at once, by code points.
LATTICE_POINTS = 400_000
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
FILTER = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece model and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]


def start_weights(pieces: list[tuple[str, float]]) -> np.ndarray:
    """Log probabilities from the vocabulary's scores: by rank, as 1 / (rank + 1)."""
    score = np.array([s for _, s in pieces])
    rank = np.empty(len(score))
    rank[np.argsort(-score, kind="stable")] = np.arange(1, len(score) + 1)
    weight = 1 / (rank + 1)
    return np.log(weight / weight.sum())


def _hashes(points: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n code points from each position on)."""
    key = np.zeros(len(points), np.uint64)
    for n in range(1, longest + 1):
        m = len(points) - n + 1
        if m <= 0:
            return
        key = (key[:m] + points[n - 1:] + np.uint64(1)) * _BASE
        yield n, key


class Pieces:
    """Vocabulary lookup for all substrings of many words."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.filter = np.zeros(FILTER, bool)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        for n, ids in by_length.items():
            points = np.array([[ord(c) for c in pieces[i]] for i in ids], np.uint64)
            key = np.zeros(len(ids), np.uint64)
            for k in range(n):
                key = (key + points[:, k] + np.uint64(1)) * _BASE
            order = np.argsort(key)
            self.tables[n] = key[order], np.array(ids, np.int64)[order]
            self.filter[self._slot(key, n)] = True

    @staticmethod
    def _slot(key: np.ndarray, n: int) -> np.ndarray:
        return ((key >> np.uint64(40)) ^ np.uint64(n * 0x5bd1)) & np.uint64(FILTER - 1)

    def arcs(self, points: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per length, the positions at which a piece starts and which."""
        out = {}
        for n, key in _hashes(points, self.longest):
            if n not in self.tables:
                continue
            keys, ids = self.tables[n]
            at = np.flatnonzero(self.filter[self._slot(key, n)])
            k = np.searchsorted(keys, key[at])
            k[k == len(keys)] = 0
            ok = keys[k] == key[at]
            out[n] = at[ok], ids[k[ok]]
        return out


def lattice(words: list[str], lookup: Pieces, logp: np.ndarray,
            weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log of the sum over all segmentations of each ``▁word``; with ``weights`` per word also the
    pieces' expected counts."""
    order = np.argsort([-len(w) for w in words], kind="stable")
    texts = [SPACE + words[i] for i in order]
    size = np.array([len(t) for t in texts])
    first = np.cumsum(size) - size
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word_end = np.repeat(first + size, size)
    arcs = {}
    for n, (at, ids) in lookup.arcs(points).items():
        inside = at + n <= word_end[at]
        arcs[n] = at[inside], ids[inside]
    # arc weights as one row per length; a character without a piece is spelled in bytes
    at, ids = arcs.get(1, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    n_bytes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    single = n_bytes * BYTE
    single[at] = logp[ids]
    weight = {n: np.full(len(points), -np.inf) for n in arcs if n > 1}
    for n in weight:
        weight[n][arcs[n][0]] = logp[arcs[n][1]]
    weight[1] = single
    # alpha[p + word]: ends of words need a place of their own
    place = np.arange(len(points)) + np.repeat(np.arange(len(texts)), size)
    head = first + np.arange(len(texts))
    alpha = np.full(len(points) + len(texts), -np.inf)
    alpha[head] = 0
    lengths = sorted(weight)
    for j in range(1, int(size[0]) + 1 if len(size) else 0):
        k = int(np.searchsorted(-size, -j, side="right"))  # words of j characters and more
        h, p = head[:k], first[:k]
        total = np.full(k, -np.inf)
        for n in lengths:
            if n > j:
                break
            total = np.logaddexp(total, alpha[h + j - n] + weight[n][p + j - n])
        alpha[h + j] = total
    z = alpha[head + size]
    out = np.empty(len(words))
    out[order] = z
    if weights is None:
        return out, None
    beta = np.full(len(alpha), -np.inf)
    beta[head + size] = 0
    for j in range(int(size[0]) - 1 if len(size) else -1, -1, -1):
        k = int(np.searchsorted(-size, -j, side="left"))  # words longer than j
        h, p = head[:k], first[:k]
        total = np.full(k, -np.inf)
        for n in lengths:
            fits = size[:k] >= j + n
            m = int(fits.sum())  # longest words first, so these come first
            if not m:
                break
            total[:m] = np.logaddexp(total[:m], beta[h[:m] + j + n] + weight[n][p[:m] + j])
        beta[h + j] = total
    word_of = np.repeat(np.arange(len(texts)), size)
    expected = np.zeros(len(logp))
    for n, (at, ids) in arcs.items():
        w = word_of[at]
        post = np.exp(alpha[place[at]] + logp[ids] + beta[place[at] + n] - z[w]) * weights[order][w]
        expected += np.bincount(ids, post, len(logp))
    return out, expected


def _parts(words: list[str]) -> Iterator[slice]:
    """Slices of a list of words by code points."""
    start = size = 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size >= LATTICE_POINTS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(words):
        yield slice(start, len(words))


CHUNK_FIELDS = ("part int, seq int, words array<string>, seen array<bigint>, docs bigint, keys array<struct<{keys}>>, "
                "learn array<boolean>, counts binary, places binary")


def chunks(docs: DataFrame, keys: list[str], learn: str) -> DataFrame:
    """Texts as chunks: distinct words, training occurrences, and texts as indexes into the words."""
    small_batches(docs.sparkSession)
    rows = docs.select(*keys, F.col(learn).alias("_learn"), F.col("text").cast("string").alias("text"))
    kinds = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in rows.schema if f.name in keys)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        index: dict[bytes, int] = {}
        ids: list[dict] = []
        learns: list[bool] = []
        counts: list[int] = []
        places: list[np.ndarray] = []
        size = 0
        struct = None

        def chunk() -> pa.RecordBatch:
            at = np.concatenate(places) if places else np.zeros(0, np.int32)
            here = np.repeat(np.array(learns, bool), counts)
            seen = np.bincount(at[here], minlength=len(index))
            row = {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                   "words": pa.array([[w.decode() for w in index]], pa.list_(pa.string())),
                   "seen": pa.array([seen], pa.list_(pa.int64())),
                   "docs": pa.array([sum(learns)], pa.int64()),
                   "keys": pa.array([ids], pa.list_(struct)),
                   "learn": pa.array([learns], pa.list_(pa.bool_())),
                   "counts": pa.array([np.array(counts, "<i8").tobytes()], pa.binary()),
                   "places": pa.array([at.astype("<i4").tobytes()], pa.binary())}
            return pa.RecordBatch.from_pydict(row)

        for batch in slices(batches, "text"):
            struct = pa.struct([batch.schema.field(k) for k in keys])
            texts = [t.translate(LOWER).split() for t in utf8(batch, "text")]
            for w in dict.fromkeys(chain.from_iterable(texts)):
                if w not in index:
                    index[w] = len(index)
            ids += batch.select(keys).to_pylist()
            learns += [bool(x) for x in batch.column("_learn").to_pylist()]
            counts += map(len, texts)
            places.append(np.fromiter(map(index.__getitem__, chain.from_iterable(texts)), np.int32))
            size += len(places[-1])
            if size >= CHUNK:
                yield chunk()
                seq, size = seq + 1, 0
                index, ids, learns, counts, places = {}, [], [], [], []
        if ids:
            yield chunk()

    return rows.mapInArrow(work, CHUNK_FIELDS.format(keys=kinds))


@dataclass(frozen=True)
class Model:
    """Piece weights and the sums that whole-word arcs need."""
    pieces: list[str]
    logp: np.ndarray
    tokens: int      # N: training tokens, ends included
    types: int       # V: distinct training tokens, the end included
    ends: int        # training documents
    discount: float

    def log10_word(self, count: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of a word's probability from its training count and log spelling probability."""
        n = max(self.tokens, 1)
        rest = self.discount * self.types / n if self.tokens else 1.0
        whole = np.log(np.maximum(count - self.discount, 1e-300) / n)
        return np.where(count > 0, np.logaddexp(whole, np.log(rest) + spelled), np.log(rest) + spelled) / np.log(10)


def fit(words: DataFrame, pieces: list[tuple[str, float]], ends: int) -> Model:
    """Model from ``word``, ``c`` (training count, 0 for other words) and the number of documents."""
    names = [p for p, _ in pieces]
    logp = start_weights(pieces)
    spark = words.sparkSession
    row = words.where("c > 0").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"),
        F.count(F.when(F.col("c") == 1, 1)).alias("n1"), F.count(F.when(F.col("c") == 2, 1)).alias("n2")).first()
    n1, n2 = row["n1"] + (ends == 1), row["n2"] + (ends == 2)
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    for _ in range(ROUNDS if row["v"] else 0):
        shared = spark.sparkContext.broadcast((names, logp))  # one entry per piece

        def expect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, logp = shared.value
            lookup, total = Pieces(names), np.zeros(len(names))
            for batch in batches:
                ws = batch.column("word").to_pylist()
                for s in _parts(ws):
                    total += lattice(ws[s], lookup, logp, np.ones(len(ws[s])))[1]
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["piece", "n"])

        counts = np.full(len(names), PRIOR)
        for r in (words.where("c > 0").select("word").mapInArrow(expect, "piece int, n double")
                  .groupBy("piece").agg(F.sum("n").alias("n")).collect()):
            counts[r["piece"]] += r["n"]
        logp = np.log(counts / counts.sum())
        shared.unpersist()
    return Model(names, logp, (row["n"] or 0) + ends, row["v"] + (ends > 0), ends, discount)


def spell(words: DataFrame, model: Model) -> DataFrame:
    """``word``, ``c``, ``lp`` (log10 of the word's probability)."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lookup = Pieces(model.pieces)
        for batch in batches:
            ws, c = batch.column("word").to_pylist(), batch.column("c").to_numpy(zero_copy_only=False)
            lp = [model.log10_word(c[s], lattice(ws[s], lookup, model.logp)[0]) for s in _parts(ws)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(np.concatenate(lp) if lp else [], pa.float64())],
                ["word", "c", "lp"])

    return words.mapInArrow(work, "word string, c bigint, lp double")


def score(docs: DataFrame, pieces: list[tuple[str, float]], keys: list[str] = ["doc_id"],  # noqa: B006
          learn: str = "learn") -> DataFrame:
    """``keys``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row."""
    spark = docs.sparkSession
    held = written(chunks(docs, keys, learn), "lm-chunks")
    pairs = held.select("part", "seq", F.posexplode(F.arrays_zip("words", "seen")).alias("i", "w")) \
        .select("part", "seq", "i", F.col("w.words").alias("word"), F.col("w.seen").alias("seen"))
    words = written(pairs.groupBy("word").agg(F.sum("seen").alias("c")), "lm-words")
    ends = held.agg(F.sum("docs")).first()[0] or 0
    model = fit(words, pieces, ends)
    known = written(spell(words, model), "lm-spelled")
    # ends are tokens too
    end_lp = float(model.log10_word(np.array([ends]), np.array([-np.inf if ends else 0.0]))[0])
    floor = model.tokens + model.types + 1
    fetched = pairs.select("part", "seq", "i", "word").join(known, "word") \
        .select(F.col("part").alias("p"), F.col("seq").alias("s"), "i", "c", "lp")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    tokens = model.tokens

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [*keys, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        out = []
        c = np.zeros(0, np.int64)
        lp = np.zeros(0)
        if right.num_rows:
            order = np.argsort(right.column("i").to_numpy())
            c, lp = right.column("c").to_numpy()[order], right.column("lp").to_numpy()[order]
        base = np.log10((np.append(c, ends) + 1) / floor)
        lp = np.append(lp, end_lp)
        known = np.append(c, ends) > 0
        for row in range(left.num_rows):
            counts = np.frombuffer(left.column("counts")[row].as_py(), "<i8")
            at = np.frombuffer(left.column("places")[row].as_py(), "<i4")
            at = np.insert(at, np.cumsum(counts), len(c))  # the end of each text
            doc = np.repeat(np.arange(len(counts)), counts + 1)
            ids = left.column("keys")[row].values
            out.append(pa.Table.from_arrays(
                [*(ids.field(k) for k in range(len(keys))), pa.array(counts + 1),
                 pa.array(np.bincount(doc, known[at], len(counts)).astype(np.int64)),
                 pa.array(np.full(len(counts), tokens)), pa.array(np.bincount(doc, base[at], len(counts))),
                 pa.array(np.bincount(doc, lp[at], len(counts)))], names))
        return pa.concat_tables(out)

    # one group per chunk: its texts' indexes and the rows of its words, both of bounded size
    return (held.select("part", "seq", "keys", "counts", "places").groupBy("part", "seq")
            .cogroup(fetched.groupBy("p", "s"))
            .applyInArrow(total, f"{kinds}, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                 "base_score double, score double"))

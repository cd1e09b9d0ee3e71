"""Benchmark decontamination with a generalised suffix automaton over normalised items.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. The automaton holds
all word substrings of all items; a document's words are streamed through it, tracking after each
word the longest suffix that is a substring of an item. Where that length reaches the window (13
words), the matched words are hit; an item shorter than the window, but not empty, matches whole.
Each state knows the items whose windows end there, so documents also report which items occur.

A document is contaminated if the hit words reach a share of its words (and any are hit).
``decontaminated`` gives every document its hit spans and its text without them. A hit is over the length limit by
definition (a window, or all of a shorter item), so every span goes, however much it covers; the
coverage limit is the flag, by which a user drops whole documents.

Items are read in blocks of at most ``BLOCK_WORDS`` words (a longer item is a block of its own), so
the automaton that is broadcast and held by a task has a bounded size; documents are streamed once
per block and the hits of several blocks are merged per document by their positions. Texts are
shuffled only then, once, to meet the merged hits; a single block cleans them where they are read.

Defined cases: null or wordless texts have no words and no hits; null item ids count as the id
``null`` in the list of items, which is otherwise sorted as strings; repeated items are separate
items if their ids differ; texts of any length are streamed; an empty benchmark hits nothing; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, kept, small_batches, slices, utf8, written

WINDOW = 13
#: A document is contaminated if ``SHARE`` times its hit words reach its words.
SHARE = 20
BLOCK_WORDS = 1_000_000
#: ASCII bytes that are not 0-9, A-Z, a-z become blanks, A-Z become a-z, others stay.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))
#: Size of the bit table that lets a pair of words pass if some item may hold it.
PAIR_BITS = 1 << 22


def words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws])
                     for name, ws in items if ws]
        for _, seq in sequences:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        # windows: (state, length) reached by each item, found by streaming the items themselves
        self.ends: dict[int, dict[int, set[str]]] = {}
        self.shortest = window
        for name, seq in sequences:
            size = min(window, len(seq))
            self.shortest = min(self.shortest, size)
            state = n = 0
            for c in seq:
                state, n = self.next[state][c], n + 1
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                n = min(n, self.length[state])
                if n >= size:
                    self.ends.setdefault(state, {}).setdefault(size, set()).add(name)
        # states whose suffixes include windows that end at a shorter state: follow the links once
        self.up = [0] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            parent = self.link[s]
            self.up[s] = s if s in self.ends else self.up[parent]
        self.pairs = np.zeros(PAIR_BITS, bool)
        for _, seq in sequences:
            a = np.array(seq, np.int64)
            self.pairs[self.pair_keys(a[:-1], a[1:])] = True

    @staticmethod
    def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b) & (PAIR_BITS - 1)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def match(self, codes: list[int], start: int, hit: np.ndarray, found: set[str]) -> None:
        """Stream one run of known words that begins at word ``start`` of its document."""
        nxt, link, length, up, ends = self.next, self.link, self.length, self.up, self.ends
        state = n = 0
        for i, c in enumerate(codes):
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            state = nxt[state].get(c, 0)
            n = n + 1 if state else 0
            s = up[state]
            if n < self.shortest or not s:
                continue
            while s > 0:  # states with windows among this state and its suffixes
                for size, names in ends.get(s, {}).items():
                    if n >= size:
                        hit[start + i + 1 - size:start + i + 1] = True
                        found |= names
                s = up[link[s]] if link[s] > 0 else 0


def _hits(batch_words: list[list[bytes]], machine: Automaton) -> list[tuple[np.ndarray, set[str]]]:
    """Hit words and items of each document. Only runs in which every word and every pair of
    neighbours can occur in an item go through the automaton; no window lies outside such a run."""
    flat = np.fromiter((c for ws in batch_words for c in (*map(machine.vocabulary.get, ws, repeat(-1)), -1)),
                       np.int64)
    ends = np.cumsum([len(ws) + 1 for ws in batch_words])
    known = flat >= 0
    joined = np.zeros(len(flat), bool)
    joined[1:] = known[1:] & known[:-1]
    at = np.flatnonzero(joined)
    joined[at] = machine.pairs[machine.pair_keys(flat[at - 1], flat[at])]
    # a run starts at a known word that is not joined to the word before it
    starts = np.flatnonzero(known & ~joined)
    stops = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
    long = stops - starts >= machine.shortest
    out = [(np.zeros(len(ws), bool), set()) for ws in batch_words]
    for a, b in zip(starts[long].tolist(), stops[long].tolist()):
        d = int(np.searchsorted(ends, a, side="right"))
        first = int(ends[d - 1]) if d else 0
        machine.match(flat[a:b].tolist(), a - first, *out[d])
    return out


def item_blocks(items: DataFrame, window: int = WINDOW) -> Iterator[Automaton]:
    """Automata of bounded size over all items, one after the other."""
    block, size = [], 0
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"),
                        F.col("text").cast("string").alias("t")).orderBy("i", "t")
    for r in rows.toLocalIterator():
        ws = words((r["t"] or "").encode())
        if block and size + len(ws) > BLOCK_WORDS:
            yield Automaton(block, window)
            block, size = [], 0
        block.append((r["i"], ws))
        size += len(ws)
    yield Automaton(block, window)


def _spans(hits: list[int] | np.ndarray) -> list[dict[str, int]]:
    """Runs of neighbouring positions (sorted): first word and the word after the last."""
    h = np.asarray(hits, np.int64)
    if not len(h):
        return []
    cut = np.flatnonzero(np.diff(h) != 1)
    return [{"start": int(a), "end": int(b) + 1} for a, b in zip(h[np.r_[0, cut + 1]], h[np.r_[cut, len(h) - 1]])]


def _cleaned(texts: pa.Array, hits: list) -> list[pa.Array]:
    """Columns ``spans`` and ``text`` of a batch; texts without hits stay as they are, null too."""
    spans = pa.array([_spans(h) for h in hits], pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()})))
    if any(len(h) for h in hits):
        texts = pa.array([clean_spans(t, h) if len(h) else t for t, h in zip(texts.to_pylist(), hits)], pa.string())
    return [spans, texts]


CLEAN = "spans array<struct<start bigint, end bigint>>, text string"


def _pass(docs: DataFrame, machine: Automaton, clean: bool) -> DataFrame:
    """Hits of one block of items, a row per document: ``clean`` gives spans and the text without
    them, else ``hits`` has the positions."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    keys = [f.name for f in docs.schema if f.name != "text"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        for batch in slices(batches, "text"):
            texts = [words(t) for t in utf8(batch, "text")]
            found = _hits(texts, shared.value)
            hits = [np.flatnonzero(h) for h, _ in found]
            columns = [batch.column(k) for k in keys]
            columns += [pa.array([len(ws) for ws in texts], pa.int64()),
                        pa.array([sorted(s) for _, s in found], pa.list_(pa.string()))]
            if clean:
                columns += [pa.array([len(h) for h in hits], pa.int64()), *_cleaned(batch.column("text"), hits)]
            else:
                columns.append(pa.array(hits, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                columns, [*keys, "n_words", "items", *(["n_hit", "spans", "text"] if clean else ["hits"])])
        give_back()

    return docs.mapInArrow(work, f"{kinds}, n_words bigint, items array<string>, "
                                 + (f"n_hit bigint, {CLEAN}" if clean else "hits array<bigint>"))


def decontaminated(docs: DataFrame, items: DataFrame, keys: list[str] = ["doc_id"],  # noqa: B006
                   window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``keys``, ``n_words``, ``n_hit``, ``items`` (sorted), ``contaminated``, ``spans`` (``start`` and ``end``
    word of each hit span, end exclusive) and ``text`` without them, for every document."""
    small_batches(docs.sparkSession)
    # keys travel in one column, so none of their names can clash with the operator's
    docs = docs.select(F.struct(*keys).alias("packed"), F.col("text").cast("string").alias("text"))
    if _one_block(items):
        found = _pass(docs, next(item_blocks(items, window)), clean=True)
    else:
        # one pass per block over numbered rows; hits of a row are merged by position
        docs = written(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
        every = None
        for machine in item_blocks(items, window):
            hits = written(_pass(docs, machine, clean=False).select("row", "n_words", "items", "hits"), "block-hits")
            every = hits if every is None else every.unionByName(hits)
        merged = every.groupBy("row", "n_words").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        joined = docs.join(merged, "row").select("packed", "n_words", "items", F.size("hits").cast("bigint").alias("n_hit"), "hits", "text")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema[:-2])

        def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                columns = [batch.column(i) for i in range(batch.num_columns - 2)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *_cleaned(batch.column("text"), batch.column("hits").to_pylist())],
                    [*batch.schema.names[:-2], "spans", "text"])

        found = joined.mapInArrow(clean, f"{kinds}, {CLEAN}")
    return found.select(*[F.col("packed")[k].alias(k) for k in keys], "n_words", "n_hit", "items", ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
                        .alias("contaminated"), "spans", "text")


def contamination(docs: DataFrame, items: DataFrame, keys: list[str] = ["doc_id"],  # noqa: B006
                  window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``keys``, ``n_words``, ``n_hit``, ``items`` (sorted), ``contaminated`` for every document."""
    return decontaminated(docs, items, keys, window, share).drop("spans", "text")


def _one_block(items: DataFrame) -> bool:
    """Whether all items fit one automaton (a word takes a letter and a separator at least)."""
    most = items.agg(F.sum((F.length("text") + 2) / 2)).first()[0] or 0
    return most <= BLOCK_WORDS


def clean_spans(text: str, hits: list[int]) -> str:
    """A text without its hit words: the words at these positions and the gaps between them go."""
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(
        {c: c + 32 for c in range(65, 91)})))
    out, at, gone = [], 0, set(hits)
    for i, m in enumerate(found):
        if i in gone:
            if i - 1 not in gone:
                out.append(text[at:m.start()])
            at = m.end()
    return "".join(out) + text[at:]


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = decontaminated(docs, items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")

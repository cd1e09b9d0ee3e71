"""Byte-level BPE as a lazily determinised transducer, and streaming UTF-8 decoding.

Encoding. A token sequence is the BPE encoding of its bytes exactly if each pair of neighbours
is: the merges, run on the two tokens' bytes alone, give these two tokens back. So the last token
of every prefix is fixed, and an encoding can be read off from left to right. The transducer's
state after some bytes is what the future can depend on: the positions from which some token may
still be read (each a node of the vocabulary's trie) and the last token before each of them.
Reading a byte moves the nodes, finds the one last token that is compatible with what stands before
it, and drops positions that no token can continue. Tokens that the readings of all live positions
share are emitted; a live position lies no further back than the longest token, so the lookahead is
bounded. States and transitions are made when first met and kept in a table of bounded size
(dropped and rebuilt when full; results are the same), as plain numbers in arrays: two workers of a
task run at once beside the JVM, and dictionaries of number objects took three times the memory.

As in the reference semantics of rank files, a piece that is itself a token is that token, and
pieces are the matches of a split pattern, encoded separately.

Decoding. Ids become bytes by table. A UTF-8 state machine (one state per kind of unfinished
sequence) is composed with each token's bytes once, so a stream of ids moves it token by token;
complete characters leave at once, an unfinished tail waits for the next ids.

Defined cases: null text is empty and has no ids; lone surrogates cannot occur in Spark strings;
an id outside the vocabulary is an error; repeated rows give repeated rows; extra columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, kept, small_batches, slices, splitter


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one ``base64 rank`` line per token."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Merges by rank, lowest first, leftmost on ties."""
    none = 1 << 40
    parts = [piece[i:i + 1] for i in range(len(piece))]
    costs = [ranks.get(x + y, none) for x, y in zip(parts, parts[1:])]
    while costs and (best := min(costs)) != none:
        i = costs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i < len(costs):
            costs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return parts


#: Slots of the tables of moves and fits, and the odd multiplier of their hash. A key's search starts at its hash and
#: ends at an empty slot (0), so a table must never be full.
SLOTS, ODD = 1 << 20, 0x9E3779B97F4A7C15


def _zeros() -> array:
    return array("q", bytes(8 * SLOTS))


class Transducer:
    """Bytes in, token ids out; see the module's text.

    A state is a flat row of (node, last) for each live position, oldest first: the node of the
    vocabulary's trie that the bytes since that position lead to, and the last token of the prefix
    that ends there (-1 before the first). Reading a byte yields the last token of the longer
    prefix; chains of last tokens lead back, and what all live positions share can leave.
    """

    MOST_MOVES = MOST_FITS = 400_000
    #: Pending bytes of a piece at which agreed tokens are emitted; the live part is no longer
    #: than the longest token.
    LOOKAHEAD = 1 << 12

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.trie: dict[int, int] = {}
        self.token, self.depth, self.inner = [-1], [0], [False]
        for t, i in ranks.items():
            node = 0
            for b in t:
                self.inner[node] = True
                key = node << 8 | b
                node = self.trie.get(key, 0)
                if not node:
                    node = self.trie[key] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[key >> 8] + 1)
                    self.inner.append(False)
            self.token[node] = i
        self.fits, self.n_fits = _zeros(), 0
        self._clear()

    def _clear(self) -> None:
        self.states: list[bytes] = []
        self.numbers: dict[bytes, int] = {}
        # from (state + 1, byte) to (state, last token)
        self.froms, self.tos, self.n_moves = _zeros(), _zeros(), 0
        self.start = self._number([0, -1])

    def _number(self, row: list[int]) -> int:
        state = array("i", row).tobytes()
        n = self.numbers.get(state)
        if n is None:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
        return n

    def _fit(self, a: int, b: int) -> bool:
        """Whether b can follow a; a = -1 asks whether merges make b at all (some entries of a
        vocabulary only match whole pieces)."""
        fits, key = self.fits, a + 2 << 32 | b
        i = key * ODD >> 36 & SLOTS - 1
        while got := fits[i]:
            if got == key or got == -key:
                return got > 0
            i = i + 1 & SLOTS - 1
        x, y = self.bytes.get(a, b""), self.bytes[b]
        fit = merge(x + y, self.ranks) == ([x, y] if x else [y])
        if self.n_fits >= self.MOST_FITS:
            self.fits, self.n_fits = _zeros(), 0
            i = key * ODD >> 36 & SLOTS - 1
        self.fits[i] = key if fit else -key
        self.n_fits += 1
        return fit

    def _move(self, number: int, byte: int) -> tuple[int, int]:
        state, trie, found, live = array("i", self.states[number]), self.trie, -1, []
        for j in range(0, len(state), 2):  # the longest candidate first; exactly one fits
            node = trie.get(state[j] << 8 | byte)
            if node is None:
                continue
            last, t = state[j + 1], self.token[node]
            if found < 0 <= t and self._fit(-1, t) and (last < 0 or self._fit(last, t)):
                found = t
            if self.inner[node]:
                live += (node, last)
        if found < 0:
            raise ValueError(f"no token ends with byte {byte}; the vocabulary lacks single bytes")
        return self._number([*live, 0, found]), found

    def _made(self, state: int, byte: int, slot: int) -> tuple[int, int]:
        """Makes a move that the table lacks; ``slot`` is the empty one that its search ended at."""
        if self.n_moves >= self.MOST_MOVES:
            here = self.states[state]
            self._clear()
            state = self._number(list(array("i", here)))
            slot = (state + 1 << 8 | byte) * ODD >> 36 & SLOTS - 1
        to, last = self._move(state, byte)
        self.froms[slot], self.tos[slot] = state + 1 << 8 | byte, to << 32 | last
        self.n_moves += 1
        return to, last

    def _back(self, lasts: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            t = lasts[end - 1]
            out.append(t)
            end -= self.size[t]
        return out[::-1]

    def _agreed(self, state: int, n: int, lasts: list[int]) -> int:
        """The furthest position through which the readings of all live positions pass."""
        live = {n - self.depth[node] for node in array("i", self.states[state])[::2]}
        while len(live) > 1:
            p = max(live)
            live.remove(p)
            live.add(p - self.size[lasts[p - 1]])
        return live.pop()

    def run(self, piece: bytes) -> list[int]:
        state, out, lasts = self.start, [], []
        froms, tos = self.froms, self.tos
        for byte in piece:
            key = state + 1 << 8 | byte
            i = key * ODD >> 36 & SLOTS - 1
            while (got := froms[i]) != key and got:
                i = i + 1 & SLOTS - 1
            if got:
                to = tos[i]
                state, last = to >> 32, to & 0xFFFFFFFF
            else:
                state, last = self._made(state, byte, i)
                froms, tos = self.froms, self.tos
            lasts.append(last)
            if len(lasts) >= self.LOOKAHEAD:
                done = self._agreed(state, len(lasts), lasts)
                out += self._back(lasts, done)
                del lasts[:done]
        return out + self._back(lasts, len(lasts))

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece: itself if it is a token, else the transducer's output."""
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else self.run(piece)


class PieceIds(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers; bounded, refilled as needed."""

    MOST = 170_000

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, piece: str) -> bytes:
        ids = struct.pack(f"<{len(got := self.machine.encode(piece.encode()))}I", *got)
        if len(self) >= self.MOST:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


#: The UTF-8 machine: 0 between characters, then one state per kind of unfinished sequence, by
#: what may follow: lowest and highest next byte, and the state after it.
ACCEPT, REJECT = 0, 8
FOLLOW = {1: (0x80, 0xBF, ACCEPT), 2: (0x80, 0xBF, 1), 3: (0xA0, 0xBF, 1), 4: (0x80, 0x9F, 1),
          5: (0x80, 0xBF, 2), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
LEAD = [(0x00, 0x7F, ACCEPT), (0xC2, 0xDF, 1), (0xE0, 0xE0, 3), (0xE1, 0xEC, 2), (0xED, 0xED, 4),
        (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 5), (0xF4, 0xF4, 7)]


def utf8_steps() -> np.ndarray:
    """steps[state, byte]: the next state."""
    steps = np.full((REJECT + 1, 256), REJECT, np.uint8)
    for low, high, to in LEAD:
        steps[ACCEPT, low:high + 1] = to
    for state, (low, high, to) in FOLLOW.items():
        steps[state, low:high + 1] = to
    return steps


def compose(tokens: list[bytes]) -> np.ndarray:
    """table[token, state]: the machine's state after all bytes of a token."""
    steps = utf8_steps()
    table = np.empty((len(tokens), REJECT + 1), np.uint8)
    for i, t in enumerate(tokens):
        state = np.arange(REJECT + 1)
        for b in t:
            state = steps[state, b]
        table[i] = state
    return table


class Decoder:
    """Ids to bytes, in a stream: ``feed`` returns the bytes of complete characters, ``finish``
    the rest. Bytes that are not UTF-8 pass unchanged and clear ``valid``; the machine then goes
    on between characters."""

    def __init__(self, tokens: list[bytes], table: np.ndarray):
        self.tokens, self.table = tokens, table
        self.state, self.tail, self.valid = ACCEPT, b"", True

    def feed(self, ids: np.ndarray) -> bytes:
        data = self.tail + b"".join(map(self.tokens.__getitem__, ids.tolist()))
        # between characters only tokens that end inside one move the machine
        moving = np.flatnonzero(self.table[ids, ACCEPT])
        state, at = self.state, 0
        while at < len(ids):
            if state == ACCEPT:
                k = np.searchsorted(moving, at)
                if k == len(moving):
                    break
                at = moving[k]
            state = int(self.table[ids[at], state])
            if state == REJECT:
                self.valid, state = False, ACCEPT
            at += 1
        self.state = state
        keep = 0
        if state != ACCEPT:  # an unfinished character: its lead byte and what follows
            keep = 1
            while data[-keep] & 0xC0 == 0x80:
                keep += 1
        self.tail = data[len(data) - keep:]
        return data[:len(data) - keep]

    def finish(self) -> bytes:
        self.valid = self.valid and self.state == ACCEPT
        tail, self.tail, self.state = self.tail, b"", ACCEPT
        return tail


#: Ids decoded at a time.
STREAM = 1 << 16


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit), ``n_tokens`` of each whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)  # a vocabulary file: bounded by its size
    key = hash(frozenset(ranks.items()))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = kept(("bpe", key), lambda: PieceIds(Transducer(shared.value))).__getitem__
        split = splitter(pattern)
        for batch in slices(batches, "text"):
            ids = [b"".join(map(lookup, split(t or ""))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array([len(x) // 4 for x in ids], pa.int64())], ["doc_id", "ids", "n_tokens"])
        give_back()

    return rows.mapInArrow(work, f"doc_id {kind}, ids binary, n_tokens bigint")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``decoded`` (bytes) and ``valid`` (they are UTF-8) to rows of ``encode``."""
    spark = encoded.sparkSession
    small_batches(spark)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for t, i in ranks.items():
        tokens[i] = t
    shared = spark.sparkContext.broadcast((tokens, compose(tokens)))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        for batch in slices(batches, "ids"):
            out, valid = [], []
            for data in batch.column("ids").to_pylist():
                ids, machine = np.frombuffer(data, "<u4"), Decoder(*shared.value)
                out.append(b"".join(machine.feed(ids[i:i + STREAM])
                                    for i in range(0, len(ids), STREAM)) + machine.finish())
                valid.append(machine.valid)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary()), pa.array(valid)],
                [*batch.schema.names, "decoded", "valid"])
        give_back()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(work, f"{kinds}, decoded binary, valid boolean")

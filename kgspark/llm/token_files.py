"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Format: a folder of the shared store with two Parquet tables.

* ``header``  -- one row: ``lengths``, the code length of every id (one byte each; 0: unused),
  ``n_tokens``. Codes are canonical, so the lengths are the whole code.
* ``chunks``  -- rows of consecutive documents in ascending ``doc_id`` order: ``part`` and ``seq``
  (place), ``first_token`` (ids of all documents before the chunk), ``doc_ids`` (little-endian
  int64) with ``null_ids`` (one byte each), ``counts`` (int64, ids per document), ``bits`` (the
  codes, most significant bit first) and ``checkpoints`` (uint64, the bit offset of every block of
  ``BLOCK`` ids). A block is decoded from its checkpoint alone, so any part of a chunk can be read
  without what stands before it.

Decoding is by table: the next ``longest`` bits index the id and its length. All blocks of a chunk
are decoded side by side, one id each per step.

Writing: documents are range-partitioned on (id, hash of text), so a repeated id is spread by text;
each partition tokenises its documents in order into chunks and writes them once to the shared
folder. Global counts, at most one per vocabulary entry, and partition totals, one per partition,
are all that the driver sees. The code is optimal among codes of at most ``MAX_BITS`` bits
(package-merge). A chunk ends after ``CHUNK`` ids or at the end of a longer document.

Defined cases: null text is empty; null ids sort first; rows of equal id are ordered by the hash of
their text; an empty table gives an archive without chunks; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, latin_pattern, small_batches, slices, splitter, utf8, written

MAX_BITS = 20
BLOCK = 256
CHUNK = 1 << 18
CHUNK_FIELDS = ("part int, seq int, before bigint, doc_ids binary, null_ids binary, counts binary, "
                "n_tokens bigint, ids binary")


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with no code longer than ``most`` bits (package-merge):
    in each round neighbouring packages are paired and merged with the symbols; a symbol's length
    is the number of chosen packages that hold it. 0 for symbols that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols need codes of more than {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    n = len(order)
    # rounds[r]: for each item of round r, in ascending weight, whether it is a symbol
    rounds, current = [], weight
    is_symbol = np.ones(n, bool)
    rounds.append(is_symbol)
    for _ in range(most - 1):
        m = len(current) // 2
        packages = current[:2 * m:2] + current[1:2 * m:2]
        merged = np.concatenate([weight, packages])
        by = np.argsort(merged, kind="stable")
        current, is_symbol = merged[by], by < n
        rounds.append(is_symbol)
    # take the 2n-2 lightest of the last round; each package taken stands for two of the round below
    take, depth = 2 * n - 2, np.zeros(n, np.int64)
    for is_symbol in reversed(rounds):
        symbols = int(is_symbol[:take].sum())
        depth[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by (length, id), counting up."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[i])
        if n:
            code = (code + 1) << (n - last) if last else 0
            codes[i], last = code, n
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes' bits, and the bit offset of each block."""
    if not len(ids):
        return b"", np.zeros(0, np.uint64)
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    starts = ends - n
    word = starts >> 5
    window = codes[ids] << (64 - (starts & 31) - n).astype(np.uint64)  # 64 bits from that word on
    heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    joined = np.bitwise_or.reduceat(window, heads)
    at = word[heads]
    words = np.zeros(int(at[-1]) + 2, np.uint32)
    words[at] = (joined >> np.uint64(32)).astype(np.uint32)
    words[at + 1] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return words.astype(">u4").tobytes()[:(int(ends[-1]) + 7) // 8], starts[::BLOCK].astype(np.uint64)


class Reader:
    """Table-driven decoder of one code."""

    def __init__(self, lengths: np.ndarray):
        self.longest = int(lengths.max(initial=1))
        codes = canonical(lengths)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]  # canonical codes fill the table in order
        span = 1 << (self.longest - lengths[order].astype(np.int64))
        size = 1 << self.longest
        self.symbol = np.zeros(size, np.uint32)
        self.length = np.zeros(size, np.uint8)
        filled = int(span.sum())
        self.symbol[:filled] = np.repeat(order, span)
        self.length[:filled] = np.repeat(lengths[order], span)
        assert not len(order) or int(codes[order[0]]) == 0

    def unpack(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All ``n`` ids of a chunk; blocks side by side."""
        data = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.uint32)
        # 32 bits from each byte on: 20 bits at any bit offset lie inside
        at_byte = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        at = checkpoints.astype(np.int64)
        out = np.empty((BLOCK, len(at)), np.uint32)
        mask = (1 << self.longest) - 1
        for step in range(min(BLOCK, n)):
            if step == n - (len(at) - 1) * BLOCK:  # the last block is shorter
                at = at[:-1]
            key = (at_byte[at >> 3] >> (32 - self.longest - (at & 7)).astype(np.uint32)) & mask
            out[step, :len(at)] = self.symbol[key]
            at = at + self.length[key]
        return out.T.reshape(-1)[:n]


def _together(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts (null: empty) of rows in order, about ``TOGETHER`` bytes of text at a time."""
    keys: list = []
    texts: list[bytes] = []
    size = 0
    for batch in slices(batches, "text"):
        keys += batch.column("doc_id").to_pylist()
        new = utf8(batch, "text")
        texts += new
        size += sum(map(len, new))
        if size >= TOGETHER:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _tokenised(docs: DataFrame, make: Callable, end_id: int, width: int) -> DataFrame:
    """Chunks of ids in ascending id order, per partition. ``make()`` gives, in each task, a
    function from texts (bytes) to a list of id arrays."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = f"<u{width}"
    ordered = (docs.withColumn("h", F.xxhash64("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), "h")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            row = (part, seq, before,
                   np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
                   np.array([x is None for x in doc_ids], "u1").tobytes(),
                   np.array([len(x) for x in held], "<i8").tobytes(), size,
                   np.concatenate(held).astype(kind).tobytes())
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)],
                                              [f.split()[0] for f in CHUNK_FIELDS.split(", ")])

        for keys, texts in _together(batches):
            for doc_id, ids in zip(keys, encode(texts)):
                doc_ids.append(doc_id)
                held.append(np.append(ids, end_id))
                size += len(ids) + 1
                if size >= CHUNK:
                    yield chunk()
                    seq, before = seq + 1, before + size
                    doc_ids, held, size = [], [], 0
        if doc_ids:
            yield chunk()

    return ordered.select("doc_id", "text").mapInArrow(work, CHUNK_FIELDS)


def write(docs: DataFrame, path: str, make: Callable, end_id: int, n_ids: int) -> str:
    """Tokenise every row of ``doc_id``, ``text`` and write the files under ``path``."""
    spark = docs.sparkSession
    width = 2 if n_ids <= 1 << 16 else 4
    tokens = written(_tokenised(docs, make, end_id, width), "tokens")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                total += np.bincount(np.frombuffer(ids, f"<u{width}"), minlength=n_ids)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["id", "n"])

    counts = np.zeros(n_ids, np.int64)
    # one row per vocabulary entry at most, and one per partition
    for r in (tokens.select("ids").mapInArrow(count, "id int, n bigint")
              .groupBy("id").agg(F.sum("n").alias("n")).collect()):
        counts[r["id"]] = r["n"]
    before, total = {}, 0
    for r in tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        before[r["part"]], total = total, total + r["n"]
    lengths = code_lengths(counts)
    shared = spark.sparkContext.broadcast((lengths, canonical(lengths), before))

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        lengths, codes, before = shared.value
        for batch in batches:
            coded = [pack(np.frombuffer(x, f"<u{width}"), lengths, codes) for x in batch.column("ids").to_pylist()]
            first = [before[p] + b for p, b in zip(batch.column("part").to_pylist(), batch.column("before").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "seq")), pa.array(first, pa.int64()),
                 *(batch.column(c) for c in ("doc_ids", "null_ids", "counts", "n_tokens")),
                 pa.array([b for b, _ in coded], pa.binary()),
                 pa.array([c.astype("<u8").tobytes() for _, c in coded], pa.binary())],
                ["part", "seq", "first_token", "doc_ids", "null_ids", "counts", "n_tokens", "bits", "checkpoints"])

    (tokens.mapInArrow(code, "part int, seq int, first_token bigint, doc_ids binary, null_ids binary, "
                             "counts binary, n_tokens bigint, bits binary, checkpoints binary")
     .write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/chunks"))
    (spark.createDataFrame([(bytearray(lengths.tobytes()), total)], "lengths binary, n_tokens bigint")
     .write.mode("overwrite").parquet(f"{path}/header"))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian
    unsigned 32-bit)."""
    small_batches(spark)
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/header").first()["lengths"]), np.uint8)
    shared = spark.sparkContext.broadcast(lengths)  # one byte per vocabulary entry

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        reader = Reader(shared.value)
        for batch in slices(batches, "bits", 1):
            row = {k: v[0] for k, v in batch.to_pydict().items()}
            ids = reader.unpack(row["bits"], np.frombuffer(row["checkpoints"], "<u8"), row["n_tokens"]).astype("<u4")
            counts = np.frombuffer(row["counts"], "<i8")
            ends = np.cumsum(counts)
            keys = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["null_ids"], "u1").astype(bool))
            data = ids.tobytes()
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(row["first_token"] + ends - counts), pa.array(counts),
                 pa.array([data[4 * (e - n):4 * e] for n, e in zip(counts.tolist(), ends.tolist())], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])

    return (spark.read.parquet(f"{path}/chunks")
            .mapInArrow(work, "doc_id bigint, start bigint, n_tokens bigint, ids binary"))


#: Encoders of this Python worker, by tokenizer file.
_ENCODERS: dict[int, Callable] = {}


def drop_encoders() -> None:
    """Free the encoders of this Python worker: Spark hands workers on to the stages that count, code and read."""
    if _ENCODERS:
        _ENCODERS.clear()
        give_back()


#: Pieces that go through the library in one text, texts per call, and remembered pieces with their bytes.
JOINED, CALL, MOST, LONGEST = 2000, 8, 800_000, 64
#: Bytes of text that are encoded together: the more, the fewer words are seen anew.
TOGETHER = 12 << 20


def library_encoder(spark: SparkSession, path: str) -> Callable:
    """``make`` for a tokenizer file of the tokenizers library, without special tokens added."""
    with open(path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary file: bounded by its size
    key = zlib.crc32(model.value.encode())

    def make() -> Callable:
        if key not in _ENCODERS:
            _ENCODERS[key] = _encoder(model.value)
        return _ENCODERS[key]

    return make


def _runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``values``, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]


def _encoder(model: str) -> Callable:
    """Texts (UTF-8) to id arrays, as the library encodes whole texts.

    If the file normalises to lower-case NFC and splits by a pattern that drops white space, nothing
    joins across ASCII white space, so each distinct word of a batch is encoded once. Words of Latin-1
    characters (which NFC leaves alone) are lower-cased and split here, all in one text, and each distinct piece
    is looked up once in a table of bounded size; the missing ones go many at a time through the library's model, whose ids
    come apart where one ends a piece. All other words, and those that hold an added token, go through
    the whole library one by one. A full table keeps what it has (frequent pieces come early); further
    pieces are kept for their batch alone.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one that it has
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer, spec = Tokenizer.from_str(model), json.loads(model)

    def many(texts: list[str], by: Tokenizer = tokenizer) -> list[list[int]]:
        return [e.ids for e in by.encode_batch_fast(texts, add_special_tokens=False)]

    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    if kinds != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in steps] != ["Split", "ByteLevel"] \
            or not steps[0]["invert"] or spec["model"].get("end_of_word_suffix") != "</w>" \
            or any(t["normalized"] for t in spec["added_tokens"]):
        return lambda texts: [np.array(x, "<u4") for x in many([t.decode() for t in texts])]
    pattern = steps[0]["pattern"]["Regex"]
    split = splitter(pattern)
    # words in lines of one text are split alike, if the pattern neither looks around nor takes line ends
    alone = not re.search(r"\(\?[=!<]|\\[bBAGzZK]|(?<!\[)\^|\$", pattern) and not re.search(latin_pattern(pattern), "\n")
    separate = re.compile(f"(?:{latin_pattern(pattern)})|\n").findall if alone else None
    beyond = re.compile(rb"[\xc4-\xff\x1c-\x1f]").search  # beyond Latin-1, or white space to ``re`` alone
    added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)").search
    # the model alone, for pieces that are already normalised, split and spelt in signs for bytes
    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    spelt = {c: spell(chr(c))[0][0] for c in range(256)}
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids that end a piece
    ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    of_piece: dict[bytes, bytes] = {b"": b""}

    def whole(words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        for k in range(0, len(words), JOINED):
            some = words[k:k + JOINED]
            yield from zip(some, (np.array(ids, "<u4").tobytes() for ids in many([w.decode() for w in some])))

    def pieces(missing: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        lists = [missing[i:i + JOINED] for i in range(0, len(missing), JOINED)]
        for k in range(0, len(lists), CALL):
            some = lists[k:k + CALL]
            for ws, found in zip(some, many([b" ".join(ws).decode().translate({**spelt, 32: " "}) for ws in some], bare)):
                ids = np.array(found, "<u4")
                stops = np.flatnonzero(ends[ids]) + 1
                if len(stops) != len(ws):  # an id that may also stand inside a piece
                    yield from whole(ws)
                    continue
                data, at = ids.tobytes(), 0
                for w, stop in zip(ws, (4 * stops).tolist()):
                    yield w, data[at:stop]
                    at = stop

    def split_all(words: list[bytes]) -> tuple[pa.Array, np.ndarray] | None:
        """Pieces of Latin-1 words, all split in one text, and the place of each one's word; None if they must go one by one."""
        text = b"\n".join(words).decode()
        if separate is None or added(text):
            return None
        found = pa.array(separate(text.lower()), pa.large_string())
        between = pc.equal(found, "\n").to_numpy(zero_copy_only=False)
        if between.sum() != len(words) - 1:
            return None
        return found.filter(pa.array(~between)), np.cumsum(between)[~between]

    def look_up(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has."""
        letters = pc.ascii_is_alpha(words)
        rest = words.filter(pc.invert(letters)).cast(pa.large_binary()).to_pylist()
        letters_at = np.flatnonzero(letters)
        places = np.flatnonzero(pc.invert(letters))
        odd = np.fromiter(map(bool, map(beyond, rest)), bool, len(rest))
        found = split_all([w for w, o in zip(rest, odd.tolist()) if not o])
        if found is None:
            odd[:] = True
            found = pa.array([], pa.large_string()), np.array([], np.int64)
        alone: list[str] = []       # pieces of words that are split one by one, and their words' places
        alone_at: list[int] = []
        others: list[bytes] = []    # words that go through the whole library, and their places
        others_at: list[int] = []
        for k in np.flatnonzero(odd).tolist():
            text = rest[k].decode()
            if (not text.isascii() and max(text) > "\xff") or added(text):
                others.append(rest[k])
                others_at.append(places[k])
            else:
                ps = split(text.lower())
                alone += ps
                alone_at += [places[k]] * len(ps)
        coded = pa.concat_arrays([pc.ascii_lower(words.filter(letters)), found[0], pa.array(alone, pa.large_string())]).dictionary_encode()
        wanted = coded.dictionary.cast(pa.large_binary()).to_pylist()
        known = list(map(of_piece.get, wanted))
        missing = [w for w, ids in zip(wanted, known) if ids is None]
        plain = [w for w in missing if w.isascii()]  # apart: their signs are spelt faster
        fresh = dict(pieces(plain))
        fresh.update(pieces([w for w in missing if not w.isascii()]))
        known = [fresh[w] if ids is None else ids for w, ids in zip(wanted, known)]
        if len(of_piece) + len(fresh) <= MOST:
            of_piece.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST)
        word = np.concatenate([letters_at, places[~odd][found[1]], alone_at, others_at]).astype(np.int64)
        piece = np.concatenate([coded.indices, len(known) + np.arange(len(others))]).astype(np.int64)
        known += [ids for _, ids in whole(others)]
        order = np.argsort(word, kind="stable")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        n = sizes[piece]
        ids = _runs(np.frombuffer(b"".join(known), "<u4"), (np.cumsum(sizes) - sizes)[piece][order], n[order])
        return ids, np.bincount(word, n, minlength=len(words)).astype(np.int64)

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        # one word column for all texts; each distinct word is looked up once
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        ids, sizes = look_up(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        ends_at = np.cumsum(n)
        out = _runs(ids, (np.cumsum(sizes) - sizes)[at], n)
        edges = np.concatenate([[0], ends_at])[lists.offsets.to_numpy()]
        return [out[i:j] for i, j in itertools.pairwise(edges.tolist())]

    return encode

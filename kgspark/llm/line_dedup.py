r"""Line dedup: lines whose key occurs in many documents go from every document.

A text is split at ``\n``. A line's key is the line without white space (``[\x20\x09-\x0D]``) at both
ends, A-Z lower-cased. ``_lines`` explodes a document into the 128-bit digests of its keys,
``frequent`` counts the distinct documents of each (each document sends a digest once, sums are
combined before the shuffle) and keeps those over the threshold, ``dropped_positions`` joins them
back to the lines, and ``dedup_lines`` reassembles each document by position.

Only digests and positions are shuffled by line; texts cross one join by document, which Spark
turns into a broadcast if the table of dropped positions, written before, is small by its real
size. A line that stands in a third of all documents is one row per task in the count, and its
rows in the join are split by adaptive execution (or not dealt at all in a broadcast join).

Defined cases: a null or empty text is one empty line; a table's rows are documents of their own,
so equal rows count as often as they occur; keys shorter than ``min_chars`` code points never go;
a text that loses all lines is empty; a null key column is a value like any other; an empty table
gives no rows; columns that are no keys are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import empty_text, slices, small_batches, utf8, written

#: White space that a key loses at its ends (fixed values).
SPACE = b" \t\n\v\f\r"


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line of a text; ``bytes.lower`` changes A-Z only."""
    return [line.strip(SPACE) for line in text.lower().split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _texts(docs: DataFrame, *columns) -> DataFrame:
    """The texts, and the digest that stands for a text: equal texts lose the same lines."""
    text = empty_text(F.col("text").cast("string"))
    return docs.select(*columns, text.alias("text"), F.unhex(F.md5(text)).alias("document"))


def _lines(docs: DataFrame, min_chars: int, positions: bool) -> DataFrame:
    """``line`` digests of every document, each once; with ``positions`` every line of it, with its
    place in the text and the ``document`` it belongs to."""
    small_batches(docs.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lines, places, owners = [], [], []
            for text, document in zip(utf8(batch, "text"), batch.column("document").to_pylist()):
                keys = line_keys(text)
                if not positions:
                    lines.extend(xxhash.xxh3_128_digest(k) for k in set(keys) if _long_enough(k, min_chars))
                    continue
                kept = [(i, xxhash.xxh3_128_digest(k)) for i, k in enumerate(keys) if _long_enough(k, min_chars)]
                places.extend(i for i, _ in kept)
                lines.extend(d for _, d in kept)
                owners.extend([document] * len(kept))
            columns = {"line": pa.array(lines, pa.binary())}
            if positions:
                columns |= {"place": pa.array(places, pa.int32()), "document": pa.array(owners, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    schema = "line binary" + ", place int, document binary" * positions
    return _texts(docs).mapInArrow(work, schema)


def frequent(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``line`` digest and ``n_docs`` of the keys found in at least ``min_docs`` documents."""
    return (_lines(docs, min_chars, positions=False).groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") >= min_docs))


def dropped_positions(docs: DataFrame, lines: DataFrame, min_chars: int = 1) -> DataFrame:
    """``document`` digest and the sorted ``places`` of its lines that go. Copies of a text are one
    row: the set of places is combined before the shuffle."""
    found = _lines(docs, min_chars, positions=True).join(lines.select("line"), "line")
    return found.groupBy("document").agg(F.sort_array(F.collect_set("place")).alias("places"))


def dedup_lines(docs: DataFrame, keys: list[str] = ["doc_id"], min_docs: int = 10,  # noqa: B006
                min_chars: int = 1) -> DataFrame:
    """``keys``, ``kept`` (the text without the lines that go), ``n_lines`` before, ``n_dropped``."""
    lines = written(frequent(docs, min_docs, min_chars), "frequent-lines")
    drops = written(dropped_positions(docs, lines, min_chars), "dropped-lines")
    rows = _texts(docs, *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)])
    rows = rows.join(drops, "document", "left").drop("document")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name.startswith("key"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            kept, counts, gone = [], [], []
            for text, places in zip(utf8(batch, "text"), batch.column("places").to_pylist()):
                counts.append(text.count(b"\n") + 1)
                gone.append(len(places or ()))
                if places:
                    out = set(places)
                    text = b"\n".join(line for i, line in enumerate(text.split(b"\n")) if i not in out)
                kept.append(text)
            columns = {k: batch.column(k) for k in batch.schema.names if k.startswith("key")}
            yield pa.RecordBatch.from_pydict(columns | {
                "kept": pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array(counts, pa.int64()),
                "n_dropped": pa.array(gone, pa.int64())})

    done = rows.mapInArrow(work, f"{kinds}, kept string, n_lines bigint, n_dropped bigint")
    return done.select(*[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)], "kept", "n_lines", "n_dropped")

"""Helpers shared by the operators: column access, shared-folder tables, Arrow slices."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.session import ensure_checkpoint_dir

#: Bytes of text that one Arrow batch or one inner slice of a batch carries to Python.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: work done once, lineage cut."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python by bytes, so a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))


def empty_text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def crc_fold(key: str, modulus: int) -> Column:
    """crc32(key as text) mod modulus; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus))


def slices(batches: Iterable[pa.RecordBatch], column: str,
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            size += n or 0
            if size >= most:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Return freed memory to the system. Spark hands a Python worker from stage to stage, and what one stage freed
    would otherwise stay with the worker while the next one runs in others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: What this Python worker keeps from task to task: one thing, by its name.
_KEPT: dict[object, object] = {}


def kept(name: object = None, make: Callable[[], object] | None = None) -> object:
    """The thing of this name, made once per worker as long as the worker does the same work. Spark gives a worker any
    stage's tasks, so what it kept for others goes first; without ``make`` nothing is kept."""
    if _KEPT and name not in _KEPT:
        _KEPT.clear()
        give_back()
    if make and name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT.get(name)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


#: Letters and numbers among Latin-1 characters (fixed values: their Unicode categories).
LATIN_1 = {"L": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff",
           "N": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"}
#: Characters that ``re`` alone counts as white space.
_ODD_SPACE = re.compile("[\x1c-\x1f]").search


def latin_pattern(pattern: str) -> str:
    """A pattern of ``regex`` for ``re``, for Latin-1 texts: \\p{L} and \\p{N} spelled out."""
    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\.|[\[\]])", pattern):
        if part in ("[", "]"):
            inside = part == "["
        if part.startswith("\\p{"):
            part = LATIN_1[part[3]] if inside else f"[{LATIN_1[part[3]]}]"
        out.append(part)
    return "".join(out)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern in a text; Latin-1 texts by the faster ``re``."""
    fast, full = re.compile(latin_pattern(pattern)).findall, regex.compile(pattern).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return full(text)
        return full(text) if _ODD_SPACE(text) else fast(text)

    return split

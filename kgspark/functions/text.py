"""Scalar Column functions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters Python's str.strip() removes (FIXED VALUE: the Unicode White_Space set
# plus the four ASCII separators 0x1C-0x1F). Spark's trim() strips spaces only.
PY_WHITESPACE_CLASS = (
    r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
    r"\x{202F}\x{205F}\x{3000}]"
)
_STRIP_RE = f"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+$"
_BLANK_RE = f"^{PY_WHITESPACE_CLASS}*$"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_hash(text: str | Column) -> Column:
    """sha256 hex of the UTF-8 text; NULL counts as the empty string."""
    return F.sha2(F.coalesce(col_(text), F.lit("")), 256)


def py_strip(c: str | Column) -> Column:
    return F.regexp_replace(col_(c), _STRIP_RE, "")


def normalize_name(c: str | Column) -> Column:
    """Python ``strip().upper()``."""
    return F.upper(py_strip(c))


def is_blank(c: str | Column) -> Column:
    """True when the text is empty or whitespace only (Python ``not s.strip()``)."""
    return F.coalesce(col_(c), F.lit("")).rlike(_BLANK_RE)


def truthy_text(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """``str(x or "")`` -- NULL, empty and numeric zero become ""."""
    c = col_(c)
    if isinstance(dtype, T.NumericType):
        return F.when(c.isNull() | (c == 0), F.lit("")).otherwise(c.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).otherwise(F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def stable_id(kind: str, *parts: str | Column) -> Column:
    """Deterministic 36-character id from a natural key.

    The key is length-prefixed (``kind:len:part:len:part``) so that no two keys
    share a hash input, then sha256 is formatted 8-4-4-4-12 like a UUID.
    """
    pieces: list[Column] = [F.lit(kind)]
    for p in parts:
        pc = F.coalesce(col_(p).cast("string"), F.lit(""))
        pieces += [F.lit(":"), F.length(pc).cast("string"), F.lit(":"), pc]
    h = F.sha2(F.concat(*pieces), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def composite_key(kind: str, a: str | Column, b: str | Column) -> Column:
    """the pass-through key ``entity::NAME::TYPE`` / ``rel::SRC::TGT``."""
    return F.concat_ws("::", F.lit(kind), col_(a), col_(b))


def numbered_lines(arr: str | Column) -> Column:
    """``1. d1\\n2. d2 ...`` from an ordered array of strings."""
    return F.array_join(
        F.transform(col_(arr), lambda d, i: F.concat((i + 1).cast("string"), F.lit(". "), d)),
        "\n")


def float_text(c: str | Column) -> Column:
    """Python ``str(float)`` for ordinary values (exponent forms differ)."""
    return col_(c).cast("double").cast("string")


def entity_embed_text(title: str | Column, description: str | Column) -> Column:
    """``"{title}: {description}"`` with missing parts as ""."""
    return F.concat(F.coalesce(col_(title), F.lit("")), F.lit(": "),
                    F.coalesce(col_(description), F.lit("")))


def blank_to_space(c: str | Column) -> Column:
    """whitespace-only text is sent as a single space."""
    return F.when(is_blank(c), F.lit(" ")).otherwise(col_(c))


def error_prefix(c: str | Column, n: int = 200) -> Column:
    """first ``n`` characters of an unparsable text."""
    return F.substring(col_(c), 1, n)

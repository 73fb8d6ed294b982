"""The project's token count and the portable patterns behind it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A run of letters, digits or underscores, or one other character that isn't a space (Java syntax).
TOKEN_JAVA = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]"
#: The same for DuckDB (RE2).
TOKEN_RE2 = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x1c-\x1f\x85]"
#: The same for Python.
TOKEN_PY = re.compile(r"\w+|[^\w\s]")


def tokens_of(n: Column) -> Column:
    """``floor(1.2 n + 0.5)`` in whole numbers, so that no rounding differs between engines."""
    return F.floor((n * 12 + 5) / 10).cast("int")


def token_count(text: Column | str) -> Column:
    """Token count of a text column; 0 for a null or empty text."""
    col = F.col(text) if isinstance(text, str) else text
    return tokens_of(F.coalesce(F.regexp_count(col, F.lit(TOKEN_JAVA)), F.lit(0)))


def py_token_count(text: str | None) -> int:
    return (12 * len(TOKEN_PY.findall(text or "")) + 5) // 10


def token_sql(column: str) -> str:
    """DuckDB expression of the same count."""
    return f"((12 * coalesce(len(regexp_extract_all({column}, '{TOKEN_RE2}')), 0) + 5) // 10)::INT"

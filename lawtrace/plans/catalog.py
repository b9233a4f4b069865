"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a (spark, sf_dir) function, with the SQL it is held against."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return add


def tidy(df, digits: int = 6):
    """All doubles of a result rounded, with one kind of zero."""
    from pyspark.sql import functions as F

    return df.select(*[(F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r(expression: str, alias: str, digits: int = 6) -> str:
    """The same in SQL text."""
    return f"round({expression}, {digits}) + 0e0 as {alias}"


def crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII characters, in DuckDB's SQL."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split({text}, ''), lambda ch: ascii(ch)::bigint)), lambda c, b: {step}), 4294967295::bigint)"

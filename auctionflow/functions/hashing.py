"""Portable integer hash used by the generators.

h(x) = ((x >> 16) ^ x) * 73244475 mod 2^32, applied twice.  Inputs are
reduced mod 2^32 first, so no step overflows a signed 64-bit long and Spark
and DuckDB return the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MASK32 = (1 << 32) - 1
_MULT = 73244475


def _h(c: Column) -> Column:
    return F.pmod((F.shiftright(c, 16).bitwiseXOR(c)) * F.lit(_MULT), F.lit(1 << 32))


def portable_hash(c: Column, salt: int = 0) -> Column:
    """Non-negative hash < 2^32 of a BIGINT column, with a per-use salt."""
    x = F.pmod(c + F.lit(salt * 1_000_003), F.lit(1 << 32))
    return _h(_h(x))


def portable_hash_sql(expr: str, salt: int = 0) -> str:
    """The same hash as DuckDB SQL text (used by oracle queries)."""
    x = f"(({expr}) + {salt * 1_000_003}) % 4294967296"
    x = f"((({x}) + 4294967296) % 4294967296)"
    h1 = f"((xor(({x}) >> 16, ({x})) * {_MULT}) % 4294967296)"
    return f"((xor(({h1}) >> 16, ({h1})) * {_MULT}) % 4294967296)"


def py_hash(x: int, salt: int = 0) -> int:
    """Reference implementation in Python (tests)."""
    x = (x + salt * 1_000_003) % (1 << 32)
    for _ in range(2):
        x = (((x >> 16) ^ x) * _MULT) % (1 << 32)
    return x

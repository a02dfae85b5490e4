"""Fixed-width two-column ordering keys.

``max_by(x, struct(a, b))`` keeps a struct in the aggregation buffer, which
Spark cannot update in place, so the whole aggregate falls back to a
sort-based plan (a full sort of the input before the partial aggregate).
Packing two BIGINTs into one DECIMAL(38,0) keeps the lexicographic order and
lets Spark use hash aggregation:

    key = (a + 2^61) * 2^64 + (b + 2^63)        (|a| < 2^61, any b)

with ``2^61 - a`` / ``2^63 - 1 - b`` for descending components.  Epoch
milliseconds are far below 2^61.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_D = "decimal(38,0)"


def _dec(x: int) -> Column:
    return F.expr(f"CAST({x} AS DECIMAL(38,0))")


def order_key(a: Column | str, b: Column | str, a_desc: bool = False, b_desc: bool = False) -> Column:
    """DECIMAL(38,0) ordered like (a, b) (each ascending unless ``*_desc``)."""
    a = (F.col(a) if isinstance(a, str) else a).cast(_D)
    b = (F.col(b) if isinstance(b, str) else b).cast(_D)
    hi = (_dec(2**61) - a) if a_desc else (a + _dec(2**61))
    lo = (_dec(2**63 - 1) - b) if b_desc else (b + _dec(2**63))
    return (hi * _dec(2**64) + lo).cast(_D)

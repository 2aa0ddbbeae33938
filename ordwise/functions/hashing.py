"""Deterministic per-row draws from an integer key.

A draw depends only on (key, salt), never on partitioning or task order, so a
generated or adapted row is the same under 1 or 1000 partitions and on any
retry. The arithmetic stays inside 64-bit integers (key < 2**32 keeps
``key * A`` below 2**63) and uses only operators that Spark SQL and DuckDB
share, so the same text gives the same value in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed hash parameters.
MODULUS = 2147483647  # 2**31 - 1
MULTIPLIER = 48271
SALT_STEP = 104729


def _x_sql(key: str, salt: int) -> str:
    return f"((({key}) * {MULTIPLIER} + {salt * SALT_STEP + 1}) % {MODULUS})"


def _u_sql(x: str, m: int, dialect: str) -> str:
    y = f"((({x} * {x}) % {MODULUS}) * {MULTIPLIER} % {MODULUS})"
    shifted = f"shiftright({y}, 10)" if dialect == "spark" else f"({y} >> 10)"
    return f"({shifted} % {m})"


def draw_sql(key: str, salt: int, m: int, dialect: str = "spark") -> str:
    """Integer in ``[0, m)`` for ``key`` under ``salt`` (key >= 0), as SQL text.

    ``dialect`` only changes the spelling of the right shift (Spark's parser
    does not take ``>>`` inside every expression context).
    """
    return _u_sql(_x_sql(key, salt), m, dialect)


def draw_stages(key: str, draws: dict[str, tuple[int, int]], keep: list[str],
                dialect: str = "spark") -> tuple[list[str], list[str]]:
    """Two projections that add one column ``_u_<name>`` per draw.

    The first computes each draw's linear step once, the second finishes it
    from that column, so the squared term reads a column instead of
    repeating its whole expression. This keeps the generated code of wide
    generators small. ``keep`` columns pass through both projections.
    """
    first = keep + [f"{_x_sql(key, salt)} AS _x_{n}" for n, (salt, _) in draws.items()]
    second = keep + [f"{_u_sql('_x_' + n, m, dialect)} AS _u_{n}" for n, (_, m) in draws.items()]
    return first, second


def draw(key: str, salt: int, m: int) -> Column:
    """Column form of :func:`draw_sql`; ``key`` is a column name or SQL expression."""
    return F.expr(draw_sql(key, salt, m))

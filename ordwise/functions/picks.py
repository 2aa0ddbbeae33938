"""SQL expression text for draw-based columns, in Spark or DuckDB dialect.

Generated columns (fixture adapter, synthetic orders) are written as SQL
expression text and handed to Spark in one ``selectExpr`` call: the JVM parses
and analyses the whole projection at once, instead of Python assembling it
node by node over py4j. The same text, rendered for DuckDB, is the oracle's
copy of the fixture, so both engines build identical inputs.
"""

from __future__ import annotations

from dataclasses import dataclass


def cumulative(weights: list[tuple]) -> list[tuple]:
    """[(value, weight)] with weights summing to 100 (or 1.0) -> [(value, cumulative bound)]."""
    out, acc = [], 0
    for v, w in weights:
        acc += round(w * 100) if isinstance(w, float) else w
        out.append((v, acc))
    return out


def _q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


@dataclass(frozen=True)
class Dialect:
    name: str   # "spark" or "duckdb"

    def pick_from(self, values: list, u: str) -> str:
        """values[u] (0-based); None entries give null."""
        items = ", ".join(_q(v) for v in values)
        if self.name == "spark":
            return f"element_at(array({items}), CAST(({u}) + 1 AS INT))"
        return f"([{items}]::VARCHAR[])[({u}) + 1]"

    @staticmethod
    def pick_by_bounds(u: str, bounds: list[tuple], fmt=_q) -> str:
        """First value whose cumulative bound exceeds ``u``."""
        arms = " ".join(f"WHEN {u} < {b} THEN {fmt(v)}" for v, b in bounds[:-1])
        return f"CASE {arms} ELSE {fmt(bounds[-1][0])} END"

    def idiv(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.name == "spark" else f"(({a}) // ({b}))"

    def shift_ts(self, ts: str, sign: str, days: str, hours: str, minutes: str) -> str:
        """ts +/- (days, hours, minutes), all integer expressions."""
        if self.name == "spark":
            return f"{ts} {sign} make_dt_interval(CAST({days} AS INT), CAST({hours} AS INT), CAST({minutes} AS INT), 0)"
        return (f"{ts} {sign} (to_days(CAST({days} AS INTEGER)) + to_hours(CAST({hours} AS INTEGER)) "
                f"+ to_minutes(CAST({minutes} AS INTEGER)))")

    def date_plus(self, ts: str, days: str) -> str:
        """Calendar date of ``ts`` plus ``days``."""
        if self.name == "spark":
            return f"date_add(to_date({ts}), CAST({days} AS INT))"
        return f"(CAST({ts} AS DATE) + CAST({days} AS INTEGER))"

    def ts_literal(self, ts: str) -> str:
        return f"TIMESTAMP_NTZ '{ts}'" if self.name == "spark" else f"TIMESTAMP '{ts}'"


def render_select(exprs: list[str], src: str) -> str:
    """A DuckDB SELECT over ``src`` from Spark-style expression text."""
    body = ",\n        ".join(e.replace(" AS STRING)", " AS VARCHAR)").replace(" AS INT)", " AS INTEGER)")
                               for e in exprs)
    return f"SELECT\n        {body}\n    FROM {src}"


def nest_selects(stages: list[list[str]], src: str) -> str:
    """Chain projections as nested DuckDB SELECTs, first stage innermost."""
    for i, exprs in enumerate(stages):
        src = f"({render_select(exprs, src)}) AS s{i}"
    return src[1:src.rindex(")")]


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")

"""Helpers to assemble DuckDB oracle SQL from named CTE blocks."""

from __future__ import annotations

from legworks.plans.common import DIGITS
from legworks.plans.oracle_legs import LEGS_CTE


def sql(*ctes: str, final: str, round_cols: tuple[str, ...] | list[str] = (),
        recursive: bool = False) -> str:
    """``WITH legs…, <ctes> SELECT * REPLACE (round(c, 6) AS c…) FROM (<final>)``."""
    blocks = [LEGS_CTE.strip()] + [c.strip().rstrip(",") for c in ctes if c.strip()]
    if round_cols:
        rep = ", ".join(f'round("{c}", {DIGITS}) AS "{c}"' for c in round_cols)
        body = f"SELECT * REPLACE ({rep}) FROM ({final}) AS q"
    else:
        body = final
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(blocks) + "\n" + body


def in_list(values) -> str:
    return ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values)

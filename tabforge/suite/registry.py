from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def expand_sround(sql: str) -> str:
    """``sround(x, n)`` in oracle SQL -> DuckDB rounding half-up on the shortest decimal text of a double.

    Spark's ``round`` on DOUBLE rounds the shortest decimal representation
    half-up; DuckDB's ``round`` on DOUBLE does not, so oracles spell it out.
    """
    out, i = [], 0
    while True:
        j = sql.find("sround(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth, comma = j + len("sround("), 1, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        x, n = sql[j + len("sround("):comma], sql[comma + 1:k - 1]
        out.append(f"CAST(round(CAST(CAST({expand_sround(x)} AS VARCHAR) AS DECIMAL(38, 17)), {n.strip()}) AS DOUBLE)")
        i = k


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None = rows-only check)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = expand_sround(sql)
        return fn
    return deco

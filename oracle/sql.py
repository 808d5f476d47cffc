"""Pieces of DuckDB SQL shared by the oracle statements.

Percentages and means are computed in whole numbers, so that their rounding is exact: a rounded value
is an integer count of its last digit and only divided at the very end.
"""

from __future__ import annotations

import re


def pct_units(part: str, whole: str, scale: int = 2) -> str:
    """Half-up rounded part/whole*100 in units of 10^-scale, as HUGEINT; null when whole is 0."""
    p, w = f"CAST(({part})*10000 AS HUGEINT)", f"CAST(({whole})*10000 AS HUGEINT)"
    factor = 100 * 10**scale
    return (
        f"CASE WHEN ({whole}) = 0 THEN NULL WHEN ({part}) < 0 "
        f"THEN -((2*-({p})*{factor} + {w}) // (2*{w})) ELSE (2*{p}*{factor} + {w}) // (2*{w}) END"
    )


def pct(part: str, whole: str, scale: int = 2) -> str:
    return f"CAST({pct_units(part, whole, scale)} AS DOUBLE)/{10**scale}"


def mean_units(value: str, scale: int) -> str:
    """Half-up rounded mean of an exact column (at most ``scale`` decimals), in units of 10^-scale."""
    s, n = f"CAST(sum({value})*{10**scale} AS HUGEINT)", f"count({value})"
    return (
        f"CASE WHEN {n} = 0 THEN NULL WHEN sum({value}) < 0 THEN -((2*-{s} + {n}) // (2*{n})) "
        f"ELSE (2*{s} + {n}) // (2*{n}) END"
    )


def mean(value: str, scale: int) -> str:
    return f"CAST({mean_units(value, scale)} AS DOUBLE)/{10**scale}"


def pad(prefix: str, number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def values(rows: list[tuple], columns: list[tuple[str, str]]) -> str:
    """A literal table."""

    def lit(v: object, kind: str) -> str:
        return f"CAST(NULL AS {kind})" if v is None else f"CAST('{v}' AS {kind})"

    body = ", ".join("(" + ", ".join(lit(v, k) for v, (_, k) in zip(r, columns)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(n for n, _ in columns)})"


def with_parts(query: str, parts: dict[str, str]) -> str:
    """Prefix a query with the common tables it needs, in order of dependence."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bc_\w+", text):
            if name in parts and name not in ordered:
                visit(parts[name])
                ordered.append(name)

    visit(query)
    if not ordered:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in ordered) + "\n" + query

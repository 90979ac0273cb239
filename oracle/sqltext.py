"""Helpers that write SQL text for DuckDB."""

from __future__ import annotations

import re


def ratio(top: str, bottom: str, places: int, top_scale: int = 2, bottom_scale: int = 0) -> str:
    """Exact ``top / bottom`` rounded half up to ``places``, NULL on zero, in whole numbers.

    The scales say how many decimal places each side carries.
    """
    shift = places + bottom_scale - top_scale
    a = f"cast(({top}) * {10**top_scale} as hugeint)"
    b = f"cast(({bottom}) * {10**bottom_scale} as hugeint)"
    if shift >= 0:
        a = f"({a} * {10**shift})"
    else:
        b = f"({b} * {10**-shift})"
    whole = f"(sign({a}) * ((2 * abs({a}) + {b}) // nullif(2 * {b}, 0)))"
    unit = "1" if places == 0 else "0." + "0" * (places - 1) + "1"
    return f"cast(cast({whole} as decimal(20,0)) * {unit} as decimal(20,{places}))"


def average(column: str, places: int, scale: int = 2) -> str:
    return ratio(f"sum({column})", f"count({column})", places, scale)


def pct(top: str, bottom: str, places: int = 2, top_scale: int = 0, bottom_scale: int = 0) -> str:
    return ratio(f"100 * ({top})", bottom, places, top_scale, bottom_scale)


def tidy(column: str, fold: str = "lower") -> str:
    return f"nullif({fold}(trim({column})), '')"


def steps(value: str, bounds, last: str) -> str:
    arms = " ".join(f"when {value} <= {bound} then {label}" for bound, label in bounds)
    return f"case {arms} else {last} end"


def assemble(ctes: dict[str, str], body: str) -> str:
    """Put the CTEs that ``body`` needs, directly or not, in front of it."""
    names = sorted(ctes, key=len, reverse=True)
    pattern = re.compile(r"\b(" + "|".join(names) + r")\b")
    needed: dict[str, None] = {}

    def visit(text: str, owner: str | None) -> None:
        for name in dict.fromkeys(pattern.findall(text)):
            if name != owner and name not in needed:
                visit(ctes[name], name)
                needed[name] = None

    visit(body, None)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({ctes[name]})" for name in needed) + "\n" + body

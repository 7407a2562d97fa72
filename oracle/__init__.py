"""Independent SQL for the registered queries (any engine with CTEs and window functions).

``VIEWS`` holds named SELECTs; a query's text starts with the views it reads, in dependency order.
"""

from __future__ import annotations

import re

from oracle import daily, gold, incremental, semantic, silver, staffing

# Stands for WITH in a query that adds views of its own.
OWN_VIEWS = "WITH_VIEWS"

VIEWS: dict[str, str] = {**staffing.VIEWS, **gold.VIEWS, **silver.VIEWS, **incremental.VIEWS}


def _needs(sql: str) -> list[str]:
    words = re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", sql)
    return [w for w in dict.fromkeys(words) if w in VIEWS]


def render(sql: str) -> str:
    """The SELECT preceded by the views it depends on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _needs(VIEWS[name]):
            if dep != name and dep not in ordered:
                visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in _needs(sql):
        visit(name)
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    if OWN_VIEWS in sql:
        return sql.replace(OWN_VIEWS, f"WITH {views}," if views else "WITH").strip()
    return f"WITH {views}\n{sql}" if views else sql


def oracle_sql() -> dict[str, str]:
    texts = {**gold.QUERIES, **silver.QUERIES, **semantic.QUERIES, **incremental.QUERIES, **daily.QUERIES}
    return {name: render(sql) for name, sql in texts.items()}

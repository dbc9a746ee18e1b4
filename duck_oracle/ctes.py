"""Named SQL building blocks with dependencies, composed into one WITH clause.

``sql(body, *names)`` returns ``WITH <names and everything they need, in
dependency order> <body>``.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body.strip(), deps)


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *names: str) -> str:
    ordered = _order(names)
    if not ordered:
        return body.strip()
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in ordered]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()

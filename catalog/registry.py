"""Query registry and the SQL fragments the oracles share."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` may use every fragment below as a table."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_fragments(sql)
        return fn

    return add


FRAGMENTS: dict = {}


def fragment(name: str, body: str) -> None:
    FRAGMENTS[name] = body.strip()


def with_fragments(sql: str) -> str:
    """``sql`` preceded by the fragments it needs."""
    import re

    needed, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for word in set(re.findall(r"[a-z_][a-z0-9_]*", text)):
            if word in FRAGMENTS and word not in needed:
                needed.add(word)
                todo.append(FRAGMENTS[word])
    if not needed:
        return sql.strip()
    ctes = [f"{n} AS (\n{FRAGMENTS[n]}\n)" for n in FRAGMENTS if n in needed]
    body = sql.strip()
    head = "WITH " + ",\n".join(ctes)
    if body[:5].upper() == "WITH ":
        return head + ",\n" + body[5:]
    return head + "\n" + body

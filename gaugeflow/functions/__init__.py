"""Expression builders: SQL text in, SQL text out, made of built-in functions only.

Expressions are composed as text and handed to ``selectExpr`` in one piece; building the same trees
from Column objects costs one driver round trip per node, which dominates short queries.
"""

from __future__ import annotations


def quote(text: str) -> str:
    """A Python string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A column name as an identifier."""
    return "`" + column.replace("`", "``") + "`"


def names(columns) -> str:
    return ", ".join(name(c) for c in columns)


def one_of(expr: str, values) -> str:
    """Membership that is never null: a missing value is in no list."""
    return f"coalesce({expr} IN ({', '.join(quote(v) for v in values)}), false)"

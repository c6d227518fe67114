"""Names and values inside SQL text.

Operators that repeat an expression for every column build it as SQL text: one
call to the JVM for the whole list instead of several per column.
"""

from __future__ import annotations


def quoted(name: str) -> str:
    """A column name."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """A string value."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rows_of(structs: list[str]) -> str:
    """A generator of one row per struct."""
    return f"inline(array({', '.join(structs)}))"

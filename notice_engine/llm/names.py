"""Names of helper columns beside a user's own."""

from __future__ import annotations


def apart(columns: list[str], *wanted: str) -> list[str]:
    """Each wanted name, with as many underscores in front as it takes to differ from all columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out

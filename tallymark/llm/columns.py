"""Names of helper columns beside columns of any name."""

from __future__ import annotations

from collections.abc import Iterable


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column has it; case doesn't count."""
    seen = {c.lower() for c in taken}
    found = []
    for name in names:
        while name.lower() in seen:
            name = f"_{name}"
        seen.add(name.lower())
        found.append(name)
    return found

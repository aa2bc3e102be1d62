"""Pure functions over column names.

Column names are schema metadata: they live on the driver by nature and are
bounded by the width of a table, never by its row count.  Everything here
plans a single projection that the operators then apply in one ``select``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence


class NameCollisionError(ValueError):
    """Two columns would end up with the same (case-insensitive) name."""


def normalize_name(name: str) -> str:
    """Header rule: strip, lower, space to '_', drop '(' and ')', then '/', '-'
    and '.' to '_', applied in that order.  Other characters are kept and
    runs of '_' are not collapsed."""
    out = name.strip().lower().replace(" ", "_")
    out = out.replace("(", "").replace(")", "")
    for ch in ("/", "-", "."):
        out = out.replace(ch, "_")
    return out


def _resolve_collisions(names: Sequence[str], on_collision: str, what: str) -> list[str]:
    """Spark resolves names case-insensitively, so compare lower-cased."""
    if on_collision not in ("error", "suffix"):
        raise ValueError(f"on_collision must be 'error' or 'suffix', got {on_collision!r}")
    seen: dict[str, int] = {}
    out: list[str] = []
    taken = {n.lower() for n in names}
    for name in names:
        key = name.lower()
        if key not in seen:
            seen[key] = 1
            out.append(name)
            continue
        if on_collision == "error":
            dupes = [n for n in names if n.lower() == key]
            raise NameCollisionError(f"{what}: columns {dupes} collide as {name!r}")
        n = seen[key] + 1
        while f"{key}_{n}" in taken:
            n += 1
        seen[key] = n
        taken.add(f"{key}_{n}")
        out.append(f"{name}_{n}")
    return out


def plan_normalized_names(columns: Sequence[str], on_collision: str = "error") -> list[str]:
    """Normalized names for ``columns``; collisions raise or get ``_2``, ``_3``."""
    return _resolve_collisions([normalize_name(c) for c in columns], on_collision,
                               "normalize_names")


def plan_renames(columns: Sequence[str], mapping: Mapping[str, str] | Iterable[tuple[str, str]],
                 on_collision: str = "error") -> list[str]:
    """New names after a rename map matched case-insensitively after strip.

    Sources that are absent are ignored.  The map is applied to the original
    names at once (no chained renames), then checked for collisions.
    """
    wanted = {old.strip().lower(): new for old, new in dict(mapping).items()}
    names = [wanted.get(c.strip().lower(), c) for c in columns]
    return _resolve_collisions(names, on_collision, "rename_map")


def keyword_columns(columns: Sequence[str], keywords: Iterable[str]) -> list[str]:
    """Columns whose name contains any keyword (case-sensitive substring),
    in source order."""
    keys = list(keywords)
    return [c for c in columns if any(k in c for k in keys)]

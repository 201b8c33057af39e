"""Names of tables, and the few name rules shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A text literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class TableRef:
    """``catalog.namespace.name``; the catalog may be left to the session."""

    name: str
    namespace: str = "default"
    catalog: str | None = None

    @classmethod
    def parse(cls, text: str | "TableRef") -> "TableRef":
        if isinstance(text, TableRef):
            return text
        parts = text.split(".")
        if not 1 <= len(parts) <= 3 or not all(parts):
            raise ValueError(f"expected [catalog.][namespace.]table, got {text!r}")
        return cls(*reversed(parts))

    @property
    def sql(self) -> str:
        parts = [self.catalog, self.namespace, self.name]
        return ".".join(quote(p) for p in parts if p)

    @property
    def namespace_sql(self) -> str:
        return ".".join(quote(p) for p in [self.catalog, self.namespace] if p)

    def sibling(self, name: str) -> "TableRef":
        return TableRef(name, self.namespace, self.catalog)


def as_list(value: str | Iterable[str] | None) -> list[str]:
    """A single name, several or none, as a list without repeats."""
    if value is None or value == "":
        return []
    names = [value] if isinstance(value, str) else list(value)
    seen: dict[str, str] = {}
    for name in names:
        seen.setdefault(name.lower(), name)
    return list(seen.values())


def resolve_columns(names: Sequence[str], available: Sequence[str], what: str) -> list[str]:
    """Map names to the spelling used by ``available``; an unknown one is an error that names it."""
    spelling = {c.lower(): c for c in available}
    missing = [n for n in names if n.lower() not in spelling]
    if missing:
        raise ValueError(f"{what}: no such column {', '.join(missing)}; have {', '.join(available)}")
    return [spelling[n.lower()] for n in names]

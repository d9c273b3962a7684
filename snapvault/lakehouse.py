"""Where things are."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lakehouse:
    """A root folder with ``Tables/`` and ``Files/`` below it; any Hadoop URI."""

    root: str

    @property
    def tables(self) -> str:
        return f"{self.root.rstrip('/')}/Tables"

    @property
    def files(self) -> str:
        return f"{self.root.rstrip('/')}/Files"

"""What a writer gets to know of the rows it is given."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Batch:
    """Which rows a writer gets: the micro-batch's id (None outside of streams) and the part of it."""

    id: int | None = None
    part: str = "all"

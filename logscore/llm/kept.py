"""A bounded table of results that a process has worked out."""

from __future__ import annotations


class Kept(dict):
    """Forgets what was not asked for lately: entries are in a young and an old generation.

    When the young one is full it becomes the old one; what is asked for again comes back.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.old: dict = {}

    def turn(self) -> None:
        """Start a new generation if this one is full. Entries in use must be asked for again."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()

    def missing(self, keys: set) -> set:
        """The keys that have no entry; the others are in the young generation from now on."""
        missing = keys.difference(self)
        if self.old:
            back = missing.intersection(self.old)
            self.update((key, self.old[key]) for key in back)
            missing -= back
        return missing

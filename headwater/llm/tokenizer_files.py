"""Where tokenizer files lie, and bounded worker caches."""

from __future__ import annotations

import os


def path(name: str) -> str:
    """The place of a file: as it is if it exists, else among the installed public tokenizers."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Cache(dict):
    """Keeps what was used among the last ``limit`` to twice as many new keys."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self.add(key, found)
        return found

    def add(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value

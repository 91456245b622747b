"""Tokenizer files and bounded per-task caches."""

from __future__ import annotations

import os
from collections.abc import Callable

#: Entries of each of a cache's two generations.
CACHE_ENTRIES = 400_000


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in ``folder``, or in the installed ``public_tokenizers``."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class Cache(dict):
    """``make(key)`` remembered for the keys seen of late: when the young generation is full it
    becomes the old one, from which keys that occur again move back. Bounded at two generations."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES, always: dict | None = None):
        super().__init__(always or {})
        self.make, self.entries, self.always, self.old = make, entries + len(always or {}), always or {}, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
            self.update(self.always)
        self[key] = value
        return value

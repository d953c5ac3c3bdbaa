"""A worker's memory of results, bounded in bytes."""

from __future__ import annotations

#: What an entry takes beside its bytes, about.
ENTRY = 180


class Recent:
    """Results of keys: those of late, and those of the time before, which go when space is needed."""

    def __init__(self, limit: int, longest: int = 64):
        self.limit, self.longest = limit, longest
        self.now: dict = {}
        self.past: dict = {}
        self.held = 0

    def fill(self, keys: list, compute) -> list[bytes]:
        """A value per key; ``compute(list of distinct keys)`` gives those that are not remembered."""
        values = list(map(self.now.get, keys))
        if None in values:
            new = {k: None for k, v in zip(keys, values) if v is None}
            found = {k: self.past[k] for k in new if k in self.past}
            rest = [k for k in new if k not in found]
            if rest:
                found.update(zip(rest, compute(rest)))
            if self.held > self.limit // 2:
                self.past, self.now, self.held = self.now, {}, 0
            for k, v in found.items():
                if len(k) <= self.longest:
                    self.now[k] = v
                    self.held += len(k) + len(v) + ENTRY
            values = [found[k] if v is None else v for k, v in zip(keys, values)]
        return values

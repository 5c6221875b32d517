"""A bounded cache in two generations: frequent keys stay when the older generation is dropped."""

from __future__ import annotations


class Generations(dict):
    """``d[key]`` computes missing values with ``make(key)``; at most ``2 * most`` entries are kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value

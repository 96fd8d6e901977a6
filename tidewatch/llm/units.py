"""Space-separated units of a text, encoded once each and kept per worker."""

from __future__ import annotations

from collections.abc import Callable

# Entries kept by a worker; beyond it the store starts anew, which costs time and changes nothing.
MAX_UNITS = 1_200_000


class UnitStore(dict):
    """unit -> encoded bytes. ``encode`` takes the list of units that are missing."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = MAX_UNITS):
        super().__init__()
        self.encode, self.limit = encode, limit

    def encoded(self, units: list[str]) -> bytes:
        """The concatenation of the units' codes."""
        try:
            return b"".join(map(self.__getitem__, units))
        except KeyError:
            self.learn(units)
            return b"".join(map(self.__getitem__, units))

    def learn(self, units) -> None:
        new = list({u for u in units if u not in self})
        if not new:
            return
        if len(self) > self.limit:
            self.clear()
            new = list(set(units))
        self.update(zip(new, self.encode(new)))

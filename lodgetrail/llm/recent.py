"""What a worker has computed of late, kept within a bound."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class Recent:
    """Values by key for up to twice ``kept`` keys: when a generation is full, the one before it goes.

    A key that is asked for again moves on to the newer generation, so common
    ones stay.
    """

    def __init__(self, kept: int, make: Callable[[list[str]], Iterable]):
        self.kept, self.make = kept, make
        self.young: dict = {}
        self.old: dict = {}

    def look(self, keys: list[str]) -> list:
        """The keys' values; ``make`` is called once for the list of those not known."""
        found = list(map(self.young.get, keys))
        if None not in found:
            return found
        new = {k for k, value in zip(keys, found) if value is None}
        if len(self.young) + len(new) > self.kept and self.young:
            self.old, self.young = self.young, {}
            new = set(keys)
        held = self.old
        rest = [k for k in new if k not in held]
        self.young.update((k, held[k]) for k in new if k in held)
        if rest:
            self.young.update(zip(rest, self.make(rest)))
        return list(map(self.young.__getitem__, keys))


class Known(dict):
    """Values by text, made when first asked for and kept within a bound of bytes.

    ``make(text)`` is called for what is not known, and may ask for other texts
    itself. Texts over ``LONGEST`` letters are made each time. When a generation
    holds ``kept`` bytes, the one before it goes; what is asked for again moves
    on to the newer one, so common texts stay.
    """

    LONGEST = 64
    #: What an entry takes beside its letters and its value.
    ENTRY = 160

    def __init__(self, kept: int, make: Callable[[str], bytes]):
        self.kept, self.make = kept, make
        self.old: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, text: str) -> bytes:
        value = self.old.get(text)
        if value is None:
            value = self.make(text)
            if len(text) > self.LONGEST:
                return value
        self.held += self.ENTRY + 2 * len(text) + len(value)
        if self.held > self.kept:
            self.old, self.held = dict(self), 0
            self.clear()
        self[text] = value
        return value

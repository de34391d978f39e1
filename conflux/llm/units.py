"""Tokenizing by distinct units.

A tokenizer which splits its text before merging treats some places as
boundaries whatever stands around them. Texts cut at such places give the
same ids in pieces as whole. Most pieces recur, so each worker keeps the ids
of those it has met and runs the tokenizer on new ones only, a few thousand at
a time. What is kept is bounded by bytes and never changes a result: it comes
in two generations, of which the older one is dropped when the newer one is
full; units met again move to the newer one, so frequent ones stay.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Sequence
from itertools import chain, pairwise
from sys import getsizeof

import numpy as np

#: A worker is one thread of its executor; the tokenizers' own threads only cost memory.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

#: Bytes of text a task tokenizes at once.
TEXT_BYTES = 2 << 20
#: Units given to the tokenizer in one call.
TOGETHER = 4096
#: What an entry takes up beside its key and its ids.
_ENTRY = 143


class UnitIds:
    """Ids of units, of which up to ``most_bytes`` are remembered."""

    def __init__(self, encode_many: Callable[[list], Sequence[Sequence[int]]], most_bytes: int = 256 << 20,
                 dtype=np.uint32):
        self.encode_many, self.most, self.dtype = encode_many, most_bytes, np.dtype(dtype)
        self.new: dict = {}
        self.old: dict = {}
        self.new_bytes = self.old_bytes = 0
        self.flat = np.zeros(0, self.dtype)
        self.start = np.zeros(1, np.int64)

    def held_bytes(self) -> int:
        """What the remembered units take up."""
        return self.new_bytes + self.old_bytes

    def _keep(self, unit, ids: bytes) -> None:
        size = getsizeof(unit) + len(ids) + _ENTRY
        if self.new_bytes + size > self.most // 2:
            self.old, self.old_bytes = self.new, self.new_bytes
            self.new, self.new_bytes = {}, 0
        self.new[unit] = ids
        self.new_bytes += size

    def _keep_all(self, units: list, ids: list[bytes]) -> None:
        """The same for several units at once."""
        size = sum(map(getsizeof, units)) + sum(map(len, ids)) + _ENTRY * len(units)
        if size > self.most // 2:
            for one in zip(units, ids, strict=True):
                self._keep(*one)
            return
        if self.new_bytes + size > self.most // 2:
            self.old, self.old_bytes = self.new, self.new_bytes
            self.new, self.new_bytes = {}, 0
        self.new.update(zip(units, ids, strict=True))
        self.new_bytes += size

    def _encoded(self, units: list) -> list[bytes]:
        ids = self.encode_many(units)
        raw = array(self.dtype.char, chain.from_iterable(ids)).tobytes()
        ends = (np.cumsum([0, *map(len, ids)]) * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in pairwise(ends)]

    def places(self, units: list) -> np.ndarray:
        """The number of each unit among the distinct ones of this call, whose
        ids :meth:`lengths` and :meth:`gather` give until the next call."""
        distinct = list(dict.fromkeys(units))
        number = dict(zip(distinct, range(len(distinct)), strict=True))
        self.find(distinct)
        return np.fromiter(map(number.__getitem__, units), np.int64, len(units))

    def find(self, distinct: list) -> None:
        """The same for units that are distinct already, by their place in the
        list."""
        found: list = list(map(self.new.get, distinct))
        older, unknown = self.old, []
        missing = [i for i, ids in enumerate(found) if ids is None]
        for k in range(0, len(missing), TOGETHER):
            again = []
            for i in missing[k:k + TOGETHER]:
                if (ids := older.get(distinct[i])) is None:
                    unknown.append(i)
                else:
                    found[i] = ids
                    again.append(i)
            self._keep_all([distinct[i] for i in again], [found[i] for i in again])
        for k in range(0, len(unknown), TOGETHER):
            some = unknown[k:k + TOGETHER]
            units = [distinct[i] for i in some]
            ids = self._encoded(units)
            for i, x in zip(some, ids, strict=True):
                found[i] = x
            self._keep_all(units, ids)
        self.flat = np.frombuffer(b"".join(found), self.dtype)
        self.start = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        self.start //= self.dtype.itemsize

    def lengths(self, places: np.ndarray) -> np.ndarray:
        return self.start[places + 1] - self.start[places]

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units one after another, and each unit's number."""
        n = self.lengths(places)
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.start[places] - (ends - n), n)
        return self.flat[at], n

"""Static range asymmetric numeral system over integer symbols, in numpy.

One frequency table of ``2**PRECISION`` slots serves all blocks. A block is
``LANES`` interleaved coders of its own: step t codes the ids
[t * LANES, (t + 1) * LANES), lane by lane; the last step is filled up with
the most frequent symbol. States are 64-bit in [2**31, 2**63) and move 32-bit
words. The encoder runs backwards; every ``EVERY`` steps it keeps the lanes'
states and the number of words before them, at which decoders can start, so
the pieces of a block are decoded side by side.
"""

from __future__ import annotations

import zlib

import numpy as np

PRECISION = 20
LANES = 256
EVERY = 128
BLOCK = 1024 * LANES
_LOW = np.uint64(1 << 31)
_W, _P = np.uint64(32), np.uint64(PRECISION)


class Table:
    """Slots of each symbol; one that occurs has at least one."""

    def __init__(self, freq: np.ndarray):
        if int(freq.sum()) != 1 << PRECISION:
            raise ValueError("the frequencies don't fill the table")
        self.freq = freq.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.common = int(np.argmax(freq))

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        total, size = int(counts.sum()), 1 << PRECISION
        some = np.flatnonzero(counts)
        if len(some) > size // 2:
            raise ValueError(f"{len(some)} symbols are too many for {size} slots")
        freq = np.zeros(max(1, len(counts)), np.int64)
        if not total:
            freq[0] = size
            return cls(freq)
        freq[some] = np.maximum(1, (counts[some].astype(np.float64) * (size / total)).astype(np.int64))
        order = some[np.argsort(-freq[some], kind="stable")]
        while (rest := size - int(freq.sum())) != 0:
            if rest > 0:
                freq[order[0]] += rest
            else:      # take from the largest, leaving at least half of each
                for s in order:
                    take = min(-rest, int(freq[s]) // 2)
                    freq[s] -= take
                    rest += take
                    if not rest or not take:
                        break
        return cls(freq)


def encode(table: Table, blocks: list[np.ndarray]) -> list[dict]:
    """Each block's ``words``, ``states``, ``offsets`` (bytes) and ``crc32``."""
    out: list = [None] * len(blocks)
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        groups.setdefault(-(-len(b) // LANES), []).append(i)
    for steps, members in groups.items():
        wide = np.full((len(members), steps * LANES), table.common, np.uint32)
        for j, i in enumerate(members):
            wide[j, :len(blocks[i])] = blocks[i]
        ids = np.ascontiguousarray(wide.reshape(len(members), steps, LANES).transpose(1, 0, 2)).reshape(steps, -1)
        x = np.full(ids.shape[1], _LOW, np.uint64)
        words, moved = np.zeros(ids.shape, np.uint32), np.zeros(ids.shape, bool)
        kept = np.zeros((-(-steps // EVERY), ids.shape[1]), np.uint64)
        for t in range(steps - 1, -1, -1):
            f = table.freq[ids[t]]
            full = x >= f << np.uint64(63 - PRECISION)
            moved[t], words[t] = full, x.astype(np.uint32)
            np.right_shift(x, _W, out=x, where=full)
            q = x // f
            x = (q << _P) + (x - q * f) + table.start[ids[t]]
            if t % EVERY == 0:
                kept[t // EVERY] = x
        for j, i in enumerate(members):
            lane = slice(j * LANES, (j + 1) * LANES)
            own = moved[:, lane]
            before = np.concatenate([[0], np.cumsum(own.sum(1))])[:-1][::EVERY].astype(np.uint32)
            row = {"words": words[:, lane][own].tobytes(), "states": np.ascontiguousarray(kept[:, lane]).tobytes(),
                   "offsets": before.tobytes()}
            out[i] = row | {"crc32": checksum(row)}
    return out


def checksum(row: dict) -> int:
    return zlib.crc32(row["words"], zlib.crc32(row["states"], zlib.crc32(row["offsets"])))


def decode(table: Table, rows: list[dict]) -> list[np.ndarray]:
    """The ids of each block; a row also has ``n_ids``."""
    for row in rows:
        if checksum(row) != row["crc32"]:
            raise ValueError("a block doesn't match its checksum")
    offsets = [np.frombuffer(r["offsets"], np.uint32).astype(np.int64) for r in rows]
    words = [np.frombuffer(r["words"], np.uint32) for r in rows]
    base = np.cumsum([0, *map(len, words)])
    stream = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
    x = np.concatenate([np.frombuffer(r["states"], np.uint64) for r in rows]).reshape(-1, LANES).copy()
    at = np.concatenate([o + b for o, b in zip(offsets, base, strict=False)])
    steps = [-(-r["n_ids"] // LANES) for r in rows]
    out = np.empty((len(at), EVERY, LANES), np.uint32)
    slots = np.uint64((1 << PRECISION) - 1)
    for t in range(min(EVERY, max(steps, default=0))):
        slot = x & slots
        s = table.symbol[slot]
        out[:, t] = s
        x = table.freq[s] * (x >> _P) + slot - table.start[s]
        low = x < _LOW
        k = np.cumsum(low, axis=1)
        # a last piece shorter than the others runs on over words that aren't its own, unused
        word = stream[np.minimum(at[:, None] + k - 1, len(stream) - 1)]
        x = np.where(low, x << _W | word, x)
        at += k[:, -1]
    first = np.cumsum([0, *map(len, offsets)])
    return [out[first[i]:first[i + 1]].reshape(-1)[:r["n_ids"]] for i, r in enumerate(rows)]


def crc32_joined(a: int, b: int, b_bytes: int) -> int:
    """crc32 of a text from those of its two parts: the first one's remainder
    times x to the power of the bits behind it, plus the second one's."""
    def times(p: int, q: int) -> int:       # product modulo the polynomial; the top bit is x to the 0
        out = 0
        for k in range(31, -1, -1):
            if p >> k & 1:
                out ^= q
            q = q >> 1 ^ (0xEDB88320 if q & 1 else 0)
        return out

    power, square, bits = 1 << 31, 1 << 30, 8 * b_bytes
    while bits:
        if bits & 1:
            power = times(power, square)
        square = times(square, square)
        bits >>= 1
    return times(power, a) ^ b

"""Words and five-word shingles of a batch of texts as arrays.

Words are the runs of characters other than the six ASCII white-space
characters. A text of ``width`` words or more has one shingle for each run of
``width`` words; a shorter one has a single shingle, all its words; a text
without words has none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
_MULT = np.uint64(0x9E3779B97F4A7C15)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def ascii_lowered(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, of a ``large_string`` array without nulls. (Arrow's
    own function goes wrong on slices.)"""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    if body is None or not len(texts) or offsets[0] == offsets[-1]:
        return texts
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]]
    return pa.Array.from_buffers(texts.type, len(texts),
                                 [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_LOWER[data])])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts in order, dictionary-encoded, and each text's
    first position in them (one more entry for the end)."""
    lists = pc.ascii_split_whitespace(texts)
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    some = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return pc.dictionary_encode(flat.filter(some)), before[ends]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word and the texts' offsets in them."""
    coded, offsets = split(texts)
    if len(coded) == 0:
        return np.zeros(0, np.uint64), offsets
    known = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object),
                               categorize=False)
    return known[coded.indices.to_numpy()], offsets


def runs(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``width`` words, as :func:`shingles` has it for
    a text of just these words, and its first word's position; runs over the
    ends of texts included."""
    s = np.full(max(0, len(h) - width + 1), width, np.uint64)
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            s += h[k:k + len(s)] * power
            power = power * _MULT
        return mix(s), np.arange(len(s))


def shingles(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of each shingle occurrence, texts in order."""
    h, off = word_hashes(texts)
    n = np.diff(off)
    powers = [np.uint64(1)]
    with np.errstate(over="ignore"):
        for _ in range(width - 1):
            powers.append(powers[-1] * _MULT)
        docs, hashes = [], []
        if len(h) >= width:
            s = np.zeros(len(h) - width + 1, np.uint64)
            for k in range(width):
                s += h[k:len(h) - width + 1 + k] * powers[k]
            owner = np.repeat(np.arange(len(n)), n)
            whole = owner[:len(s)] == owner[width - 1:]
            docs.append(owner[:len(s)][whole])
            hashes.append(mix(s[whole]))
        for short in range(1, width):
            d = np.flatnonzero(n == short)
            if len(d):
                s = np.full(len(d), short, np.uint64)
                for k in range(short):
                    s += h[off[d] + k] * powers[k]
                docs.append(d)
                hashes.append(mix(s))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    if len(docs) > 1:
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    return doc, value


def counted(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles with their number of occurrences,
    ordered by text."""
    if len(doc) == 0:
        return doc, value, np.zeros(0, np.int64)
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])]))
    return d[first], v[first], np.diff(np.concatenate([first, [len(d)]]))

"""Operator 1: token counts with overlap resynchronisation.

A huge document is encoded in overlapping chunks with offsets. Two
neighbouring chunks are spliced at a *stable common boundary*: a place where a
non-space character follows an ASCII white-space character, at which both
chunks start a token and from which on both have the same tokens. The
tokenizer drops white space and splits there before it merges, so what stands
on one side of such a place never changes the tokens of the other; agreement
of both chunks confirms it. Without such a place in the overlap the overlap
is doubled, in the end up to the whole left chunk, which then grows by the
right one; so a text without any white space is encoded in one piece.

Documents up to ``chunk_chars`` are cut at all their stable boundaries (the
white space itself) and counted by distinct word; what a worker remembers of
words is bounded by bytes (:mod:`conflux.llm.units`).

Defined results: null text counts as empty: 0 bytes, 0 tokens. Every input
row gives one row, repeated ids and null ids included. Special strings inside
a text count as the library's default has them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_string_array, id_and_text, slices
from .units import TEXT_BYTES, UnitIds

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

_SPACE = " \t\n\r\x0b\x0c"
_loaded: dict = {}


class Counter:
    """Tokenizer with its remembered word counts, one for each worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        if any(c in _SPACE for t in self.tok.get_added_tokens_decoder().values() for c in t.content):
            raise ValueError("a special token holds white space: no boundary is stable")
        one, two = (self.tok.encode(x, add_special_tokens=False).ids for x in ("a \n.b", "a"))
        if one != two + self.tok.encode(".b", add_special_tokens=False).ids:
            raise ValueError("this tokenizer keeps white space: no boundary is stable")
        self.units = UnitIds(lambda words: [e.ids for e in self.tok.encode_batch_fast(
            [w.decode() for w in words], add_special_tokens=False)])

    def encode(self, text: str):
        return self.tok.encode(text, add_special_tokens=False)


def _starts(encoding) -> np.ndarray:
    return np.fromiter((o[0] for o in encoding.offsets), np.int64, len(encoding))


def _common_boundary(text, left, a, left_end, right, s, agree):
    """(index in left, index in right) at the stable common boundary that is
    nearest to the middle of the overlap [s, left_end), or None."""
    la, lb = _starts(left) + a, _starts(right) + s
    both = np.intersect1d(la[la > s], lb[(lb > s) & (lb < left_end)])
    ids_a, ids_b = left.ids, right.ids
    middle = (s + left_end) // 2
    for p in both[np.argsort(np.abs(both - middle), kind="stable")]:
        if text[p - 1] not in _SPACE or text[p] in _SPACE:
            continue
        i, j = int(np.searchsorted(la, p)), int(np.searchsorted(lb, p))
        # the last token of the left chunk may be cut off: compare those before
        n = min(agree, len(ids_a) - 1 - i, len(ids_b) - 1 - j)
        if n > 0 and ids_a[i:i + n] == ids_b[j:j + n]:
            return i, j
    return None


def splice(counter, text: str, chunk_chars: int, overlap_chars: int, agree: int = 4) -> list[int]:
    """All ids of a text, encoded in overlapping chunks."""
    n, out = len(text), []
    a, end, first = 0, min(chunk_chars, n), 0
    left = counter.encode(text[a:end])
    while end < n:
        overlap = overlap_chars
        while True:
            s = max(a, end - overlap)
            right_end = min(n, max(s + chunk_chars, end + overlap))
            if s == a:                       # no common boundary: one longer chunk
                end, left = right_end, counter.encode(text[a:right_end])
                break
            right = counter.encode(text[s:right_end])
            if found := _common_boundary(text, left, a, end, right, s, agree):
                out += left.ids[first:found[0]]
                a, end, left, first = s, right_end, right, found[1]
                break
            overlap *= 2
    return out + left.ids[first:]


def _counter(path: str) -> Counter:
    """The worker's counter. (A task's function travels with copies of what it
    names; only through a function of this module does it reach what the
    worker keeps from task to task.)"""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, chunk_chars: int = 32768, overlap_chars: int = 256) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches):
        counter = _counter(tokenizer_path)
        for b in slices(batches, most=TEXT_BYTES):
            texts = as_string_array(b.column("text")).to_pylist()
            raw = [t.encode() for t in texts]
            n_tokens = np.zeros(len(texts), np.int64)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            words = [raw[i].split() for i in short]
            flat = [w for ws in words for w in ws]
            n = counter.units.lengths(counter.units.places(flat))
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
            sums = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])]
            n_tokens[short] = np.diff(sums)
            for i, t in enumerate(texts):
                if len(t) > chunk_chars:
                    n_tokens[i] = len(splice(counter, t, chunk_chars, overlap_chars))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()),
                 pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)

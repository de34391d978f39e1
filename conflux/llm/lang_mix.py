"""Operator 7: language ID by multilingual mixture inference.

A model holds, for each language of the labelled rows, the probabilities of
hashed letter trigrams (lower case, anything but letters as space), counted
over all labelled rows. A document is a mixture of languages: expectation
maximisation finds the proportions under which its trigrams are most likely.
The languages are then ranked by proportion and taken into the document's set
one by one as long as the likelihood of the refitted mixture grows by more
than ``penalty`` x log(number of trigrams). The prediction is the set's
language with the largest share, the score that share.

The model is ``2**BITS`` numbers a language, whatever the corpus: counts are
summed within a task before anything is shuffled, and only this table is
collected.

Defined results: ``und`` and 0.0 where the text is null or has no letter, or
where there is nothing to learn from. Equal shares go to the smaller name.
Every input row gives one row.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_string_array, crc_mod, id_and_text, ready, slices

BITS = 14
SPACE = 32
UNKNOWN = "und"
#: Text a task takes apart at once: its trigrams are some forty times as large.
TEXT_BYTES = 256 << 10


@functools.cache
def _folded() -> np.ndarray:
    """Code point -> itself if it is a letter, else a space."""
    codes = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, len(codes))
    return np.where(letter, codes, SPACE).astype(np.uint32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of each trigram that has a letter, and which
    texts have a letter."""
    padded = [f" {t.lower()} " for t in texts]
    n = np.fromiter(map(len, padded), np.int64, len(padded))
    raw = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _folded()[raw]
    owner = np.repeat(np.arange(len(texts)), n)
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), bool)
    h = (code[:-2] * np.uint32(0x9E3779B1)) ^ (code[1:-1] * np.uint32(0x85EBCA77)) ^ (code[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    word = (code[1:-1] != SPACE) & (owner[:-2] == owner[2:])     # the middle one a letter
    doc, bucket = owner[:-2][word], (h[word] >> np.uint32(32 - BITS)).astype(np.int64)
    has = np.zeros(len(texts), bool)
    has[doc] = True
    return doc, bucket, has


class Mixture:
    """Trigram probabilities of the languages, and the inference."""

    def __init__(self, counts: dict[str, np.ndarray], penalty: float, smoothing: float = 0.5, rounds: int = 12):
        self.langs = sorted(counts)
        c = np.array([counts[x] for x in self.langs], np.float64).reshape(len(self.langs), 1 << BITS) + smoothing
        self.p = np.ascontiguousarray((c / c.sum(1, keepdims=True)).T)
        self.penalty, self.rounds = penalty, rounds

    def _fit(self, share, starts, owner, count, p, n):
        """EM from ``share`` (zero stays zero): proportions, log-likelihoods."""
        for _ in range(self.rounds):
            mixed = np.einsum("ij,ij->i", share[owner], p)
            share = share * np.add.reduceat((count / mixed)[:, None] * p, starts) / n[:, None]
            share /= share.sum(1, keepdims=True)
        mixed = np.einsum("ij,ij->i", share[owner], p)
        return share, np.add.reduceat(count * np.log(mixed), starts)

    def proportions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of proportions for each text, zero outside its language set;
        and which texts have a letter."""
        doc, bucket, has = trigrams(texts)
        out = np.zeros((len(texts), len(self.langs)))
        if not len(doc) or not self.langs:
            return out, has & bool(self.langs)
        # distinct trigrams of each text, some texts at a time as a dense table
        ids, cells, counts = np.flatnonzero(has), [], []
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i in ids:
            c = np.bincount(bucket[ends[i]:ends[i + 1]], minlength=1 << BITS)
            b = np.flatnonzero(c)
            cells.append(b)
            counts.append(c[b])
        size = np.fromiter(map(len, cells), np.int64, len(cells))
        starts, owner = np.cumsum(size) - size, np.repeat(np.arange(len(ids)), size)
        p, count = self.p[np.concatenate(cells)], np.concatenate(counts).astype(np.float64)
        n = np.add.reduceat(count, starts)
        k = len(self.langs)
        full, _ = self._fit(np.full((len(ids), k), 1 / k), starts, owner, count, p, n)
        rank = np.argsort(-full, axis=1, kind="stable")
        best = np.zeros((len(ids), k))
        best[np.arange(len(ids)), rank[:, 0]] = 1
        one = p[np.arange(len(p)), rank[owner, 0]]
        score = np.add.reduceat(count * np.log(one), starts)
        alive = np.arange(len(ids))
        for m in range(2, k + 1):
            # only texts whose set grew last time, and where the next language has a share at all
            alive = alive[full[alive, rank[alive, m - 1]] > 1e-3]
            if not len(alive):
                break
            some = np.zeros(len(ids), bool)
            some[alive] = True
            rows = some[owner]
            s = np.cumsum(size[alive]) - size[alive]
            o = np.repeat(np.arange(len(alive)), size[alive])
            start = np.zeros((len(alive), k))
            np.put_along_axis(start, rank[alive, :m], np.take_along_axis(full[alive], rank[alive, :m], 1) + 1e-3, 1)
            start /= start.sum(1, keepdims=True)
            share, fit = self._fit(start, s, o, count[rows], p[rows], n[alive])
            better = fit - score[alive] > self.penalty * np.log(n[alive] + 1)
            best[alive[better]], score[alive[better]] = share[better], fit[better]
            alive = alive[better]
        out[ids] = best
        return out, has

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        share, known = self.proportions(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        top = share.argmax(1)
        score = np.where(known, share[np.arange(len(texts)), top], 0.0)
        return [self.langs[t] if k else UNKNOWN for t, k in zip(top, known, strict=True)], np.clip(score, 0, 1)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", penalty: float = 3.0) -> Mixture:
    """The model of all rows with text and language."""
    ready(labelled.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in slices(batches, most=TEXT_BYTES):
            texts, langs = as_string_array(b.column("text")).to_pylist(), np.array(b.column("lang").to_pylist(), object)
            doc, bucket, _ = trigrams(texts)
            names, code = np.unique(langs.astype(str), return_inverse=True)
            for i, name in enumerate(names):
                sums.setdefault(name, np.zeros(1 << BITS, np.int64))
                sums[name] += np.bincount(bucket[code[doc] == i], minlength=1 << BITS)
        for name, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                names=["lang", "bucket", "n"])

    rows = (labelled.select(labelled[text_col].cast("string").alias("text"), labelled[lang_col].cast("string").alias("lang"))
            .where("text IS NOT NULL AND lang IS NOT NULL")
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())  # 2**BITS rows a language at most
    counts: dict[str, np.ndarray] = {}
    for r in rows:
        counts.setdefault(r["lang"], np.zeros(1 << BITS, np.int64))[r["bucket"]] = r["n"]
    return Mixture(counts, penalty)


def identify(docs: DataFrame, model: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row."""
    own = id_and_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, most=TEXT_BYTES):
            pred, score = shared.value.predict(as_string_array(b.column("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    return own.mapInArrow(run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, model: Mixture, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns kept, that have a letter: a language is
    found for each of these, and where none was learnt they stay as well."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches, text_col, TEXT_BYTES):
            texts, model = as_string_array(b.column(text_col)).to_pylist(), shared.value
            keep = [p != UNKNOWN for p in model.predict(texts)[0]] if model.langs else trigrams(texts)[2].tolist()
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out_identification(docs: DataFrame, fold: int = 1, folds: int = 3) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learnt from the rows whose crc32 of
    the id isn't ``fold`` modulo ``folds``. A null id is in no fold."""
    out = F.coalesce(crc_mod(F.col("doc_id"), folds) == fold, F.lit(False))
    model = learn(docs.where(~out))
    return identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")

"""Operator 9: language-model scores from a subword lattice.

A text is a sequence of words and one end. A word is written, with the space
mark before it, as pieces of an existing SentencePiece vocabulary, in any way,
or, if the training texts have it, as one unit of its own; its probability is
the sum over all these ways. The forward recursion in log space gives the sum
over the pieces without listing them. Characters that are no piece are
written in byte pieces. No piece holds the space mark after another
character, so a text's lattice falls apart at its words and its log
probability is the sum of the words' and the end's.

The pieces' weights start from the existing scores (their order: the n-th
weighs 1/n) and are fitted by ``rounds`` of expectation maximisation: each
piece's expected number, by the forward and backward recursion, over the
distinct training words (which is what pieces are needed for: words not met
before). First pieces hold the mark, later ones don't; each kind has a
distribution, with a stop among the later ones, so all words together have
probability one.

A training word with count c among N training tokens counts max(c - D, 0) / N
as a unit; what the discounts D leave, D x words / N, goes to the pieces. D
is n1 / (n1 + 2 n2), from the numbers of words that occur once and twice.

How it runs: a task turns its texts into blocks, each with its distinct words
and the texts as numbers of them. Only the distinct words of blocks travel:
they are counted over all blocks, scored once each and sent back to their
blocks. What reaches the driver are a few totals and one number for each
piece.

The base score of a token is log10((c + 1) / (N + V + 1)) with its count c
among N training tokens of V kinds, the end being a token.

Defined results: null text counts as empty: one token, the end. A null id is
in no fold, so its text is learnt from. Every row gives one row. Nothing to
learn from: N = V = 0, the pieces keep their first weights and have all
words; the end has probability one half.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import as_string_array, crc_mod, ready, staged
from .words import mix, split

MARK = "▁"
LONG = 64              # longer words take the plain recursion, one by one
SLOTS = 18
_BASE = np.uint64(0x100000001B3)
STAGE = ("block long, code int, word string, n long, doc_ids array<long>, held array<boolean>, "
         "sizes array<int>, codes binary")


class Pieces:
    """The vocabulary, looked up by substring."""

    def __init__(self, model_path: str):
        import sentencepiece as sp
        lib = sp.SentencePieceProcessor(model_file=model_path)
        n = lib.get_piece_size()
        usable = [not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)) for i in range(n)]
        self.size = n
        self.byte = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.text = {lib.id_to_piece(i): i for i in range(n) if usable[i]}
        if any(MARK in p.lstrip(MARK) for p in self.text):
            raise ValueError("a piece reaches over a space: words can't be scored alone")
        self.order = np.array([i for i in range(n) if usable[i]] + sorted(self.byte.values()), np.int64)
        self.opens = np.zeros(n + 1, bool)              # the last entry is the stop
        self.opens[[i for p, i in self.text.items() if p.startswith(MARK)]] = True
        self.longest = max(map(len, self.text))
        self.keys, self.ids = np.zeros(1 << SLOTS, np.uint64), np.full(1 << SLOTS, -1, np.int32)
        for p, i in self.text.items():
            h = self.hash_of(p)
            at = self.slot(np.array([h]))[0]
            while self.keys[at]:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.ids[at] = h, i

    @staticmethod
    def hash_of(p: str) -> np.uint64:
        h = 0
        for c in p:
            h = (h * int(_BASE) + ord(c) + 1) % 2**64
        return np.uint64(h)

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (mix(h) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        flat = h.ravel()
        at = self.slot(flat)
        key = self.keys[at]
        out = np.where(key == flat, self.ids[at], -1)
        go = np.flatnonzero((key != flat) & (key != 0))
        while len(go):
            at[go] = (at[go] + 1) % len(self.keys)
            key = self.keys[at[go]]
            hit = key == flat[go]
            out[go[hit]] = self.ids[at[go[hit]]]
            go = go[~hit & (key != 0)]
        return out.reshape(h.shape)

    def first_weights(self) -> np.ndarray:
        """From the existing order: the n-th piece weighs 1/n, the stop as
        much as a third of all later pieces."""
        w = np.zeros(self.size + 1)
        w[self.order] = 1 / np.arange(1, len(self.order) + 1)
        w[-1] = w[~self.opens].sum() / 3
        return w

    def log_p(self, weights: np.ndarray, floor: float = 0.0) -> np.ndarray:
        """Natural log probabilities of the first pieces, and of the later
        ones with the stop; -inf for what is no piece."""
        w = weights.copy()
        w[self.order] += floor
        w[-1] += floor
        for kind in (self.opens, ~self.opens):
            w[kind] /= w[kind].sum()
        with np.errstate(divide="ignore"):
            return np.log(w)

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode()]


class Lattice:
    """Forward and backward recursion over words, with given piece log
    probabilities (natural, -inf: never)."""

    def __init__(self, pieces: Pieces, log_p: np.ndarray):
        self.pieces, self.log_p = pieces, log_p
        self.with_none = np.append(log_p[:-1], -np.inf)      # at -1: no piece

    def _arcs(self, words: list[str], length: int):
        """ids [word, first place, length - 1] of pieces within words of one
        length, and byte-written characters as {(word, place): ids}."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.uint64)
        top = min(length, self.pieces.longest)
        ids = np.full((len(words), length, top), -1, np.int32)
        opens = self.pieces.opens
        with np.errstate(over="ignore"):
            h = np.zeros_like(code)
            for m in range(top):
                h = h[:, :length - m] * _BASE + code[:, m:] + np.uint64(1)
                found = self.pieces.find(h)
                found[:, 0][~opens[found[:, 0]]] = -1           # the first piece holds the mark,
                found[:, 1:][opens[found[:, 1:]]] = -1          # no later one does
                ids[:, :length - m, m] = found
        spelled = {(int(w), int(p)): self.pieces.bytes_of(words[w][p])
                   for w, p in zip(*np.nonzero(ids[:, :, 0] < 0), strict=True)}
        return ids, spelled

    def run(self, words: list[str], expected: np.ndarray | None = None,
            times: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word (with its mark); adds to ``expected``
        each piece's expected number, each word taken ``times``."""
        out = np.zeros(len(words))
        marked = [MARK + w for w in words]
        size = np.fromiter(map(len, marked), np.int64, len(marked))
        for length in np.unique(size):
            own = np.flatnonzero(size == length)
            step = 1 if length > LONG else max(1, (1 << 18) // (int(length) * min(int(length), self.pieces.longest)))
            for i in range(0, len(own), step):
                at = own[i:i + step]
                out[at] = self._same_length([marked[k] for k in at], int(length), expected,
                                            None if times is None else times[at])
        return out

    def _same_length(self, words, length, expected, times):
        ids, spelled = self._arcs(words, length)
        arc = self.with_none[ids]
        for (w, p), raw in spelled.items():
            arc[w, p, 0] = self.log_p[raw].sum()
        top = arc.shape[2]
        forward = np.full((len(words), length + 1), -np.inf)
        forward[:, 0] = 0
        for end in range(1, length + 1):
            m = np.arange(min(end, top))
            forward[:, end] = np.logaddexp.reduce(forward[:, end - 1 - m] + arc[:, end - 1 - m, m], axis=1)
        total = forward[:, length]
        if expected is not None:
            expected[-1] += times.sum()
            backward = np.full((len(words), length + 1), -np.inf)
            backward[:, length] = 0
            for start in range(length - 1, -1, -1):
                m = np.arange(min(length - start, top))
                backward[:, start] = np.logaddexp.reduce(backward[:, start + 1 + m] + arc[:, start, m], axis=1)
            for m in range(top):
                share = np.exp(forward[:, :length - m] + arc[:, :length - m, m] + backward[:, 1 + m:]
                               - total[:, None]) * times[:, None]
                some = ids[:, :length - m, m]
                known = some >= 0
                expected += np.bincount(some[known], weights=share[known], minlength=len(expected))
                if m == 0:
                    for (w, p), raw in spelled.items():
                        for b in raw:
                            expected[b] += share[w, p]
        return total + self.log_p[-1]


def _blocks(docs: DataFrame, most: int) -> DataFrame:
    """Staged blocks: rows of distinct words (block, code, word, n: times in
    training texts) and one row of texts (doc_ids, held, sizes, codes)."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        kept, size = [], 0

        def flush():
            nonlocal number
            ids = pa.concat_arrays([b.column("doc_id") for b in kept])
            held = pa.concat_arrays([b.column("held") for b in kept])
            texts = pa.concat_arrays([as_string_array(b.column("text")) for b in kept])
            coded, offsets = split(pc.ascii_lower(texts))
            n, codes = np.diff(offsets), coded.indices.to_numpy()
            block = (part << 32) + number
            number += 1
            train = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), n)
            times = np.bincount(codes[train], minlength=len(coded.dictionary))
            k = len(coded.dictionary)
            rows = pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, block)), pa.array(np.arange(k, dtype=np.int32)),
                 coded.dictionary.cast(pa.string()), pa.array(times.astype(np.int64)),
                 pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.bool_())),
                 pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, pa.binary())], names=names)
            texts_row = pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()),
                 pa.nulls(1, pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                 pa.array([held.to_pylist()], pa.list_(pa.bool_())), pa.array([n.tolist()], pa.list_(pa.int32())),
                 pa.array([codes.astype(np.uint32).tobytes()], pa.binary())], names=names)
            kept.clear()
            return rows, texts_row

        names = [f.split()[0] for f in STAGE.split(", ")]
        for b in batches:
            if b.num_rows:
                kept.append(b)
                size += b.column("text").nbytes
            if size >= most:
                yield from flush()
                size = 0
        if kept:
            yield from flush()

    return staged(docs.mapInArrow(run, STAGE), "word-blocks")


def fit(words: DataFrame, pieces: Pieces, rounds: int) -> np.ndarray:
    """Log probabilities of the pieces from the distinct training words."""
    sc = words.sparkSession.sparkContext
    log_p, shared = pieces.log_p(pieces.first_weights()), sc.broadcast(pieces)
    for _ in range(rounds):
        now = sc.broadcast(log_p)

        def expect(batches, now=now):
            lattice, sums = Lattice(shared.value, now.value), np.zeros(shared.value.size + 1)
            for b in batches:
                lattice.run(b.column("word").to_pylist(), sums, np.ones(b.num_rows))
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["piece", "n"])

        weights = np.zeros(pieces.size + 1)
        for r in (words.mapInArrow(expect, "piece int, n double").groupBy("piece")
                  .agg(F.sum("n").alias("n")).collect()):                  # a row for each piece of the vocabulary
            weights[r["piece"]] = r["n"]
        if not weights.any():
            break
        log_p = pieces.log_p(weights, 0.01)
    return log_p


def score_texts(docs: DataFrame, model_path: str, fold: int = 2, folds: int = 7, id_col: str = "doc_id",
                text_col: str = "text", rounds: int = 2, block_bytes: int = 24 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    for each row of ``docs``."""
    spark: SparkSession = ready(docs.sparkSession)
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    out = F.coalesce(crc_mod(F.col("doc_id"), folds) == fold, F.lit(False))
    stage = _blocks(own.select("doc_id", out.alias("held"), "text"), block_bytes)
    in_blocks = stage.where("code IS NOT NULL").select("block", "code", "word", "n")
    words = staged(in_blocks.groupBy("word").agg(F.sum("n").alias("c")), "words")
    met = lambda n: F.count(F.when(F.col("c") == n, 1))
    known, tokens, once, twice = words.agg(F.count(F.when(F.col("c") > 0, 1)), F.coalesce(F.sum("c"), F.lit(0)),
                                           met(1), met(2)).first()
    texts = stage.where("code IS NULL").select(F.explode("held").alias("held")).where("NOT held").count()
    train_tokens, kinds = tokens + texts, known + (texts > 0)
    pieces = Pieces(model_path)
    log_p = fit(words.where("c > 0").select("word"), pieces, rounds)
    discount = min(1.0, max(0.1, once / max(1, once + 2 * twice)))
    all_ = max(1, train_tokens) if texts else 2        # nothing learnt: one half to words, one to the end
    left = (discount * known if texts else 1) / all_
    log_end = np.log((texts or 1) / all_)
    model = spark.sparkContext.broadcast((pieces, log_p))

    def score_words(batches):
        lattice = Lattice(*model.value)
        for b in batches:
            unit = np.maximum(b.column("c").to_numpy() - discount, 0) / all_
            with np.errstate(divide="ignore"):
                log_p = np.logaddexp(np.log(unit), np.log(left) + lattice.run(b.column("word").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array(log_p)],
                                             names=["word", "c", "log_p"])

    scored = words.mapInArrow(score_words, "word string, c long, log_p double")

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("code").to_numpy())
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                         "c": pa.array([table.column("c").to_numpy()[order].tobytes()], pa.binary()),
                         "log_p": pa.array([table.column("log_p").to_numpy()[order].tobytes()], pa.binary())})

    # the words of a block: as many as it has distinct ones
    back = (in_blocks.select("block", "code", "word").join(scored, "word").select("block", "code", "c", "log_p")
            .groupBy("block").applyInArrow(pack, "block long, c binary, log_p binary"))
    norm = np.log10(train_tokens + kinds + 1)
    base_end, end = float(np.log10(texts + 1) - norm), log_end / np.log(10)
    known_end = int(texts > 0)

    def add_up(batches):
        for b in batches:
            for r in b.to_pylist():
                sizes = np.array(r["sizes"], np.int64)
                codes = np.frombuffer(r["codes"], np.uint32)
                c = np.frombuffer(r["c"] or b"", np.int64)
                log_p = np.frombuffer(r["log_p"] or b"", np.float64)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums = lambda of: (np.diff(np.concatenate([[0], np.cumsum(of[codes])])[ends])
                                   if len(codes) else np.zeros(len(sizes)))
                owner = np.repeat(np.arange(len(sizes)), sizes)
                exact = lambda of: np.bincount(owner, weights=of[codes], minlength=len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["held"], pa.bool_()), pa.array(sizes + 1),
                     pa.array(sums((c > 0).astype(np.int64)).astype(np.int64) + known_end),
                     pa.array(np.full(len(sizes), train_tokens)),
                     pa.array(exact(np.log10(c + 1) - norm) + base_end),
                     pa.array(exact(log_p / np.log(10)) + end)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    in_texts = stage.where("code IS NULL").select("block", "doc_ids", "held", "sizes", "codes")
    return (in_texts.join(back, "block", "left").select("doc_ids", "held", "sizes", "codes", "c", "log_p")
            .mapInArrow(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                "base_score double, score double"))

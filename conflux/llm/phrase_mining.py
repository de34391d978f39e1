"""Operator 11: phrase collocations by Toivonen's sampling.

Texts are cut into pieces, pieces into words; a phrase is a run of at most
``longest`` words within a piece, counted for each language. A sample of
short runs of words, one of every few successive ones so that what a document
or a piece repeats isn't drawn or missed as a whole, proposes the phrases that are frequent at a lowered threshold,
level by level. One pass over all documents then counts exactly what the
sample proposed together with its negative border: the phrases that it didn't
propose, but whose first and last words less one it did (all other words are
border). If nothing of the border is frequent, the counts are complete: the
shortest missing phrase would have both those parts proposed, and so be
counted. Otherwise the failures join the proposal, and a further pass counts
them, all that holds them and the border that this opens, until it closes; new
failures are longer by a word each time, so there are at most ``longest`` + 1
passes, and mostly two. The sample changes the cost, never the result.

Proposals are held as a bit table of fixed size (2**``filter_bits`` bits, 2 MB
by default), the only thing broadcast; a phrase that shares a bit counts as
proposed. Proposed phrases are counted by their words. Of the border, which
is nearly all there is to count, hashes of 48 bits are counted: a clash can
only raise a count, and what reaches the threshold is proposed and counted by
its words in the next pass. Both travel packed, all that a task has of a range
of hashes in a row: however many phrases pass the threshold, a task sends no
more rows than there are ranges for each table of them it has filled. In a task, phrases of a section are numbered exactly (a phrase
of k words by the numbers of its two parts of k - 1) and summed before they
leave it; a key with a third of all rows is a few rows from each task.

Defined results: null text is empty, null lang is ``und``. A text without
words, an empty table or one without frequent phrases gives no rows. Repeated
rows count each time. A very long text is worked through in sections of
``SECTION`` bytes, each phrase belonging to the section of its first word; a
single word longer than that is taken whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .bit_table import BitTable
from .common import as_string_array, ready, slices, staged
from .words import mix

COUNTS = "lang string, phrase string, h long, n long"
#: Bytes of text a task works on at once.
SECTION = 4 << 20
#: Border phrases whose counts a task holds.
HELD = 1 << 21
#: Bytes of a run that is drawn for the sample.
RUN = 128
_KIND = np.zeros(256, np.uint8)                     # 0: of a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_GAP = re.compile(rb"[ \t.,;:!?\n-\r]")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _hashes(strings: pa.Array) -> np.ndarray:
    values = strings.to_numpy(zero_copy_only=False).astype(object)
    return pd.util.hash_array(values, categorize=False) if len(values) else np.zeros(0, np.uint64)


def gram_hash(words: list[np.ndarray], lang: np.ndarray) -> np.ndarray:
    """64-bit hashes of phrases given as arrays of their words' hashes."""
    with np.errstate(over="ignore"):
        s = mix(lang + np.uint64(len(words)))
        for w in words:
            s = s * _MULT + w
        return mix(s)


class Words:
    """The words of a section of texts: where they stand and which they are."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, lang_hash: np.ndarray, own: int):
        """``data``: bytes of the texts, one after another; the first word of
        a counted phrase starts before byte ``own``."""
        kind = _KIND[data]
        word = kind == 0
        first = word.copy()
        first[1:] &= ~word[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = word[begins]
        starts = np.flatnonzero(first)
        self.count = len(starts)
        before = np.cumsum(word, dtype=np.int32)        # a section is far below 2 GB
        ends = np.append(before[starts] - 1, before[-1:])
        body = np.ascontiguousarray(_LOWER[data[word]])
        coded = pa.Array.from_buffers(pa.large_string(), len(starts),
                                      [None, pa.py_buffer(np.ascontiguousarray(ends.astype(np.int64))), pa.py_buffer(body)])
        coded = pc.dictionary_encode(coded)
        self.spelt, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        text = np.searchsorted(offsets, starts, "right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
        self.piece = np.cumsum(new)
        self.lang = langs[text]
        self.own = starts < own
        self.hash, self.lang_hash = _hashes(self.spelt), lang_hash

    def levels(self, longest: int, proposal: BitTable, counted: BitTable | None = None):
        """For each k (k, place, count, hash, proposed, known, was proposed) of
        the distinct phrases of k words that are counted under ``proposal``: a
        place where each stands, its number in the section, its hash, whether
        it is proposed, whether it was counted under ``counted`` and was
        proposed there. With ``counted``, what holds a newly proposed phrase
        counts as proposed: new ones are few, and a word that is repeated
        without end doesn't take a pass for each length."""
        number, inverse, some = None, None, np.arange(self.count)
        for k in range(1, longest + 1):
            if k == 1:
                pair = self.lang * max(1, len(self.spelt)) + self.word
            else:           # places whose two parts are proposed
                fit = np.zeros(self.count + 1, bool)
                fit[some] = proposed[inverse]
                old_fit = np.zeros(self.count + 1, bool)
                old_fit[some] = old[inverse]
                fresh_at = np.zeros(self.count + 1, bool)
                fresh_at[some] = fresh[inverse]
                number = np.zeros(self.count + 1, np.int64)
                number[some] = inverse
                size = len(proposed)
                some = np.flatnonzero(fit[:-1] & fit[1:])
                some = some[some + k <= self.count]
                some = some[self.piece[some] == self.piece[some + k - 1]]
                pair = number[some] * size + number[some + 1]
            if not len(some):
                return
            inverse, distinct = pd.factorize(pair)
            place = np.empty(len(distinct), np.int64)
            place[inverse[::-1]] = some[::-1]            # where each stands first
            count = np.bincount(inverse[self.own[some]], minlength=len(place))
            h = gram_hash([self.hash[self.word[place + j]] for j in range(k)], self.lang_hash[self.lang[place]])
            proposed = proposal.has(h)
            if counted is None:
                old = np.zeros(len(place), bool)
                known = old
            else:
                known = np.ones(len(place), bool) if k == 1 else old_fit[place] & old_fit[place + 1]
                old = known & counted.has(h)
            fresh = proposed & ~old if counted is not None else old
            if k > 1:
                fresh = fresh | fresh_at[place] | fresh_at[place + 1]
            proposed = proposed | fresh
            out = count > 0
            yield k, place[out], count[out], h[out], proposed[out], known[out], old[out]

    def phrases(self, place: np.ndarray, k: int) -> pa.Array:
        parts = [self.spelt.take(pa.array(self.word[place + j])) for j in range(k)]
        return parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def _sections(data: np.ndarray, most: int, longest: int):
    """(from, to, to with the words that phrases begun before may need) of a
    long text, cut between words."""
    raw, at, n = memoryview(data), 0, len(data)
    ahead = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (longest - 1))
    while at < n:
        gap = _GAP.search(raw, min(n, at + most))
        end = gap.start() if gap else n
        yield at, end, ahead.match(raw, end).end()
        at = end


def sections(batches, longest: int, most: int = SECTION):
    """:class:`Words` and language names for each section of (text, lang)
    batches."""
    for b in slices(batches, most=most):
        texts = as_string_array(b.column("text"))
        langs = pc.dictionary_encode(pc.fill_null(b.column("lang").cast(pa.string()), "und"))
        names, lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
        data, offsets = _bytes(texts)
        if len(texts) > 1 or len(data) <= most:
            yield Words(data, offsets, lang, _hashes(names), len(data)), names
            continue
        for start, end, far in _sections(data, most, longest):
            yield Words(data[start:far], np.array([0, far - start]), lang, _hashes(names), end - start), names


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins and the
    last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def sampled_runs(texts: DataFrame, one_in: int) -> DataFrame:
    """(text, lang): of each ``one_in`` successive short runs of words of a text
    one, drawn at random. Pieces are runs, longer ones are cut at the first
    space of every ``RUN`` bytes; so of a word that one place repeats for some
    runs about its share is drawn."""

    def draw(batches):
        for b in slices(batches, most=SECTION):
            data, offsets = _bytes(as_string_array(b.column("text")))
            data = data.copy()
            spaces = np.flatnonzero(_KIND[data] == 1) if one_in > 1 else np.zeros(0, np.int64)
            data[spaces[np.unique(spaces // RUN, return_index=True)[1]]] = ord("\n")
            starts = np.concatenate([np.flatnonzero(_KIND[data] == 2) + 1, offsets[:-1]])
            starts = np.unique(starts[starts < len(data)])
            size = np.diff(np.append(starts, len(data)))
            of = np.searchsorted(offsets, starts, "right") - 1
            with np.errstate(over="ignore"):
                seed = b.column("seed").to_numpy().view(np.uint64)
                number = (np.arange(len(starts)) - np.searchsorted(of, of)).astype(np.uint64)
                layer, n = number // np.uint64(one_in), np.uint64(one_in)
                drawn = number % n == mix(seed[of] + (layer + np.uint64(1)) * _MULT) % n
            kept = np.bincount(of, np.where(drawn, size, 0), len(offsets) - 1).astype(np.int64)
            body = np.ascontiguousarray(data[np.repeat(drawn, size)])
            text = pa.Array.from_buffers(pa.large_string(), len(kept),
                                         [None, pa.py_buffer(np.concatenate([[0], np.cumsum(kept)])), pa.py_buffer(body)])
            out = pa.RecordBatch.from_arrays([text.cast(pa.string()), b.column("lang")], names=["text", "lang"])
            yield out.filter(pa.array(kept > 0))

    seeded = texts.withColumn("seed", F.xxhash64("text", F.monotonically_increasing_id()))
    return seeded.mapInArrow(draw, "text string, lang string")


def _sampled(texts: DataFrame, longest: int, level: int, proposal: BitTable) -> DataFrame:
    """(h, n): the hashes of the sample's phrases of ``level`` words whose
    parts are proposed, with their counts."""
    table = proposal.share(texts.sparkSession)

    def count(batches):
        proposed, held = BitTable(*table.value), _Sums()
        for words, _ in sections(batches, longest):
            for k, _, n, h, *_ in words.levels(level, proposed):
                if k == level:
                    yield from held.add(h, n)
        yield from held.flush()

    return texts.mapInArrow(count, "h long, n long").repartition("h").groupBy("h").agg(F.sum("n").alias("n"))


class _Sums:
    """Counts of hashes, added up in a task up to a bounded number of them."""

    def __init__(self, most: int = HELD):
        self.most, self.parts, self.held = most, [], 0

    def add(self, h: np.ndarray, n: np.ndarray):
        self.parts.append((h, n))
        self.held += len(h)
        if self.held > self.most:
            yield from self.flush()

    def flush(self):
        if self.held:
            h, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            code, distinct = pd.factorize(h)
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, code, n)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(sums)], names=["h", "n"])
        self.parts, self.held = [], 0


#: Bits of a border phrase's hash that are kept.
KEPT = 48


def ranges_of(partitions: int) -> int:
    """Bits that deal hashes out: eight ranges or more for each partition of a
    shuffle, so that a range, which one task adds up, shrinks with them."""
    return min(24, max(10, (8 * partitions - 1).bit_length()))


def packed(h: np.ndarray, n: np.ndarray, dealt: int):
    """(range, blob) for each range of hashes that some of ``h`` lie in: their
    first ``KEPT`` bits in order as gaps, with their counts, compressed. A count
    over 255 is written as several."""
    code, distinct = pd.factorize(h >> np.uint64(64 - KEPT))
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, code, n)
    order = np.argsort(distinct)
    h, n = distinct[order], sums[order]
    times = -(-n // 255)
    h, last = np.repeat(h, times), np.cumsum(times) - 1
    small = np.full(len(h), 255, np.int64)
    small[last] = n - 255 * (times - 1)
    of = (h >> np.uint64(KEPT - dealt)).astype(np.int64)
    some, starts = np.unique(of, return_index=True)
    for r, i, j in zip(some.tolist(), starts.tolist(), [*starts[1:].tolist(), len(h)], strict=True):
        gap = np.diff(h[i:j], prepend=np.uint64(r << (KEPT - dealt)))
        raw = gap.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes() + small[i:j].astype(np.uint8).tobytes()
        yield r, (j - i).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(r: int, blob: bytes, dealt: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes' first bits and the counts of a blob."""
    m = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(pa.decompress(blob[4:], 6 * m, "zstd", asbytes=True), np.uint8)
    gap = np.zeros((m, 8), np.uint8)
    gap[:, :5] = raw[:5 * m].reshape(5, m).T
    h = np.cumsum(gap.reshape(-1).view("<u8")) + np.uint64(r << (KEPT - dealt))
    return h, raw[5 * m:].astype(np.int64)


def packed_phrases(table: pa.Table, dealt: int):
    """(range, blob) for each range of hashes that some of the phrases (key, h,
    n) lie in: their counts and their keys, a line each, compressed."""
    h, n = table.column("h").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(h)
    h, n = h[order], n[order]
    keys = table.column("key").combine_chunks().take(pa.array(order))
    lines = pc.binary_join_element_wise(keys, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    data, offsets = _bytes(lines)
    some, starts = np.unique((h >> np.uint64(64 - dealt)).astype(np.int64), return_index=True)
    for r, i, j in zip(some.tolist(), starts.tolist(), [*starts[1:].tolist(), len(h)], strict=True):
        raw = n[i:j].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() + data[offsets[i]:offsets[j]].tobytes()
        yield r, (j - i).to_bytes(4, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked_phrases(blob: bytes) -> tuple[bytes, np.ndarray]:
    """The lines of keys and the counts of a blob."""
    m, size = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:12], "little")
    raw = pa.decompress(blob[12:], size, "zstd", asbytes=True)
    n = np.ascontiguousarray(np.frombuffer(raw, np.uint8)[:8 * m].reshape(8, m).T).reshape(-1).view("<i8")
    return raw[8 * m:], n


ROWS = "range int, spelt boolean, blob binary"


def _summed(table: pa.Table) -> pa.Table:
    """(key, h, n) with each phrase once."""
    coded = pc.dictionary_encode(table.column("key").combine_chunks())
    code = coded.indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1))        # numbers are given as they come
    sums = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(sums, code, table.column("n").to_numpy())
    return pa.Table.from_arrays([coded.dictionary, pa.array(table.column("h").to_numpy()[first]), pa.array(sums)],
                                names=["key", "h", "n"])


def _added_up(batches, least: int, dealt: int):
    """What a partition of :func:`_sent` holds, added up range by range of
    hashes: what reaches ``least``, and the numbers of all words."""
    lines, held, now = [], [], None

    def border():
        if held:
            h, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            code, distinct = pd.factorize(h)
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, code, n)
            many = sums >= least
            none = pa.nulls(int(many.sum()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.array((distinct[many] << np.uint64(64 - KEPT)).view(np.int64)), pa.array(sums[many])],
                names=["lang", "phrase", "h", "n"])

    def phrases():
        if lines:
            data = np.frombuffer(b"".join([x for x, _ in lines]), np.uint8)
            n = np.concatenate([x for _, x in lines])
            lines.clear()
            ends = np.append(0, np.flatnonzero(data == ord("\n")) + 1)
            coded = pc.dictionary_encode(pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)]))
            sums = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(sums, coded.indices.to_numpy(), n)
            many = (sums >= least) | pc.ends_with(coded.dictionary, "\t\n").to_numpy(zero_copy_only=False)
            found, sums = coded.dictionary.filter(pa.array(many)).to_pylist(), sums[many]
            for i in range(0, len(found), 1 << 16):
                lang, phrase = zip(*(key[:-1].split("\t") for key in found[i:i + (1 << 16)]), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(map(json.loads, lang)), pa.string()), pa.array(phrase, pa.string()),
                     pa.nulls(len(lang), pa.int64()), pa.array(sums[i:i + (1 << 16)])], names=["lang", "phrase", "h", "n"])

    for b in batches:
        for r, spelt, blob in zip(b.column("range").to_pylist(), b.column("spelt").to_pylist(), b.column("blob"), strict=True):
            if r != now:
                yield from border()
                yield from phrases()
                now = r
            if spelt:
                lines.append(unpacked_phrases(blob.as_py()))
            else:
                held.append(unpacked(r, blob.as_py(), dealt))
    yield from border()
    yield from phrases()


def _sent(texts: DataFrame, longest: int, proposal: BitTable, before: BitTable | None, dealt: int) -> DataFrame:
    """(range, spelt, blob): each task's counts of the proposed phrases that
    weren't counted by their words before, spelt, and of the border that wasn't
    counted before. The phrase '' stands for all words."""
    now = proposal.share(texts.sparkSession)
    then = None if before is None else before.share(texts.sparkSession)

    def count(batches):
        new, old = BitTable(*now.value), None if then is None else BitTable(*then.value)
        parts, held, table, waiting = [], 0, None, []

        def spelt(lang, phrase, h, n):
            """A key is the language in JSON, a tab and the phrase: neither holds a line break or another tab."""
            key = pc.binary_join_element_wise(lang, phrase, pa.scalar("\t", pa.large_string()))
            waiting.append(pa.Table.from_arrays([key, pa.array(h), pa.array(n)], names=["key", "h", "n"]))

        def rows(some, is_spelt):
            r, blob = zip(*some, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array([is_spelt] * len(r)), pa.array(blob, pa.binary())],
                                              names=["range", "spelt", "blob"])

        def phrases(last: bool):
            """The proposed phrases' counts, added up until they are too many."""
            nonlocal table
            if waiting and (last or sum(map(len, waiting)) > HELD // 8):
                table = _summed(pa.concat_tables([*waiting] if table is None else [table, *waiting]))
                waiting.clear()
            if table is not None and (last or len(table) > HELD // 4):
                yield rows(packed_phrases(table, dealt), True)
                table = None

        def border():
            if parts:
                yield rows(packed(*(np.concatenate(x) for x in zip(*parts, strict=True)), dealt), False)
                parts.clear()

        for words, names in sections(batches, longest):
            langs = pa.array([json.dumps(x) for x in names.to_pylist()], pa.large_string())
            if old is None and words.own.any():
                total = np.bincount(words.lang[words.own], minlength=len(names))
                spelt(langs, pa.array([""] * len(names), pa.large_string()), words.lang_hash, total.astype(np.int64))
            for k, place, n, h, proposed, known, was in words.levels(longest, new, old):
                rest = ~proposed & ~known
                if rest.any():
                    parts.append((h[rest], n[rest]))
                    held += int(rest.sum())
                some = np.flatnonzero(proposed & ~was)
                for a in range(0, len(some), 1 << 16):
                    p = some[a:a + (1 << 16)]
                    spelt(langs.take(pa.array(words.lang[place[p]])), words.phrases(place[p], k), h[p], n[p])
            yield from phrases(False)
            if held > HELD:
                yield from border()
                held = 0
        yield from phrases(True)
        yield from border()

    return texts.mapInArrow(count, ROWS)


def _counted(texts: DataFrame, longest: int, proposal: BitTable, before: BitTable | None, least: int) -> DataFrame:
    """(lang, phrase, h, n): what reaches ``least`` of the proposed phrases that
    weren't counted by their words before, with null h, and of the border's
    hashes that weren't counted before, with null lang and phrase. The phrase ''
    stands for all words."""
    dealt = ranges_of(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # a task's counts are added up already: they are dealt out as they are, each range of hashes to one task
    return (_sent(texts, longest, proposal, before, dealt).repartition("range").sortWithinPartitions("range")
            .mapInArrow(lambda batches: _added_up(batches, least, dealt), COUNTS))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100,
                     longest: int = 5, sample_one_in: int = 2, filter_bits: int = 24) -> tuple[DataFrame, int]:
    """(lang, phrase, n) of every phrase of up to ``longest`` words that stands
    ``least`` times or more in the texts of a language, words joined by a
    space, with one phrase '' a language for the number of all words; and how
    many passes over all documents it took."""
    ready(docs.sparkSession)
    texts = docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    sample = staged(sampled_runs(texts, sample_one_in), "phrase-sample")
    share = 1 / sample_one_in
    proposal = BitTable(filter_bits)
    for level in range(1, longest + 1):
        expected = least * share * (1 if sample_one_in == 1 else max(0.5, 1 - (level - 1) / 12))     # less what lies across runs
        lowered = max(1, int(expected - 4.5 * (expected * (1 - share)) ** 0.5))
        last, proposal = proposal, proposal.with_hashes(_sampled(sample, longest, level, proposal).where(F.col("n") >= lowered))
        last.release()
    found, before, passes = None, None, 0
    while True:
        passes += 1
        rows = staged(_counted(texts, longest, proposal, before, least)
                      .where((F.col("n") >= least) | (F.col("phrase") == "")), "phrases")
        new = rows.where("h IS NULL").drop("h")
        found = new if found is None else found.unionByName(new)
        missed = rows.where("h IS NOT NULL").select("h")
        if before is not None:
            before.release()
        if missed.isEmpty():
            proposal.release()
            if passes > 2:        # further passes can count a phrase again, with the same result
                found = found.groupBy("lang", "phrase").agg(F.max("n").alias("n"))
            return found, passes
        before, proposal = proposal, proposal.with_hashes(missed)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100,
                 longest: int = 5, top: int = 2000, inside_percent: int = 100, **mining) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top``
    phrases by the score of their weakest cut."""
    found, _ = frequent_phrases(docs, text_col, lang_col, least, longest, **mining)
    found = staged(found, "frequent")
    totals = found.where("phrase = ''").select("lang", F.col("n").alias("total"))
    counts = found.where("phrase <> ''")
    words = F.split("phrase", " ")
    several = counts.withColumn("w", words).where("size(w) > 1").withColumn("size", F.size("w"))
    part = lambda first, size: F.array_join(F.slice("w", first, size), " ")
    cuts = (several.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", F.col("n").alias("a"), "cut",
                    part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("tail")))
    of = lambda column, name: counts.select("lang", F.col("phrase").alias(column), F.col("n").alias(name))
    wide = lambda name, digits=19: F.col(name).cast(f"decimal({digits},0)")
    scored = (cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
              .join(F.broadcast(totals) if _few(totals) else totals, "lang")
              .withColumn("up", (wide("a", 16) * 1000).cast("decimal(19,0)") * wide("total"))
              .withColumn("down", wide("l") * wide("r")).withColumn("score", F.expr("up div down")))
    weakest = (scored.groupBy("lang", "phrase")
               .agg(F.min(F.struct("score", "cut", "a", "l", "r", "total")).alias("c"))
               .select("lang", "phrase", "c.a", "c.l", "c.r", F.col("c.total").alias("n"), "c.score"))
    # phrases inside a longer one that is (nearly) as frequent
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda s: F.transform(F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice("w", i, s), " "))))
    inside = (several.where("size > 2").select("lang", F.col("n").alias("longer"), F.explode(spans).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (weakest.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * inside_percent)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def _few(frame: DataFrame, most: int = 10_000) -> bool:
    """Whether a frame has few enough rows to be broadcast."""
    return frame.limit(most + 1).count() <= most

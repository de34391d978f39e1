"""Operator 5: token ids in files of rANS-coded blocks.

Writing: documents are range-partitioned and sorted by id; each partition
encodes its texts, appends the end id to every document and cuts the ids into
blocks, which are staged while their frequencies are summed. The shared table
is made of the counts of all ids, then each staged block is coded on its own.

Layout of a store (Parquet as container, so any store that Spark writes to
will do, and a lost executor's tasks leave nothing behind):

- ``table``: symbol, freq;
- ``blocks``: part, block (their order is the documents' order), n_ids; the
  pieces of documents in it: doc_ids, rows (the document's number in its
  part), sizes; first_open and last_open (the first piece began, the last one
  goes on in a neighbouring block); words, states, offsets, crc32 as in
  :mod:`conflux.llm.rans`.

Reading decodes blocks independently and joins the checksums of documents
that lie in several.

What units of text the tokenizer may be given: it splits its text before every
space that follows and precedes something else than white space. Texts whose
spaces are all like that, or at the very start or end, are cut at them, any
other text is encoded as a whole. A unit of Latin letters, digits, ASCII
punctuation other than apostrophes and single line breaks is cut further, into
the runs of each that the tokenizer would cut it into; words with and without
punctuation behind them then share their ids. All cutting is done on arrays of
bytes, and each distinct unit of a slice is looked up once.

Defined results: null text counts as empty and has only the end id. Rows of
equal id are ordered by a hash of their text, then by it, null ids first; each
row has its own place. An empty table makes an empty store.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_path
from . import rans
from .common import as_string_array, id_and_text, ready, slices, staged
from .units import UnitIds

PIECES = ("part int, block int, n_ids long, doc_ids array<long>, rows array<long>, sizes array<long>, "
          "first_open boolean, last_open boolean")
_TOGETHER = 8          # blocks coded side by side
_TEXT_BYTES = 8 << 20  # of which distinct units are looked up once
_INNER = re.compile(r" \s")
#: Kinds of bytes. Latin letters are those up to U+024F, which every version of Unicode has as such; what follows the
#: first byte of another character may be taken for one, as the first byte makes its unit odd.
_SPACE, _LINE, _LETTER, _DIGIT, _MARK, _ODD = range(6)
_LATIN = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])"
_RUN = re.compile(rb" ?(?:" + _LATIN + rb"+|[0-9]+|[!-&(-/:-@\[-`{-~]+)|\n")
#: How byte-level tokenizers write bytes: printable ones as they are, the others from U+0100 on. They write no line
#: break, which stands for 0 here.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELT = np.zeros(256, "<u2")
_SPELT[_PRINTED] = _PRINTED
_SPELT[_SPELT == 0] = range(256, 512 - len(_PRINTED))
_SPELT[0] = ord("\n")
_loaded: dict = {}


def _kinds(special: list[str]) -> np.ndarray:
    """The kind of each byte; those that special tokens begin with are odd."""
    kind = np.full(256, _ODD, np.uint8)
    kind[32], kind[10] = _SPACE, _LINE
    kind[33:127] = _MARK
    kind[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = _LETTER
    kind[48:58] = _DIGIT
    kind[0x80:0xc0] = kind[0xc3:0xca] = _LETTER
    kind[ord("'")] = _ODD
    kind[[t.strip().encode()[0] for t in special if t.strip()]] = _ODD
    return kind


class Encoder:
    """The tokenizer with the ids of units it has met, one for each worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.kind = _kinds(special)
        self.by_run = self._splits_runs(special)
        self.units = UnitIds(self._ids)

    def _splits_runs(self, special: list[str]) -> bool:
        """Whether the tokenizer takes letters, digits and marks, each with the
        space before them, as one run to its merges."""
        spec = json.loads(self.tok.to_str())
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        return (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"]
                and model["type"] == "BPE" and not model.get("dropout") and spec["normalizer"] is None
                and not any(re.match(r"[\w\s]|$", t) for t in special))

    def _ids(self, new: list[bytes]) -> list:
        """The ids of new units; runs skip the library's splitting, which is
        most of its cost."""
        is_run = [self.by_run and bool(_RUN.fullmatch(unit)) for unit in new]
        raw = b"\0".join([u for u, run in zip(new, is_run, strict=True) if run])       # which no run holds
        runs = iter(_SPELT[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le").split("\n"))
        rest = iter(self.tok.encode_batch_fast([u.decode() for u, run in zip(new, is_run, strict=True) if not run],
                                               add_special_tokens=False))
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(next(runs))] if run else next(rest).ids for run in is_run]

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where units of texts begin, given as bytes one after another."""
        kind = self.kind[data]
        begins = kind == _SPACE
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        if not self.by_run:
            return np.flatnonzero(begins)
        first = np.flatnonzero(begins)
        same = kind[1:] == kind[:-1]
        odd = np.concatenate([
            np.flatnonzero(kind == _ODD), np.flatnonzero(same & (kind[1:] == _LINE)),
            # multiplication and division signs, and letters from U+0250 on
            np.flatnonzero((data[:-1] == 0xc3) & ((data[1:] == 0x97) | (data[1:] == 0xb7))),
            np.flatnonzero((data[:-1] == 0xc9) & (data[1:] >= 0x90))])
        whole = np.zeros(len(first), bool)
        whole[np.searchsorted(first, odd, "right") - 1] = True
        cut = ~same & (kind[:-1] != _SPACE)
        if len(odd):
            cut &= ~np.repeat(whole, np.diff(np.append(first, len(data))))[1:]
        begins[1:] |= cut
        return np.flatnonzero(begins)

    def _by_unit(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        starts = self._starts(data, offsets)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                      [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        coded = pc.dictionary_encode(coded)
        self.units.find(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat, n = self.units.gather(coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(starts, offsets)]
        return flat, np.diff(ends)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and each text's number."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        inner = pc.match_substring_regex(texts, r" [\s\pZ\x0b\x1c-\x1f\x85]").to_numpy(zero_copy_only=False)
        if not inner.any():
            return self._by_unit(texts)
        flat, n = self._by_unit(texts.filter(pa.array(~inner)))
        cut = iter(np.split(flat, np.cumsum(n)[:-1])) if len(n) else iter(())
        parts = [np.array(self.tok.encode(t.as_py(), add_special_tokens=False).ids, np.uint32) if whole else next(cut)
                 for t, whole in zip(texts, inner, strict=True)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


def _encoder(path: str) -> Encoder:
    """The worker's encoder, kept from task to task (by the module, not by a
    task's function, which travels with copies of what it names)."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _forget() -> None:
    _loaded.clear()


def _cut(stream, width):
    """Blocks of ``rans.BLOCK`` ids from (doc ids, sizes, ids) of successive
    documents: the staged rows of a partition."""
    part = TaskContext.get().partitionId()
    block, row, open_, held, n_held = 0, -1, False, [], 0
    pieces: list = []

    def emit(ids, last_open):
        nonlocal block, pieces
        doc, rows, sizes = zip(*pieces, strict=True)
        out = pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()),
             pa.array([doc], pa.list_(pa.int64())), pa.array([rows], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([open_]), pa.array([last_open]),
             pa.array([ids.astype(width).tobytes()], pa.binary())],
            names=["part", "block", "n_ids", "doc_ids", "rows", "sizes", "first_open", "last_open", "ids"])
        block, pieces = block + 1, []
        return out

    for docs, sizes, ids in stream:
        held.append(ids)
        for doc, size in zip(docs, sizes.tolist(), strict=True):
            row += 1
            while n_held + size >= rans.BLOCK:
                take = rans.BLOCK - n_held
                pieces.append((doc, row, take))
                flat = np.concatenate(held)
                size -= take
                yield emit(flat[:rans.BLOCK], size > 0)
                held, n_held, open_ = [flat[rans.BLOCK:]], 0, size > 0
                if not size:
                    break
            if size:
                pieces.append((doc, row, size))
                n_held += size
    if pieces:
        yield emit(np.concatenate(held)[:n_held], False)


def _dicts(b: pa.RecordBatch, fields) -> list[dict]:
    return [dict(zip(fields, r, strict=True)) for r in zip(*(b.column(f).to_pylist() for f in fields), strict=True)]


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
                text_col: str = "text", part_bytes: int = 32 << 20) -> None:
    """Write a store of all rows of ``docs`` to ``path``."""
    from tokenizers import Tokenizer
    spark = ready(docs.sparkSession)
    own = id_and_text(docs, id_col, text_col)
    vocabulary = max(end_id + 1, Tokenizer.from_file(tokenizer_path).get_vocab_size())
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    size = own.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0

    def tokenize(batches):
        encoder = _encoder(tokenizer_path)

        def stream():
            for b in slices(batches, most=_TEXT_BYTES):
                ids, n = encoder.encode(as_string_array(b.column("text")))
                yield b.column("doc_id").to_pylist(), n + 1, np.insert(ids, np.cumsum(n), end_id)
        yield from _cut(stream(), width)

    tie = F.xxhash64("text")
    stage = new_path(spark, "token-ids")
    (own.repartitionByRange(max(1, -(-size // part_bytes)), F.col("doc_id").asc_nulls_first(), tie)
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text")
     .mapInArrow(tokenize, PIECES + ", ids binary")
     .write.option("compression", "zstd").parquet(stage))
    staged = spark.read.schema(PIECES + ", ids binary").parquet(stage)

    def count(batches):
        sums = np.zeros(vocabulary, np.int64)
        for b in batches:
            for raw in b.column(0):
                sums += np.bincount(np.frombuffer(raw.as_buffer(), width), minlength=vocabulary)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["symbol", "n"])

    sums = np.zeros(vocabulary, np.int64)
    for r in (staged.select("ids").mapInArrow(count, "symbol int, n long")
              .groupBy("symbol").agg(F.sum("n").alias("n")).collect()):      # a row for each id of the vocabulary
        sums[r["symbol"]] = r["n"]
    table = rans.Table.of_counts(sums)
    spark.createDataFrame([(int(s), int(table.freq[s])) for s in np.flatnonzero(table.freq)],
                          "symbol int, freq long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(table)
    kept = [f.split()[0] for f in PIECES.split(", ")]

    def code(batches):
        for b in batches:
            for i in range(0, b.num_rows, _TOGETHER):
                some = b.slice(i, _TOGETHER)
                rows = rans.encode(shared.value, [np.frombuffer(x.as_buffer(), width) for x in some.column("ids")])
                yield pa.RecordBatch.from_arrays(
                    [some.column(f) for f in kept]
                    + [pa.array([r[f] for r in rows], pa.binary()) for f in ("words", "states", "offsets")]
                    + [pa.array([r["crc32"] for r in rows], pa.int64())],
                    names=[*kept, "words", "states", "offsets", "crc32"])

    (staged.mapInArrow(code, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


BLOCKS = PIECES + ", words binary, states binary, offsets binary, crc32 long"


def read_table(spark: SparkSession, path: str) -> rans.Table:
    rows = spark.read.schema("symbol int, freq long").parquet(f"{path}/table").collect()
    freq = np.zeros(max((r["symbol"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        freq[r["symbol"]] = r["freq"]
    return rans.Table(freq)


def part_starts(blocks: DataFrame) -> dict[int, int]:
    """The number of ids before each part: a row for each partition."""
    starts, total = {}, 0
    for r in sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), key=lambda r: r["part"]):
        starts[r["part"]] = total
        total += r["n"]
    return starts


def decoded_blocks(spark: SparkSession, path: str, each, schema: str) -> DataFrame:
    """``each(block row, its ids)`` gives a record batch of ``schema``."""
    ready(spark)
    shared = spark.sparkContext.broadcast(read_table(spark, path))

    def run(batches):
        _forget()          # a worker that wrote has no more use for its encoder
        fields = [f.split()[0] for f in BLOCKS.split(", ")]
        for b in batches:
            for i in range(0, b.num_rows, _TOGETHER):
                rows = _dicts(b.slice(i, _TOGETHER), fields)
                for row, ids in zip(rows, rans.decode(shared.value, rows), strict=True):
                    yield each(row, ids)

    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(run, schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """part, row, doc_id, block, ids: the pieces of documents, decoded."""
    def each(row, ids):
        sizes = np.array(row["sizes"], np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(row["rows"], pa.int64()),
             pa.array(row["doc_ids"], pa.int64()), pa.array([row["block"]] * len(sizes), pa.int32()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))],
            names=["part", "row", "doc_id", "block", "ids"])
    return decoded_blocks(spark, path, each, "part int, row long, doc_id long, block int, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document of a store."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    starts = spark.sparkContext.broadcast(part_starts(blocks))

    def each(row, ids):
        sizes = np.array(row["sizes"], np.int64)
        ends = np.cumsum(sizes)
        start = starts.value[row["part"]] + row["block"] * rans.BLOCK + ends - sizes
        raw = memoryview(ids.astype("<u4").tobytes())
        open_ = np.zeros(len(sizes), bool)
        open_[0] |= row["first_open"]
        open_[-1] |= row["last_open"]
        return pa.RecordBatch.from_arrays(
            [pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(row["rows"], pa.int64()),
             pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(sizes),
             pa.array([zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)],
                      pa.int64()), pa.array(open_)],
            names=["part", "row", "doc_id", "start", "n_tokens", "ids_crc32", "open"])

    # both parts of the result read them: blocks are decoded once
    pieces = staged(decoded_blocks(spark, path, each, "part int, row long, doc_id long, start long, n_tokens long, "
                                                      "ids_crc32 long, open boolean"), "pieces")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def join(pdf):
        pdf = pdf.sort_values("start")
        crc = 0
        for n, c in zip(pdf["n_tokens"], pdf["ids_crc32"], strict=True):
            crc = rans.crc32_joined(crc, int(c), 4 * int(n))
        one = pdf[names].head(1).copy()
        one["doc_id"] = one["doc_id"].astype("Int64")
        one["n_tokens"], one["ids_crc32"] = pdf["n_tokens"].sum(), crc
        return one

    # the pieces of one document: as many as it has blocks
    several = (pieces.where("open").groupBy("part", "row")
               .applyInPandas(join, "doc_id long, start long, n_tokens long, ids_crc32 long"))
    return pieces.where("NOT open").select(*names).unionByName(several)


def store_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to a new store in the shared folder and read it back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-store")
    write_store(docs, path, tokenizer_path, end_id)
    return read_digests(spark, path)

"""Operator 10: SentencePiece encoding and decoding with byte offsets.

The normaliser takes, at each place of the text, the longest prefix that the
model's compiled character map knows, and notes for every byte it writes
which byte of the text it stands for; a prefix the map doesn't know is one
character as it is. Every piece covers a run of normalised bytes, so this
alignment projects it to a span of bytes of the original text. The ids are
the library's own.

No piece of the model holds a space after another character, so what lies
between two spaces gets the same ids alone as in its text (the space before a
word is what the library puts before a text anyway). But for runs of spaces: a
piece may be several of them, as may a space and the character U+2581 that
stands for one. Texts without double or outer spaces and without U+2581 are
therefore encoded by distinct word; any other text as a whole, and so every
text with a model for which this doesn't hold.

Defined results: null text counts as empty: no pieces, decoded text empty.
Every row gives one row.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_string_array, id_and_text, slices
from .units import TEXT_BYTES, UnitIds

SPACE = "\u2581"
_loaded: dict = {}


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes whose values are
    places in a table of zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size:]

    def longest(self, raw: bytes, at: int) -> tuple[bytes | None, int]:
        """(replacement, bytes taken) of the longest known prefix at a place."""
        found, taken = None, 0
        if not self.units:
            return found, taken
        unit = self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found, taken = self.texts[start:self.texts.index(b"\0", start)], i + 1 - at
        return found, taken


def _char(raw: bytes, at: int) -> int:
    """Bytes of the character at a place."""
    b = raw[at]
    return 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4


class Normalizer:
    def __init__(self, spec, prefix: bool):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = prefix and spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.space = SPACE.encode() if spec.escape_whitespaces else b" "
        self.plain = not self.map.units and not self.squeeze

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them, and the end, its place
        in ``raw``."""
        if not raw:
            return b"", np.zeros(1, np.int64)
        if self.plain:
            source = np.frombuffer(raw, np.uint8)
            width = np.where(source == 32, len(self.space), 1)
            head = len(self.space) if self.prefix else 0
            place = np.concatenate([np.zeros(head, np.int64), np.repeat(np.arange(len(raw)), width), [len(raw)]])
            return self.space * bool(head) + raw.replace(b" ", self.space), place
        parts, at = [], 0
        while at < len(raw):
            new, taken = self.map.longest(raw, at)
            if new is None:
                taken = _char(raw, at)
                new = raw[at:at + taken]
            parts.append((new, at))
            at += taken
        if self.squeeze:
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
        out, place, last_space = bytearray(), [], self.squeeze
        if self.prefix and parts:
            out += self.space
            place += [parts[0][1]] * len(self.space)
        for new, start in parts:
            if self.squeeze and last_space:
                new = new.lstrip(b" ")
            for b in new:
                wide = self.space if b == 32 else bytes([b])
                out += wide
                place += [start] * len(wide)
            if new:
                last_space = new.endswith(b" ")
        end = len(raw)
        if self.squeeze:
            while out.endswith(self.space):
                del out[-len(self.space):]
                end = place[-len(self.space)]
                del place[-len(self.space):]
        return bytes(out), np.array([*place, end], np.int64)


class Model:
    """A SentencePiece model with its normaliser, one for each worker."""

    def __init__(self, path: str):
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb
        with open(path, "rb") as f:
            raw = f.read()
        self.lib = sp.SentencePieceProcessor(model_proto=raw)
        proto = pb.ModelProto()
        proto.ParseFromString(raw)
        suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.normalize = Normalizer(proto.normalizer_spec, not suffix)
        kinds = proto.SentencePiece
        self.width = np.array([1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.encode())
                               for p in proto.pieces], np.int64)
        self.fallback = proto.trainer_spec.byte_fallback
        self.by_word = (self.normalize.plain and self.normalize.prefix and self.fallback
                        and not any(SPACE in p.piece.lstrip(SPACE) or p.type == kinds.USER_DEFINED
                                    for p in proto.pieces))
        # the worker keeps them while it goes on to other work
        self.words = UnitIds(lambda new: self.lib.encode(new, num_threads=1), most_bytes=64 << 20, dtype=np.int32)
        self.decimal = [str(i).encode() for i in range(len(proto.pieces))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and each text's number."""
        if not self.by_word:
            ids = self.lib.encode(texts, num_threads=1)
            return (np.fromiter((i for one in ids for i in one), np.int32),
                    np.fromiter(map(len, ids), np.int64, len(ids)))
        units, n_units, whole = [], np.zeros(len(texts), np.int64), {}
        for k, t in enumerate(texts):
            w = t.split(" ")
            if "" in w or SPACE in t:              # outer or double spaces, empty, or the mark itself
                whole[k] = np.array(self.lib.encode(t), np.int32)
            else:
                units += w
                n_units[k] = len(w)
        flat, n = self.words.gather(self.words.places(units))
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(n_units)])]
        if not whole:
            return flat, np.diff(ends)
        parts = [whole[k] if k in whole else flat[ends[k]:ends[k + 1]] for k in range(len(texts))]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of the original text for each piece."""
        normal, place = self.normalize(text.encode())
        if self.fallback:
            width = self.width[ids]
        else:                                       # an unknown piece is as wide as what it stands for
            width = np.fromiter((len(p.encode()) for p in self.lib.encode(text, out_type=str)), np.int64, len(ids))
        ends = np.cumsum(width)
        if len(ids) and ends[-1] != len(normal):
            raise ValueError(f"pieces cover {ends[-1]} of {len(normal)} normalised bytes")
        return place[ends - width], place[ends]


def _model(path: str) -> Model:
    if path not in _loaded:
        _loaded[path] = Model(path)
    return _loaded[path]


def _each(model: Model, b: pa.RecordBatch):
    """(text, ids, first bytes, ends) of each row of a slice."""
    texts = as_string_array(b.column("text")).to_pylist()
    flat, n = model.encode(texts)
    at = np.cumsum(n) - n
    for t, a, m in zip(texts, at, n, strict=True):
        ids = flat[a:a + m]
        yield t, ids, *model.spans(t, ids)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, starts, ends (byte spans of the pieces), decoded."""

    def run(batches):
        model = _model(model_path)
        for b in slices(batches, most=TEXT_BYTES):
            rows = list(_each(model, b))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                 pa.array(model.lib.decode([r[1].tolist() for r in rows], num_threads=1), pa.string())],
                names=["doc_id", "ids", "starts", "ends", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, ids array<int>, starts array<long>, ends array<long>, decoded string")


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same encoding, of which only digests leave the task: doc_id,
    n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256, n_bytes (where the last piece ends in the text)."""

    def run(batches):
        model = _model(model_path)
        decimal = model.decimal.__getitem__
        for b in slices(batches, most=TEXT_BYTES):
            n, ids_sha, text_sha, covered = [], [], [], []
            for _, ids, _, ends in _each(model, b):
                own = ids.tolist()
                n.append(len(own))
                ids_sha.append(hashlib.sha256(b",".join(map(decimal, own))).hexdigest())
                text_sha.append(hashlib.sha256(model.lib.decode(own).encode()).hexdigest())
                covered.append(int(ends[-1]) if len(ends) else 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(covered, pa.int64())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long")

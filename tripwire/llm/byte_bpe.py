"""Byte-level BPE by a sentencepiece model that is written straight from a vocabulary.

A rank file lists byte strings and their ranks. Each becomes a piece of a
sentencepiece BPE model: its bytes are mapped to one printable character each,
its score is the negative rank, and the normaliser is the identity without a
leading or an escaped blank. Merging the best-scored pair first, the leftmost
among equals, is then merging by the smallest rank. A text is cut into
pre-tokens by a pattern; each is mapped and encoded by itself, and the pieces'
numbers are turned back into ranks. Decoding joins the pieces and maps their
characters back to bytes. A pre-token that is a piece as a whole is that piece,
also where its merges do not lead there.

Nothing is trained and no text is normalised, so decoding gives a text's UTF-8
bytes back. A document is one row throughout and nothing is shuffled. The model
(some 1 MB, the size of the vocabulary file) goes to the workers as a broadcast.
The memory of a task holds the pre-tokens of STRETCH characters, the tokens of
one document, and at most KNOWN remembered pre-tokens.

Defined results: null and empty texts have no tokens; a very long text is encoded
whole, also when it is a single pre-token; bytes that are not UTF-8 count as
U+FFFD; special tokens are ordinary text; ties do not occur, as ranks differ;
repeated rows and null ids are encoded each by itself; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

KNOWN = 200_000  # pre-tokens whose ids a worker remembers
SHORT = 64  # characters of a pre-token that is worth remembering
STRETCH = 1 << 20  # characters of a text whose pre-tokens are held at once
ROWS = 256  # documents of one Arrow batch of results

BPE, UNKNOWN = 2, 2  # fixed values of the model format


def characters() -> list[str]:
    """The printable character of each byte: itself where it is printable in Latin-1, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


_CHARS = characters()
_TO_CHARS = dict(enumerate(_CHARS))
_TO_BYTES = {ord(c): b for b, c in enumerate(_CHARS)}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARS)


def unmapped(text: str) -> bytes:
    return text.translate(_TO_BYTES).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: on each line a byte string in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(tag: int, value: bytes | int | float) -> bytes:
    """A field of a protocol buffer message: bytes, a whole number or a 32-bit float."""
    if isinstance(value, bytes):
        return _number(tag << 3 | 2) + _number(len(value)) + value
    if isinstance(value, float):
        return _number(tag << 3 | 5) + struct.pack("<f", value)
    return _number(tag << 3) + _number(value)


def serialise(pieces: list[bytes], scores: list[float]) -> bytes:
    """The sentencepiece model of byte strings and their scores; an unknown piece, which never occurs, comes last."""
    one = lambda piece, score, kind: _field(1, _field(1, piece) + _field(2, score) + _field(3, kind))
    body = [one(mapped(piece).encode(), score, 1) for piece, score in zip(pieces, scores, strict=True)]
    unknown = one(b"<unk>", min(scores) - 1.0, UNKNOWN)
    trainer = _field(2, _field(3, BPE) + _field(40, len(pieces)))
    normaliser = _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return b"".join([*body, unknown, trainer, normaliser])


class _Known(dict):
    """Pre-tokens and their packed ids; what is not known yet is encoded."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, token: str) -> bytes:
        packed = self.encode(token)
        if len(token) <= SHORT and len(self) < KNOWN:
            self[token] = packed
        return packed


class Codec:
    """Encoder and decoder for one vocabulary and pre-token pattern; ids are packed as ``encode`` says."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary has no piece for the bytes {missing}")
        pieces = sorted(ranks, key=ranks.__getitem__)
        self.ranks = [ranks[piece] for piece in pieces]
        self.model = serialise(pieces, [-float(rank) for rank in self.ranks])
        self.pattern = pattern
        self.whole: dict[str, list[int]] = {}
        self._open()
        forms = [mapped(piece) for piece in pieces]
        alone = self.sp.encode(forms, num_threads=1)
        self.whole = {form: [i] for i, (form, ids) in enumerate(zip(forms, alone, strict=True)) if ids != [i]}

    def _open(self) -> None:
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.find = regex.compile(self.pattern)
        self.known = _Known(self._pre_token)
        self.packed = [struct.pack("<I", rank) for rank in self.ranks]
        self.bytes_of = {rank: unmapped(self.sp.id_to_piece(i)) for i, rank in enumerate(self.ranks)}

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("ranks", "model", "pattern", "whole")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._open()

    def _pre_token(self, token: str) -> bytes:
        form = mapped(token.encode())
        places = self.whole.get(form) or self.sp.encode(form)
        return b"".join(map(self.packed.__getitem__, places))

    def encode(self, text: str) -> bytes:
        """The packed ranks of a text's tokens."""
        if len(text) <= STRETCH:
            return b"".join(map(self.known.__getitem__, self.find.findall(text)))
        tokens = (m.group() for m in self.find.finditer(text))
        parts = []
        while some := list(islice(tokens, STRETCH // 8)):
            parts.append(b"".join(map(self.known.__getitem__, some)))
        return b"".join(parts)

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; an id that is not in the vocabulary is an error."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _added(rows: DataFrame, keep: list[str], **columns) -> StructType:
    schema = StructType([rows.schema[c] for c in keep])
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode(texts: DataFrame, keep: list[str], codec: Codec, text: Column | None = None) -> DataFrame:
    """The ``keep`` columns, ``n_tokens``, and ``ids``: 4 bytes for each token, unsigned, little-endian."""
    shared = texts.sparkSession.sparkContext.broadcast(codec)
    source = F.make_valid_utf8(F.coalesce((F.col("text") if text is None else text).cast("string"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in _slices(batches):
            found = [coder.encode(t) for t in batch.column(len(keep)).to_pylist()]
            counts = pa.array([len(ids) // 4 for ids in found], pa.int64())
            ids = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], counts, ids], [*keep, "n_tokens", "ids"])

    rows = texts.select(*keep, source.alias("source text"))
    return rows.mapInArrow(run, _added(rows, keep, n_tokens=LongType(), ids=BinaryType()))


def decode(tokens: DataFrame, keep: list[str], codec: Codec) -> DataFrame:
    """The ``keep`` columns and ``decoded``, the bytes that the packed ``ids`` stand for; null has none."""
    shared = tokens.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in _slices(batches):
            found = [coder.decode(ids or b"") for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(found, pa.binary())], [*keep, "decoded"])

    rows = tokens.select(*keep, F.col("ids").alias("packed ids"))
    return rows.mapInArrow(run, _added(rows, keep, decoded=BinaryType()))

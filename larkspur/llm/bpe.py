"""Byte-level BPE through a sentencepiece model that is written out from the ranks.

The model file is serialised here, field by field: every token's bytes become one
printable character each, its score is its negative rank, and the normaliser does
nothing.  Sentencepiece then merges the pair of the best score first, leftmost on ties,
which is the order of the ranks.  Pre-tokens are encoded one by one; ids are ranks.
Decoding maps each piece's characters back to bytes.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larkspur.llm import common

_MEMO = 200_000
_UNKNOWN = "<unk>"


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be consecutive from 0")
    return [t for _, t in pairs]


def byte_letters() -> str:
    """A printable character for each byte: itself if it is one, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(rest)) for b in range(256))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    """A vocabulary entry: text (1), score (2), kind (3; 1 normal, 2 unknown)."""
    return _field(1, _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _field(3, kind))


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model with these tokens; the unknown piece comes last.

    Trainer fields: model type (3) is BPE (2), ids of unknown, start, end and padding
    (40 to 43), the last three absent.  Normaliser: name (1) identity, no dummy prefix (3),
    white space neither removed (4) nor escaped (5).
    """
    letters, none = byte_letters(), (1 << 64) - 1
    pieces = [_piece("".join(letters[b] for b in t), -float(i), 1) for i, t in enumerate(tokens)]
    pieces.append(_piece(_UNKNOWN, -float(len(tokens)), 2))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(_field(i, none) for i in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.unknown = len(tokens)
        self.split = regex.compile(pattern).findall
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        back = {ord(c): b for b, c in enumerate(letters)}
        names = self.model.id_to_piece(list(range(len(tokens))))
        self.bytes_of = [p.translate(back).encode("latin-1") for p in names]
        # a pre-token that is itself in the vocabulary is one token, whatever the merges give
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.memo: dict[str, bytes] = _Memo(self)

    def encode_piece(self, piece: str) -> np.ndarray:
        raw = piece.encode()
        if (one := self.whole.get(raw)) is not None:
            return np.array([one], dtype=np.int32)
        ids = np.array(self.model.encode(raw.decode("latin-1").translate(self.letters)), dtype=np.int32)
        if (ids == self.unknown).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.split(text))), dtype=np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Memo(dict):
    """Ids of short pre-tokens as raw bytes, up to `_MEMO` of them."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _MEMO:
            self.clear()
        got = self.codec.encode_piece(piece).tobytes()
        if len(piece) <= 32:
            self[piece] = got
        return got


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file; built once per Python process."""
    return Codec(read_ranks(path), pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """`df` with the token ids of `text` (null: none) and, if named, their decoded bytes.

    `path` is a rank file every executor can open.
    """
    fields = [(out, T.ArrayType(T.IntegerType(), False))] + ([(decoded, T.BinaryType())] if decoded else [])

    def make():
        own = codec(path, pattern)

        def work(texts: pa.Array) -> list[pa.Array]:
            parts = [own.encode(t or "") for t in texts.to_pylist()]
            cols = [_lists(parts)]
            if decoded:
                cols.append(pa.array([own.decode(p.tolist()) for p in parts], pa.binary()))
            return cols

        return work

    return common.add_columns(df, [text], fields, make)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with the bytes of the token ids (null: empty); ids outside the vocabulary fail."""

    def make():
        own = codec(path, pattern)

        def work(lists: pa.Array) -> list[pa.Array]:
            return [pa.array([own.decode(x or []) for x in lists.to_pylist()], pa.binary())]

        return work

    return common.add_columns(df, [ids], [(out, T.BinaryType())], make)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return common.list_of(pa.array(np.concatenate([*parts, np.zeros(0, np.int32)])), offsets)

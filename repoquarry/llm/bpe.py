"""Byte-level BPE through a sentencepiece model that is written straight from a list of ranks.

Each byte is one character beyond ASCII, so that the model sees nothing it would normalise; a token is
the string of its bytes' characters with the negative rank as score, and merging the best-scored pair
first, leftmost among equals, is merging the lowest rank first. Pre-tokens are encoded each by itself;
one that is a token as it stands is taken as that token, as the ranks' own library does. Ids are packed
as little-endian unsigned 32-bit integers, the form of token shards. Null is the empty text: no ids.
"""

from __future__ import annotations

import base64
import struct
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from repoquarry.llm.common import SLICE, batch_of, slices, with_fields
from repoquarry.session import ship_package

_BASE = 0x100  # character of byte 0; 0x100 to 0x1FF have no special meaning to the library
_MAP = {b: chr(_BASE + b) for b in range(256)}
CACHE = 1 << 17  # different pre-tokens a task remembers; it forgets all when full
_LONG = 1 << 18  # characters; the pre-tokens of longer texts are not listed at once
_WORTH = 64  # bytes; longer pre-tokens are encoded each time


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: a number, a float or a block of bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(_MAP)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model: an unknown piece, then the tokens by rank; piece number = position + 1."""
    # field numbers and kinds of the public model format: pieces 1 (piece 1, score 2, type 3), trainer 2
    # (model_type 3 = BPE 2), normaliser 3 (name 1, add_dummy_prefix 3, remove_extra_whitespaces 4,
    # escape_whitespaces 5); piece type 2 is the unknown piece
    out = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        out.append(_field(1, _field(1, mapped(token).encode()) + _field(2, float(-rank))))
    trainer = _field(3, 2) + _field(41, 2**64 - 1) + _field(42, 2**64 - 1) + _field(43, 2**64 - 1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one task; each is made when it is first used."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        order = sorted(ranks.values())
        self._rank_of_piece = np.array([0, *order], "<u4")
        self._whole = ranks
        self._pattern = regex.compile(pattern)
        self._known: dict[str, bytes] = {}

    @cached_property
    def _model(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=serialise(self._whole))

    @cached_property
    def _tokens(self) -> dict[int, bytes]:
        return {r: t for t, r in self._whole.items()}

    def _of(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self._whole.get(raw)
        if rank is not None:
            ids = rank.to_bytes(4, "little")
        else:
            ids = self._rank_of_piece[self._model.encode(mapped(raw))].tobytes()
        if len(piece) <= _WORTH:
            if len(self._known) >= CACHE:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The packed ids."""
        known, of = self._known.get, self._of
        if len(text) > _LONG:
            return b"".join(known(m[0]) or of(m[0]) for m in self._pattern.finditer(text))
        return b"".join([known(piece) or of(piece) for piece in self._pattern.findall(text)])

    def forget(self) -> None:
        """Give the memory of seen pre-tokens back: the task's Python outlives the task."""
        self._known = {}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def _codec(path: str, pattern: str) -> Codec:
    """One for each task's Python, which reads the vocabulary file at its own place."""
    return Codec(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Documents with n_tokens and token_ids (packed); without the text if it is not wanted any more."""
    ship_package(docs.sparkSession)
    schema = with_fields(docs.schema, ("n_tokens", "bigint"), ("token_ids", "binary"), drop=() if keep_text else (text,))

    def run(batches):
        codec = _codec(path, pattern)
        for whole in batches:
            for batch in slices(whole, text, SLICE):
                ids = [codec.encode(t or "") for t in batch.column(text).to_pylist()]
                added = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "token_ids": pa.array(ids, pa.binary())}
                yield batch_of(batch, schema, added)
        codec.forget()

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """Encoded documents with the decoded bytes; null ids give null."""
    ship_package(encoded.sparkSession)
    schema = with_fields(encoded.schema, ("decoded", "binary"))

    def run(batches):
        codec = _codec(path, pattern)
        for batch in batches:
            decoded = [None if x is None else codec.decode(x) for x in batch.column(ids).to_pylist()]
            yield batch_of(batch, schema, {"decoded": pa.array(decoded, pa.binary())})

    return encoded.mapInArrow(run, schema)

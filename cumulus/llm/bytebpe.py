"""Byte-level BPE encoding and decoding through a sentencepiece model that is
serialised directly from a rank file.

Every token's bytes are written as one printable character each, its score is
the negative rank and the normaliser is the identity, so sentencepiece's
best-score-first merging is the rank-ordered merging of byte-level BPE. Texts
are split by the pre-token pattern first and each pre-token is encoded alone;
decoding maps ids back to bytes.

Defined results: null text counts as empty, an empty text has no ids; each
row is encoded alone, so repeated rows repeat; other columns pass through
(clashing names are replaced); empty in, empty out. A pre-token may be of any
length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

#: Pre-tokens that a worker remembers in each of two generations; when the
#: young one is full it becomes the old one, so frequent ones stay.
CACHE = 1 << 18


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is printable
    Latin-1, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order of a file with lines ``base64 rank``; the ranks
    must be 0 to n - 1."""
    found = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    if sorted(found) != list(range(len(found))):
        raise ValueError(f"ranks of {path} have gaps")
    return [found[i] for i in range(len(found))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def _field(number: int, value) -> bytes:
    """One protobuf field: bytes and str by length, float as fixed 32 bits,
    int and bool as varint (negative ones in 64 bits)."""
    if isinstance(value, str):
        value = value.encode()
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value) & (1 << 64) - 1)


def build_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks; the
    unknown piece that sentencepiece wants comes after them."""
    letters = byte_letters()
    n = len(tokens)
    pieces = [_field(1, _field(1, "".join(letters[b] for b in t)) + _field(2, float(-rank)) + _field(3, 1))
              for rank, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = b"".join((_field(3, 2), _field(4, n + 1), _field(40, n), _field(41, -1), _field(42, -1), _field(43, -1)))
    normalizer = _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        back = {c: b for b, c in enumerate(byte_letters())}
        self.size = self.sp.get_piece_size() - 1
        self.bytes = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(self.size)]
        self.whole = {t: i for i, t in enumerate(self.bytes)}
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        # \s of the rank files' pattern is the Unicode property White_Space
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.known: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _learn(self, pieces: list[str]) -> None:
        rest = []
        for p in pieces:
            ids = self.old.get(p)
            if ids is None:
                at = self.whole.get(p.encode())
                ids = None if at is None else (at,)
            if ids is None:
                rest.append(p)
            else:
                self.known[p] = ids
        if rest:
            one = self.sp.encode  # one by one: a list call starts threads each time
            for p in rest:
                self.known[p] = tuple(one(p.encode().decode("latin-1").translate(self.letters)))

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        known = self.known
        new = [p for p in set(pieces) if p not in known]
        if new:
            if len(known) + len(new) > CACHE:
                self.old, self.known = known, {}
                known, new = self.known, list(set(pieces))
            self._learn(new)
        return list(chain.from_iterable(map(known.__getitem__, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``docs`` with n_tokens, ids (little-endian unsigned integers of two
    bytes, of four where the vocabulary has over 65,536 tokens), ids_sha256
    and decoded_sha256. The vocabulary is read on the driver and its model, a
    few MB at most, travels with the task."""
    added = {"n_tokens": "bigint", "ids": "binary", "ids_sha256": "string", "decoded_sha256": "string"}
    base = docs.drop(*added)
    if base.columns.count("text") != 1:
        raise ValueError("documents need one text column")
    model = build_model(read_ranks(vocabulary))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema),
                        *(f"{k} {v}" for k, v in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model, pattern)
        kind = "<u2" if codec.size <= 1 << 16 else "<u4"
        strings = [str(i) for i in range(codec.size)]
        for batch in batches:
            n, raw, sha, back = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text or "")
                n.append(len(ids))
                raw.append(np.array(ids, dtype=kind).tobytes())
                sha.append(hashlib.sha256(",".join(map(strings.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            cols = [pa.array(n, pa.int64()), pa.array(raw, pa.binary()), pa.array(sha, pa.string()),
                    pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *added])

    return base.mapInArrow(run, schema)

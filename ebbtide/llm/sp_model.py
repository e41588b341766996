"""Reading a SentencePiece model file: the protobuf wire format, pieces, trainer and normaliser settings."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

SPACE = "▁"
#: Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) in order; varints as ints, everything else as bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class PieceModel:
    kind: int
    pieces: tuple[tuple[str, float, int], ...]  # text, score, type
    byte_fallback: bool
    unknown_id: int
    add_dummy_prefix: bool
    remove_extra_spaces: bool
    escape_spaces: bool
    charsmap: bytes


def read_model(data: bytes) -> PieceModel:
    """Defaults are those of the format."""
    pieces, trainer, normalizer = [], {}, {}
    for field, value in wire_fields(data):
        if field == 1:
            own = dict(wire_fields(value))
            pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(wire_fields(value))
        elif field == 3:
            normalizer = dict(wire_fields(value))
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    return PieceModel(
        trainer.get(3, UNIGRAM), tuple(pieces), bool(trainer.get(35, 0)), unknown, bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)), bool(normalizer.get(5, 1)), normalizer.get(2, b""),
    )

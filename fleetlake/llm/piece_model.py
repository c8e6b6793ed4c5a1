"""Reading a SentencePiece model file: its pieces and the settings that bear on encoding.

The file is a protocol buffer; only the fields below are read. Fixed values of the published format:
pieces are field 1 (text 1, score 2, type 3), trainer settings field 2 (model type 3), normaliser
settings field 3 (rules 2, dummy prefix 3, whitespace removal 4, escaping 5).
"""

from __future__ import annotations

import struct
from functools import lru_cache
from typing import NamedTuple

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


class PieceModel(NamedTuple):
    kind: int
    pieces: list[str]
    scores: list[float]
    types: list[int]
    dummy_prefix: bool

    def unknown_id(self) -> int:
        return self.types.index(UNKNOWN)

    def byte_ids(self) -> list[int] | None:
        """Ids of the 256 byte pieces, None for a model without byte fallback."""
        ids = [0] * 256
        if BYTE not in self.types:
            return None
        for i, kind in enumerate(self.types):
            if kind == BYTE:
                ids[int(self.pieces[i][3:5], 16)] = i
        return ids


def _fields(raw: bytes):
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, raw[at : at + size]
            at += size


@lru_cache(maxsize=4)
def load_pieces(path: str) -> PieceModel:
    """The model at `path`. Models whose normaliser rewrites characters, removes white space or has
    user-defined pieces are refused, because their encoding needs more than pieces and scores."""
    with open(path, "rb") as file:
        raw = file.read()
    pieces, scores, types, kind, norm = [], [], [], UNIGRAM, {}
    for field, value in _fields(raw):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            types.append(piece.get(3, NORMAL))
        elif field == 2:
            kind = dict(_fields(value)).get(3, UNIGRAM)
        elif field == 3:
            norm = dict(_fields(value))
    if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1):
        raise ValueError("models that normalise characters or white space are not supported")
    if USER_DEFINED in types or UNUSED in types or kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models without user-defined or unused pieces are supported")
    return PieceModel(kind, pieces, scores, types, bool(norm.get(3, 1)))

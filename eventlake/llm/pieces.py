"""The vocabulary of a SentencePiece BPE model, and its way of cutting a text into independent chunks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

SPACE = "▁"


@dataclass
class Pieces:
    """Pieces that merges can make, by text; ids of the 256 byte pieces; surface bytes of all ids."""

    ids: dict[str, int]
    rank: np.ndarray  # per id: smaller merges first
    byte_ids: np.ndarray
    surfaces: list[bytes]
    chunk: re.Pattern = field(init=False)

    def __post_init__(self):
        # A merge never crosses into a space mark unless a piece holds one behind another character;
        # a character that is no piece never merges at all.
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        line = "\n" not in "".join(self.ids)
        if inner:
            self.chunk = re.compile(r"[^\n]+|\n" if line else r"(?s).+")
        else:
            rest = rf"[^{SPACE}\n]" if line else rf"[^{SPACE}]"
            self.chunk = re.compile(rf"{SPACE}+{rest}*|{rest}+" + (r"|\n" if line else ""))

    def chunks(self, text: str) -> list[str]:
        """Chunks of the marked text; each is encoded the same alone as in its text."""
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []


def load(path: str) -> Pieces:
    """Read a model without normalisation that puts a space mark in front and falls back to bytes."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    rules = proto.normalizer_spec
    if (
        proto.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE
        or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
        or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
        or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)
    ):
        raise ValueError("only BPE models without normalisation and without user-defined pieces are read")
    processor = SentencePieceProcessor(model_file=path)
    normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
    scores = np.array([p.score for p in proto.pieces])
    rank = np.empty(len(scores), np.int64)
    rank[np.lexsort((np.arange(len(scores)), -scores))] = np.arange(len(scores))
    byte_ids = np.array([processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    surfaces = [b"" if p.type == kinds.CONTROL else p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
    for b, i in enumerate(byte_ids):
        surfaces[i] = bytes([b])
    surfaces[processor.unk_id()] = proto.trainer_spec.unk_surface.encode()
    return Pieces(normal, rank, byte_ids, surfaces)

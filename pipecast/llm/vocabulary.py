"""A SentencePiece vocabulary as plain values that travel to the tasks with a function."""

from __future__ import annotations

from dataclasses import dataclass

MARK = "▁"
# Where the vocabulary file is unless the caller says otherwise.
VOCABULARY_FILE = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` and ``scores`` by id; ``plain`` ids stand for text, ``byte_ids`` for the 256 bytes."""

    pieces: list[str]
    scores: list[float]
    plain: list[int]
    byte_ids: list[int]

    @property
    def weights(self) -> dict[int, float]:
        """Weight of each plain piece. The scores are minus the rank r of a merge, whose weight is 1 / (r + 10)."""
        return {i: 1.0 / (10.0 - self.scores[i]) for i in self.plain}

    @property
    def inside_words(self) -> list[int]:
        """Plain pieces that fit in one marked word: no mark but at the start."""
        return [i for i in self.plain if MARK not in self.pieces[i][1:]]


def load_vocabulary(path: str = VOCABULARY_FILE) -> Vocabulary:
    """Read the file on the driver; its size does not depend on the corpus."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the vocabulary has no pieces for single bytes")
    special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)}
    return Vocabulary(pieces, [model.get_score(i) for i in ids], [i for i in ids if i not in special], byte_ids)

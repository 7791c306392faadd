"""Pieces of a public SentencePiece file, read as the vocabulary of a unigram model.

A unigram model cuts a text into the pieces with the highest sum of scores. Blanks
become U+2581, one more is put in front, and a character that no piece covers is
spelt in bytes. As no piece has a blank behind another character, a text is cut
wherever a blank follows one; each cut part has its own best path.
"""

from __future__ import annotations

from dataclasses import dataclass

import public_tokenizers
import sentencepiece

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
# More pieces than any public vocabulary has; tables up to this size are sent to every task.
MAX_PIECES = 1_000_000


@dataclass(frozen=True)
class Pieces:
    """scores: by piece, those that a text can hold. ids: likewise. byte_ids: of <0x00> to <0xFF>."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: tuple[int, ...]

    @property
    def unknown_score(self) -> float:
        return min(self.scores.values()) - UNKNOWN_PENALTY

    @property
    def longest(self) -> int:
        return max(map(len, self.scores))


def load(path: str | None = None) -> Pieces:
    """The ordinary pieces of a file; control and byte pieces match no text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
    plain = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    if len(plain) > MAX_PIECES:
        raise ValueError("too many pieces")
    names = {model.id_to_piece(i): i for i in plain}
    if any(BLANK in name.lstrip(BLANK) for name in names):
        raise ValueError("a piece has a blank inside, so texts cannot be cut at blanks")
    return Pieces(
        {name: model.get_score(i) for name, i in names.items()},
        names,
        tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256)),
    )


# A run of blanks with what follows up to the next blank or line feed, which is no part of a piece.
PARTS = r" *[^ \n]+|\n| +"

"""A SentencePiece vocabulary and the units of a text that no piece crosses.

A text is read as the tokenizer does: a space in front, every space written as U+2581.
Pieces hold that sign only as their first characters, so none reaches over the border
between a word and the space after it. Borders cut a text into units (spaces and the word
that follows), and what is best for a text is what is best for each unit.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

from docflow.llm import words as w

SIGN = "▁"  # fixed value: how pieces write a space


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces with id and score; ids of the byte pieces; the bytes that ids decode to."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    texts: list[bytes]
    least: float


@cache
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file, loaded once by each worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, texts = {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        text = b""
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            text = bytes([int(piece[3:5], 16)])
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            if SIGN in piece.lstrip(SIGN):
                raise ValueError(f"piece {piece!r} reaches over a word border")
            pieces[piece] = (i, model.get_score(i))
            text = piece.replace(SIGN, " ").encode()
        texts.append(text)
    return Vocabulary(pieces, byte_ids, texts, min(score for _, score in pieces.values()))


def units(block: w.Block, tag: np.ndarray | None = None) -> tuple[np.ndarray, w.Words]:
    """The block's bytes with a space in front of each text, and its units as words.

    tag: a number of each text, 0 to 127, written over the first byte of its units (always
    a space) as 128 + tag, so equal units with other tags differ. An empty text has no unit.
    """
    size = np.diff(block.offs)
    some = size > 0
    buf = np.insert(block.buf, block.offs[:-1][some], 32)
    offs = np.concatenate([[0], np.cumsum(size + some)])
    space = buf == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offs[:-1][some]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(buf))[: len(starts)]
    at = np.searchsorted(starts, offs)
    counts = np.diff(at)
    if tag is not None:
        buf[starts] = (128 + np.repeat(tag, counts)).astype(np.uint8)
    return buf, w.Words(starts, ends, counts, at, w.hash_segments(buf, starts, ends))

"""Counts of a text that quality rules and the quality classifier share."""

from __future__ import annotations

import numpy as np

from docflow.llm import words as w

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
MARK = np.zeros(256, dtype=bool)
MARK[list(b"!?.,;:'\"()[]{}-_=+/\\@^~`")] = True
FIRST_BYTE = np.ones(256, dtype=bool)  # of a code point
FIRST_BYTE[0x80:0xC0] = False


def _bytes_per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return w.per_text(flags, offs)


def _grouped(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (owner, hash), and for each in that order whether it equals the one before."""
    with np.errstate(over="ignore"):
        key = w.mix(hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = key[order[1:]] == key[order[:-1]]
    return order, same


def duplicate_lines(block: w.Block) -> tuple[np.ndarray, np.ndarray]:
    """By text: lines with a word that equal an earlier line, and all lines with a word."""
    newline = block.buf == 10
    starts, ends, _ = w.segments(~newline, block.offs)
    inside = np.concatenate([[0], np.cumsum(~w.SPACE[block.buf])])
    some = inside[ends] > inside[starts]
    starts, ends = starts[some], ends[some]
    owner = np.searchsorted(block.offs, starts, side="right") - 1
    order, same = _grouped(owner, w.hash_segments(block.buf, starts, ends))
    dup = np.bincount(owner[order[same]], minlength=block.n)
    return dup.astype(np.int64), np.bincount(owner, minlength=block.n).astype(np.int64)


def repeated_words(words: w.Words, n: int) -> np.ndarray:
    """By text: words in n-word windows that the text holds twice or more."""
    hashes, at = w.ngrams(words, n)
    order, same = _grouped(words.doc[at], hashes)
    twice = same.copy()
    twice[:-1] |= same[1:]
    covered = np.zeros(len(words.hashes) + n, bool)
    first = at[order[twice]]
    for j in range(n):
        covered[first + j] = True
    return w.per_text(covered[: len(words.hashes)], words.offs)


def measure(block: w.Block) -> dict[str, np.ndarray]:
    """The counts of each text of a block (all zero for an empty text)."""
    buf, offs = block.buf, block.offs
    words = w.split_words(block)
    inside = ~w.SPACE[buf]
    dup_lines, lines = duplicate_lines(block)
    order, same = _grouped(words.doc, words.hashes)
    repeats = np.bincount(words.doc[order[same]], minlength=block.n)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": _bytes_per_text(inside & FIRST_BYTE[buf], offs),
        "n_symbols": _bytes_per_text(SYMBOLS[buf], offs),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated_words(words, 3),
        "n_lines": lines,
        "n_upper": _bytes_per_text(UPPER[buf], offs),
        "n_digits": _bytes_per_text(DIGIT[buf], offs),
        "n_marks": _bytes_per_text(MARK[buf], offs),
        "n_again": repeats.astype(np.int64),  # words that occurred before in the text
        "n_pairs_again": repeated_words(words, 2),
    }

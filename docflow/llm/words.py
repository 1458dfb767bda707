"""Words, lines and hashes of many texts at once, as flat numpy arrays.

Helpers that run inside tasks: Spark deals the rows out, these take the texts of one
Arrow batch in blocks of a few megabytes and give arrays over all their words. A word is
a run of bytes other than 0x20 and 0x09-0x0D, so of `[^\\x20\\x09-\\x0D]+`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20  # texts of a block; a longer text is a block of its own

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: 64 bits in, 64 well mixed bits out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keyed(n: int, key: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers of a key."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))


_BYTE = keyed(256, 0x5EED)
_PLACE = keyed(4096, 0xB10C) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = keyed(max(n, 2 * len(_PLACE)), 0xB10C) | np.uint64(1)
    return _PLACE


@dataclass
class Block:
    """Some texts of a batch: rows first..last, their bytes and where each text begins."""

    first: int
    last: int
    buf: np.ndarray
    offs: np.ndarray

    @property
    def n(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> str:
        return self.buf[self.offs[i] : self.offs[i + 1]].tobytes().decode("utf-8", "replace")


def plain(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of 64-bit offsets; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


def blocks(texts: pa.Array | pa.ChunkedArray, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts in blocks of at most block_bytes (or one text)."""
    texts = plain(texts)
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offs, offs[first] + block_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield Block(first, last, raw[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
        first = last


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lens[i] - 1 for each i in turn."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = starts - (np.cumsum(lens) - lens)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, lens)


def hash_segments(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment of bytes."""
    lens = ends - starts
    out = np.zeros(len(starts), np.uint64)
    some = np.flatnonzero(lens)
    if len(some):
        n = lens[some]
        at = np.cumsum(n) - n
        place = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(at, n)
        value = _BYTE[buf[place + np.repeat(starts[some], n)]] * _places(int(n.max()))[place]
        out[some] = np.add.reduceat(value, at)
    return mix(out + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass
class Words:
    """The words of a block in order; those of text i are offs[i] .. offs[i + 1] - 1."""

    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    offs: np.ndarray
    hashes: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def segments(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of inside bytes, none across two texts: starts, ends and the count by text."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs) - 1, np.int64)
    before = np.empty(n, bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    before[offs[:-1][offs[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = before[1:] | ~inside[1:]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    at = np.searchsorted(starts, offs)
    return starts, ends, np.diff(at)


def split_words(block: Block, lower: bool = False) -> Words:
    """The words of a block; lower: hashed with A-Z lower-cased."""
    starts, ends, counts = segments(~SPACE[block.buf], block.offs)
    buf = LOWER[block.buf] if lower else block.buf
    offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return Words(starts, ends, counts, offs, hash_segments(buf, starts, ends))


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n consecutive words of one text, and the place of its first word."""
    total = len(words.hashes)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = words.doc
    at = np.flatnonzero(doc[n - 1 :] == doc[: total - n + 1])
    factor = keyed(n, 0x96A3) | np.uint64(1)
    value = np.zeros(len(at), np.uint64)
    for j in range(n):
        value += words.hashes[at + j] * factor[j]
    return mix(value), at


def per_text(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of values by text, for values in text order with offsets offs."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The segments as bytes objects."""
    raw = buf.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


class Memo:
    """Values of distinct words, kept by word hash from block to block of one worker.

    It holds at most `size` words; when more come, it begins anew with those of the
    block at hand. Only time depends on it, never a result.
    """

    def __init__(self, make: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], size: int = 1_000_000):
        """make: words -> (values of all words in a row, how many each word has)."""
        self.make, self.size = make, size
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int64)
        self.values: np.ndarray | None = None

    def __call__(self, buf: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(values of the block's words in a row, how many each word has)."""
        distinct, one, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new) or self.values is None:
            if len(self.keys) + len(new) > self.size:
                self.keys, self.at, self.lens, self.values = self.keys[:0], self.at[:0], self.lens[:0], None
                new = np.arange(len(distinct))
            values, lens = self.make(strings(buf, words.starts[one[new]], words.ends[one[new]]))
            base = 0 if self.values is None else len(self.values)
            at = base + np.cumsum(lens) - lens
            self.values = values if self.values is None else np.concatenate([self.values, values])
            keys = np.concatenate([self.keys, distinct[new]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.at = np.concatenate([self.at, at])[order]
            self.lens = np.concatenate([self.lens, lens])[order]
            place = np.searchsorted(self.keys, distinct)
        place = place[which]
        lens = self.lens[place]
        return self.values[ragged(self.at[place], lens)], lens

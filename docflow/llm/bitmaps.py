"""Compressed bitmaps of document places 0 .. 65,535, many at a time.

A bitmap of at most SPARSE places is its places in order, two bytes each; a fuller one is
PLACES bits, eight places a byte, the lowest bit first. Its length in bytes tells which.
"""

from __future__ import annotations

import numpy as np

from docflow.llm import words as w

PLACES = 1 << 16
DENSE = PLACES // 8  # bytes
SPARSE = DENSE // 2 - 1  # places; a list of them is shorter than DENSE


def packed(places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps as bytes in a row, and the length of each, of lists of ascending places in a
    row with `counts` places each."""
    full = counts > SPARSE
    lens = np.where(full, DENSE, 2 * counts)
    flat = places.astype("<u2")
    if not full.any():
        return flat.view(np.uint8), lens
    ends = np.cumsum(counts)
    out, at = [], 0
    for i in np.flatnonzero(full).tolist():
        begin, end = int(ends[i] - counts[i]), int(ends[i])
        bits = np.zeros(PLACES, np.uint8)
        bits[places[begin:end]] = 1
        out += [flat[at:begin].view(np.uint8), np.packbits(bits, bitorder="little")]
        at = end
    return np.concatenate([*out, flat[at:].view(np.uint8)]), lens


def places_of(data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of every place of the bitmaps that stand in `data` in a row."""
    full = lens == DENSE
    starts = np.cumsum(lens) - lens
    short = np.flatnonzero(~full)
    if len(short) == len(lens):
        return np.repeat(short, lens // 2), data.view("<u2").astype(np.int64)
    raw = data[w.ragged(starts[short], lens[short])]
    owner, place = [np.repeat(short, lens[short] // 2)], [raw.view("<u2").astype(np.int64)]
    for i in np.flatnonzero(full).tolist():
        bits = np.unpackbits(data[starts[i] : starts[i] + DENSE], bitorder="little")
        place.append(np.flatnonzero(bits))
        owner.append(np.full(len(place[-1]), i))
    return np.concatenate(owner), np.concatenate(place)


def popcounts(data: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """How many places each bitmap holds."""
    counts = lens // 2
    starts = np.cumsum(lens) - lens
    for i in np.flatnonzero(lens == DENSE).tolist():
        counts[i] = np.bitwise_count(data[starts[i] : starts[i] + DENSE]).sum()
    return counts


def merged(key: np.ndarray, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps of equal key ORed together: the keys in order, their bitmaps and lengths."""
    owner, place = places_of(data, lens)
    distinct, group = np.unique(key, return_inverse=True)
    both = np.sort(group[owner] * PLACES + place)
    both = both[np.append(both[1:] != both[:-1], True)] if len(both) else both
    counts = np.bincount(both // PLACES, minlength=len(distinct))
    return distinct, *packed(both % PLACES, counts)

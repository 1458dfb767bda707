"""Operator 8: SentencePiece merges with seeded dropout, and back again.

Encoding keeps an agenda of candidate merges (neighbouring parts whose joint text is a
piece), the best score first, the leftmost of equal ones. A candidate taken from the agenda
is skipped when a hash of (seed, document id, unit, its place in the document, place in
the unit, sizes) falls below the dropout rate; so every occurrence of a word is segmented on
its own, always with pieces of the vocabulary, and the same way on every run, machine and
retry. Rate 0 gives the tokenizer's own ids.

Workers remember only what no hash decides: the ids and merges of a unit when none is
skipped. An occurrence whose hashes skip none of these merges has that result; one that skips
some is merged under its own hashes.

Decoding joins the pieces' bytes. A U+2581 in a text itself is written as bytes, so that
every text comes back as it was.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import documents, widened
from docflow.llm.pieces import SIGN, Vocabulary, units, vocabulary

MODEL = "piece_bpe_32k.model"
DRAWS = 1 << 64  # keys that the occurrences of a unit can have under one seed: all there are
RATE = 0.1
SEED = 20
SHORT = 48  # characters of a unit up to which units are merged together
DECODED = 200_000  # ids decoded at a time
TOGETHER = 2048  # units merged together, which bounds the memory
AT_ONCE = 1 << 17  # units looked up at a time
REMEMBERED = 600_000  # units remembered
MERGE = 1 << 60  # marks a merge among ids: place, left size << 16, right size << 32
ALONE = 1 << 59  # in place of ids and merges: a unit that is always merged by itself


def _mixed(x: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash that decides on the merge at `place` of parts with these sizes, under keys x."""
    n = [np.asarray(v).astype(np.uint64) for v in (place, left, right)]
    return w.mix(x + n[0] * np.uint64(0x9E3779B97F4A7C15) + n[1] * np.uint64(0xC2B2AE3D27D4EB4F) + n[2] * np.uint64(0x165667B19E3779F9))


def skips(key: int, rate: float) -> Callable[[int, int, int], bool]:
    """Whether the merge of the parts at `place` with these sizes is dropped, under a key; as _mixed."""
    limit, bits = int(rate * 2.0**64), (1 << 64) - 1

    def skip(place: int, left: int, right: int) -> bool:
        x = (key + place * 0x9E3779B97F4A7C15 + left * 0xC2B2AE3D27D4EB4F + right * 0x165667B19E3779F9) & bits
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & bits
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & bits
        return (x ^ (x >> 31)) < limit

    return skip


Drop = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def hashed(keys: np.ndarray, rate: float) -> Drop:
    """(row, place, left, right) -> which merges are dropped under the rows' keys."""
    limit = np.uint64(int(rate * 2.0**64))
    return lambda row, place, left, right: _mixed(keys[row], place, left, right) < limit


def merge(unit: str, words: Vocabulary, skip: Callable[[int, int, int], bool] | None = None) -> list[int]:
    """Ids of one unit of any length whose spaces are written as SIGN: the agenda is a heap."""
    pieces, n = words.pieces, len(unit)
    size, before, after = [1] * n, list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[float, int, int, int]] = []

    def propose(a: int) -> None:
        b = after[a]
        if b < n:
            found = pieces.get(unit[a : b + size[b]])
            if found is not None:
                heapq.heappush(agenda, (-found[1], a, size[a], size[b]))

    for a in range(n - 1):
        propose(a)
    while agenda:
        _, a, left, right = heapq.heappop(agenda)
        b = after[a]
        if size[a] != left or b >= n or size[b] != right or (skip is not None and skip(a, left, right)):
            continue
        size[a], size[b] = left + right, 0
        after[a] = after[b]
        if after[b] < n:
            before[after[b]] = a
        if before[a] >= 0:
            propose(before[a])
        propose(a)
    out: list[int] = []
    a = 0
    while a < n:
        part = unit[a : a + size[a]]
        found = pieces.get(part)
        out.extend([found[0]] if found is not None else [words.byte_ids[x] for x in part.encode()])
        a = after[a]
    return out


@dataclass(frozen=True)
class Pairs:
    """Parts as numbers: pieces by id, then characters that only occur within pieces, then
    `other` for any other character. Pairs of parts that make a piece: key, piece, cost."""

    width: int
    other: int
    character: np.ndarray
    key: np.ndarray
    piece: np.ndarray
    cost: np.ndarray


@cache
def pairs_of(path: str) -> Pairs:
    words = vocabulary(path)
    number = {piece: i for piece, (i, _) in words.pieces.items()}
    width = len(words.texts)
    for c in sorted({c for piece in words.pieces for c in piece}):
        if c not in number:
            number[c] = width
            width += 1
    other, width = width, width + 1
    character = np.full(0x110000, other, np.int64)
    for part, i in number.items():
        if len(part) == 1:
            character[ord(part)] = i
    rows = []
    for piece, (i, score) in words.pieces.items():
        for cut in range(1, len(piece)):
            left, right = number.get(piece[:cut]), number.get(piece[cut:])
            if left is not None and right is not None:
                rows.append((left * width + right, i, -score))
    rows.sort()
    key, piece, cost = zip(*rows, strict=True)
    return Pairs(width, other, character, np.array(key, np.int64), np.array(piece, np.int64), np.array(cost))


def merge_together(
    codes: np.ndarray, sizes: np.ndarray, pairs: Pairs, drop: Drop | None = None, log: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Merge units of at most SHORT characters, a row each, one merge of each row at a time.

    codes: code points by (unit, place), any value past a unit's size. log: gets the merges
    made as (rows, merges). Returns the parts by (unit, place of the first character), and how
    many characters each has, 0 where no part begins.
    """
    n, width = codes.shape
    places = np.arange(width)
    limit = np.arange(n) * width + sizes  # where each row's characters end
    part = np.append(np.where(places < sizes[:, None], pairs.character[codes], pairs.other), pairs.other)
    chars = np.append((places < sizes[:, None]).astype(np.int64), 0)
    after, before = np.arange(1, n * width + 2), np.arange(-1, n * width)
    made = np.zeros(n * width, np.int64)
    cost = np.full((n, width), np.inf)
    flat = cost.reshape(-1)

    def evaluate(row: np.ndarray, at: np.ndarray) -> None:
        """Set cost and piece of the pairs that begin at these places; no cost: not a candidate."""
        key = part[at] * pairs.width + part[after[at]]
        found = np.minimum(np.searchsorted(pairs.key, key), len(pairs.key) - 1)
        good = (pairs.key[found] == key) & (after[at] < limit[row])
        if drop is not None:
            some = np.flatnonzero(good)
            r, a = row[some], at[some]
            good[some] = ~drop(r, a - r * width, chars[a], chars[after[a]])
        flat[at] = np.where(good, pairs.cost[found], np.inf)
        made[at] = pairs.piece[found]

    row, place = np.nonzero(places < sizes[:, None] - 1)
    evaluate(row, row * width + place)
    alive = np.arange(n)
    while len(alive):
        place = cost[alive].argmin(axis=1)  # of equal costs the leftmost
        at = alive * width + place
        going = flat[at] < np.inf
        alive, place, at = alive[going], place[going], at[going]
        other = after[at]
        if log is not None:
            log.append((alive, MERGE | place | chars[at] << 16 | chars[other] << 32))
        part[at] = made[at]
        chars[at] += chars[other]
        chars[other], flat[other] = 0, np.inf
        after[at] = following = after[other]
        inner = following < limit[alive]
        before[following[inner]] = at[inner]
        left = place > 0
        evaluate(np.concatenate([alive, alive[left]]), np.concatenate([at, before[at[left]]]))
    return part[:-1].reshape(n, width), chars[:-1].reshape(n, width)


def encode_units(
    found: list[bytes], path: str, rate: float, keys: np.ndarray, log: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all units in a row, how many each has). A U+2581 of the text is a part of its own
    that merges with nothing.

    log: gets the merges made at rate 0, as (units, merges); ALONE for units that are merged
    by themselves.
    """
    words, pairs = vocabulary(path), pairs_of(path)
    texts = [raw.decode("utf-8", "replace") for raw in found]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    alone = (size > SHORT) | np.fromiter((SIGN in t for t in texts), bool, len(texts))
    lens = np.zeros(len(texts), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # units, their ids in a row
    for i in np.flatnonzero(alone).tolist():
        skip = skips(int(keys[i]), rate) if rate > 0 else None
        ids: list[int] = []
        if log is None:
            for k, part in enumerate(texts[i].split(SIGN)):
                ids += [words.byte_ids[x] for x in SIGN.encode()] if k else []
                ids += merge(part.replace(" ", SIGN), words, skip) if part else []
        lens[i] = len(ids)
        parts.append((np.array([i]), np.array(ids, np.int64)))
    if log is not None:
        log.append((np.flatnonzero(alone), np.full(int(alone.sum()), ALONE)))
    groups, low = [], 1
    for high in (4, 6, 8, 10, 12, 16, 24, SHORT):
        rows = np.flatnonzero(~alone & (size >= low) & (size <= high))
        groups += [(high, rows[k : k + TOGETHER]) for k in range(0, len(rows), TOGETHER)]
        low = high + 1
    known = len(words.texts)
    for high, rows in groups:
        joined = "".join([texts[i] for i in rows.tolist()]).replace(" ", SIGN)
        codes = np.zeros((len(rows), high), np.int64)
        codes[np.arange(high) < size[rows][:, None]] = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        made: list | None = [] if log is not None else None
        part, chars = merge_together(codes, size[rows], pairs, hashed(keys[rows], rate) if rate > 0 else None, made)
        if log is not None:
            log += [(rows[r], merges) for r, merges in made]
        begins = chars > 0
        ids, count = part[begins], begins.sum(axis=1)
        strange = np.flatnonzero(ids >= known)  # characters that are no piece, a part each
        if len(strange):
            letters, which = np.unique(codes[begins][strange], return_inverse=True)
            spelt = [[words.byte_ids[x] for x in chr(c).encode()] for c in letters.tolist()]
            n = np.array([len(x) for x in spelt], np.int64)
            each = np.ones(len(ids), np.int64)
            each[strange] = n[which]
            owner = np.repeat(np.repeat(np.arange(len(rows)), count), each)
            wide = np.repeat(ids, each)
            wide[w.ragged((np.cumsum(each) - each)[strange], n[which])] = np.concatenate(spelt)[w.ragged((np.cumsum(n) - n)[which], n[which])]
            ids, count = wide, np.bincount(owner, minlength=len(rows))
        lens[rows] = count
        parts.append((rows, ids))
    out, starts = np.zeros(int(lens.sum()), np.int32), np.cumsum(lens) - lens
    for rows, ids in parts:
        out[w.ragged(starts[rows], lens[rows])] = ids
    return out, lens


def remembered(found: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """What the memo holds of units: (the ids at rate 0 and then the merges made, in order, of all
    units in a row, how many each has)."""
    log: list[tuple[np.ndarray, np.ndarray]] = []
    ids, lens = encode_units(found, path, 0.0, np.zeros(0, np.uint64), log)
    total = lens + np.bincount(np.concatenate([r for r, _ in log]), minlength=len(found))
    place = np.cumsum(total) - total
    out = np.empty(int(total.sum()), np.int64)
    out[w.ragged(place, lens)] = ids
    place += lens
    for unit, merges in log:  # a unit is in one row of the log at most
        out[place[unit]] = merges
        place[unit] += 1
    return out, total


class Occurrences:
    """Ids of units that each have a key of their own. The memo saves time and decides nothing."""

    def __init__(self, path: str, rate: float):
        self.path, self.rate = path, rate
        self.memo = w.Memo(lambda found: remembered(found, path), REMEMBERED)

    def __call__(self, buf: np.ndarray, found: w.Words, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in a row, how many each has)."""
        parts = []
        for k in range(0, len(keys), AT_ONCE):
            a, b = found.starts[k : k + AT_ONCE], found.ends[k : k + AT_ONCE]
            parts.append(self._some(buf, w.Words(a, b, found.counts, found.offs, found.hashes[k : k + AT_ONCE]), keys[k : k + AT_ONCE]))
        ids, lens = zip(*parts, strict=True) if parts else ([np.zeros(0, np.int32)], [np.zeros(0, np.int64)])
        return np.concatenate(ids), np.concatenate(lens)

    def _some(self, buf: np.ndarray, found: w.Words, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values, lens = self.memo(buf, found)
        owner = np.repeat(np.arange(len(keys)), lens)
        again = np.zeros(len(keys), bool)
        again[owner[values == ALONE]] = True
        merges = np.flatnonzero(values >= MERGE)
        x, row = values[merges], owner[merges]
        again[row[hashed(keys, self.rate)(row, x & 0xFFFF, x >> 16 & 0xFFFF, x >> 32 & 0xFFFF)]] = True
        mine = (values < ALONE) & ~again[owner]
        rest = np.flatnonzero(again)
        other, each = encode_units(w.strings(buf, found.starts[rest], found.ends[rest]), self.path, self.rate, keys[rest])
        count = np.bincount(owner[mine], minlength=len(keys))
        count[rest] = each
        out, starts = np.empty(int(count.sum()), np.int32), np.cumsum(count) - count
        plain = np.flatnonzero(~again)
        out[w.ragged(starts[plain], count[plain])] = values[mine]
        out[w.ragged(starts[rest], each)] = other
        return out, count


def encode(
    docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED, draws: int = DRAWS, key: str = "doc_id",
    text: str = "text", column: str = "ids", without: tuple[str, ...] = (),
) -> DataFrame:
    """docs with the ids of each text; null and empty texts have none.

    draws: how many keys the occurrences of a unit can have under one seed; by default each
    has its own. Repeated rows are encoded alike; a null key counts as a key. Rows pass in
    place.
    """
    if not 0 <= rate < 1 or not 1 <= draws <= DRAWS:
        raise ValueError("rate is 0 or more and below 1, draws 1 or more")
    draw = F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    makers: list[Occurrences] = []

    def rows(batch: pa.RecordBatch) -> list:
        if not makers:
            makers.append(Occurrences(path, rate))
        own = np.array(batch.column("__draw")).view(np.uint64)
        flat, lens = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for block in w.blocks(batch.column(text)):
            buf, found = units(block)
            place = (np.arange(len(found.starts)) - np.repeat(found.offs[:-1], found.counts)).astype(np.uint64)
            keys = w.mix(np.repeat(own[block.first : block.last], found.counts) + place * np.uint64(0x9E3779B97F4A7C15))
            if draws < DRAWS:
                keys %= np.uint64(draws)
            keys = w.mix(keys + found.hashes ^ np.uint64(seed % (1 << 64)))
            ids, each = makers[0](buf, found, keys)
            flat.append(ids)
            lens.append(w.per_text(each, found.offs))
        offsets = np.cumsum(np.concatenate(lens))
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(flat), pa.int32()))]

    tagged = docs.withColumn("__draw", draw)
    return widened(tagged, [(column, "array<int>")], rows, (*without, "__draw"))


def decode_ids(ids: np.ndarray, lens: np.ndarray, words: Vocabulary) -> list[bytes]:
    """The texts that ids, `lens` of them for each text, stand for; some texts at a time."""
    sizes = np.array([len(x) for x in words.texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    table = np.frombuffer(b"".join(words.texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    out: list[bytes] = []
    first = 0
    while first < len(lens):
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + DECODED, side="right")) - 1)
        part = ids[offs[first] : offs[last]]
        each = sizes[part]
        raw = table[w.ragged(begin[part], each)].tobytes()
        ends = np.cumsum(w.per_text(each, offs[first : last + 1] - offs[first])).tolist()
        # without the space in front
        out += [raw[a + 1 : b] if b > a else b"" for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        first = last
    return out


def decode(rows: DataFrame, path: str, ids: str = "ids", column: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """rows with the text of their ids; null or no ids: the empty text."""

    def of(batch: pa.RecordBatch) -> list:
        lists = batch.column(ids)
        lens = np.array(lists.value_lengths().fill_null(0))
        texts = decode_ids(np.array(lists.flatten()), lens, vocabulary(path))
        return [pa.array([x.decode("utf-8", "replace") for x in texts], pa.string())]

    return widened(rows, [(column, "string")], of, without)


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with dropout: number and checksum of ids, and the hash of what they decode to."""
    path = public_tokenizers.path(MODEL)
    coded = encode(documents(spark, sf_dir).select("doc_id", "text"), path, without=("text",))

    def digest(batch: pa.RecordBatch) -> list:
        lists = batch.column("ids")
        lens = np.array(lists.value_lengths())
        flat = np.array(lists.flatten()).astype("<u4")
        raw, ends = flat.tobytes(), (4 * np.cumsum(lens)).tolist()
        crcs = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        shas = [hashlib.sha256(t).hexdigest() for t in decode_ids(flat, lens, vocabulary(path))]
        return [pa.array(lens, pa.int64()), pa.array(crcs, pa.int64()), pa.array(shas, pa.string())]

    fields = [("n_tokens", "long"), ("ids_crc32", "long"), ("decoded_sha256", "string")]
    return widened(coded, fields, digest, without=("ids",))

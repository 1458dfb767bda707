"""Operator 2: documents packed into sequences of a fixed capacity by bin completion.

Documents are tokenised, closed by an end token and cut into pieces of at most `capacity`
tokens. How pieces are packed depends only on how many there are of each length, at most
`capacity` numbers whatever the corpus. From these the driver makes a plan of sequence
patterns with multiplicities; each piece, ranked among those of its length by Spark, then
looks its sequence and offset up. Nothing of the corpus but the length counts reaches the
driver.

The plan: best fit on falling lengths gives the first incumbent. While it has more
sequences than the lower bound, bin completion branches: the longest piece left is joined
with each undominated filling of the rest of its sequence (as many such sequences at once
as the counts allow), best-filled first; a branch is cut when the waste it has made leaves
no room for fewer sequences than the incumbent; best fit completes each node and its result
may become the incumbent. The search ends when the bound is met or after NODES nodes; the
incumbent is a whole, valid packing in either case.
"""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import Batches, documents, ranked, saved

CAPACITY = 2048
END = 0
TOKENIZER = "word_bpe_49k.json"
NODES = 60
FILLINGS = 6  # branches of a node
LARGEST_FILLING = 4  # pieces that join the longest one in a branch; best fit adds the rest


# ---- tokens and pieces


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed public tokenizer of this name lies."""
    return public_tokenizers.path(name)


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode_words(found: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    texts = [x.decode("utf-8", "replace") for x in found]
    ids = [x.ids for x in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]
    lens = np.array([len(x) for x in ids], np.int64)
    return np.fromiter((i for x in ids for i in x), np.uint32, int(lens.sum())), lens


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of each document, with their ids on demand.

    The tokenizer at `path` drops white space, so words are encoded one by one and each
    distinct word once per worker. A null or empty text is the end token alone. Repeated
    rows give pieces each; null ids stay null.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = schema.replace("doc_id long", f"doc_id {kind}")

    def run(batches: Batches) -> Batches:
        memo = _memo(path)
        for batch in batches:
            for block in w.blocks(batch.column("text")):
                words = w.split_words(block)
                flat, each = memo(block.buf, words)
                sizes = w.per_text(each, words.offs)
                whole = np.full(len(flat) + block.n, end, "<u4")
                last = np.cumsum(sizes + 1)
                body = np.ones(len(whole), bool)
                body[last - 1] = False
                whole[body] = flat
                parts = (sizes + capacity) // capacity  # of sizes + 1 tokens
                row = np.repeat(np.arange(block.n), parts)
                piece = w.ragged(np.zeros(block.n, np.int64), parts)
                start = piece * capacity
                length = np.minimum((sizes + 1)[row] - start, capacity)
                at = (last - sizes - 1)[row] + start
                raw = whole.tobytes()
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                columns = [
                    batch.column("doc_id").slice(block.first, block.n).take(pa.array(row)),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crcs, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(at, len(whole)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(whole.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@cache
def _memo(path: str) -> w.Memo:
    return w.Memo(lambda found: _encode_words(found, path))


# ---- the plan


@dataclass
class Group:
    """`count` sequences of one pattern: (length, how many side by side) in order."""

    pattern: tuple[tuple[int, int], ...]
    count: int
    left: int


@dataclass
class Plan:
    groups: list[Group] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(g.count for g in self.groups)


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best fit on falling lengths, counts[length] pieces of each, all alike at once.

    A step either uses up a length or fills up a group, so groups number at most a few for
    each length: the plan's size has a bound that depends on capacity alone.
    """
    room: dict[int, list[Group]] = {}
    lefts = np.zeros(capacity + 1, np.int64)  # groups by what is left
    done: list[Group] = []

    def put(group: Group) -> None:
        if group.left:
            room.setdefault(group.left, []).append(group)
            lefts[group.left] += 1
        else:
            done.append(group)

    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            open_ = np.flatnonzero(lefts[length:])
            if len(open_):
                left = length + int(open_[0])
                group = room[left].pop()
                lefts[left] -= 1
            else:
                left = capacity
                group = Group((), n, capacity)
            fits = left // length
            full = min(group.count, n // fits)
            if full:
                put(Group((*group.pattern, (length, fits)), full, left - fits * length))
            n -= full * fits
            rest = group.count - full
            if rest and n and n < fits:
                put(Group((*group.pattern, (length, n)), 1, left - n * length))
                n, rest = 0, rest - 1
            if rest and group.pattern:
                put(Group(group.pattern, rest, left))
    return Plan([*done, *(g for gs in room.values() for g in gs)])


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer sequences: total length, and pieces that cannot share (all thresholds)."""
    size = np.arange(capacity + 1)
    number, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * size)])
    k = np.arange(capacity // 2 + 1)  # pieces shorter than k are left out
    large = number[-1] - number[capacity - k + 1]
    half = capacity // 2
    above = np.maximum(capacity - k, half)
    middle_n, middle = number[above + 1] - number[half + 1], total[above + 1] - total[half + 1]
    small = total[half + 1] - total[np.minimum(k, half + 1)]
    free = middle_n * capacity - middle
    more = np.maximum(0, -(-(small - free) // capacity))
    return int(max((large + middle_n + more).max(), -(-int(total[-1]) // capacity)))


def fillings(counts: np.ndarray, first: int, capacity: int) -> list[tuple[int, ...]]:
    """Some undominated fillings beside a piece of length `first`, the fullest first.

    A filling is dominated if a piece not in it could take the place of one or two of its
    pieces and leave no more waste.
    """
    left = capacity - first
    lengths = np.flatnonzero(counts[: left + 1])[::-1].tolist()
    found: list[tuple[int, tuple[int, ...]]] = []

    def extend(have: tuple[int, ...], room: int, begin: int) -> None:
        if len(found) >= 40 * FILLINGS:
            return
        grew = False
        for i in range(begin, len(lengths)):
            x = lengths[i]
            if x > room or counts[x] - have.count(x) - (x == first) <= 0:
                continue
            grew = True
            if len(have) < LARGEST_FILLING:
                extend((*have, x), room - x, i)
            if len(have) >= 1:
                break  # below the first level only the largest that fits, which leaves out some undominated fillings
        if have and (not grew or len(have) == LARGEST_FILLING):
            found.append((room, have))

    extend((), left, 0)
    spare = set(lengths)

    def dominated(room: int, have: tuple[int, ...]) -> bool:
        sums = {*have, *(a + b for i, a in enumerate(have) for b in have[i + 1 :])}
        return any(x in spare and x not in have and counts[x] > 0 for s in sums for x in range(s + 1, min(s + room, left) + 1))

    keep = [(room, have) for room, have in sorted(set(found)) if not dominated(room, have)]
    return [have for _, have in (keep or sorted(set(found)))[:FILLINGS]] or [()]


def bin_completion(counts: np.ndarray, capacity: int, nodes: int = NODES) -> Plan:
    """The best packing found, starting from best fit (see the module's text)."""
    incumbent = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    total = int((counts * np.arange(capacity + 1)).sum())
    stack = [(counts.astype(np.int64), [], 0)]
    while stack and nodes and incumbent.sequences > bound:
        nodes -= 1
        rest, made, waste = stack.pop()
        allowed = (incumbent.sequences - 1) * capacity - total
        if waste > allowed or not rest.any():
            continue
        used = sum(g.count for g in made)
        if used + lower_bound(rest, capacity) >= incumbent.sequences:
            continue
        first = int(np.flatnonzero(rest)[-1])
        branches = []
        for filling in fillings(rest, first, capacity):
            need = np.zeros_like(rest)
            for x in (first, *filling):
                need[x] += 1
            some = need > 0
            times = int((rest[some] // need[some]).min())
            left = capacity - first - sum(filling)
            pattern = tuple((x, int(need[x])) for x in np.flatnonzero(need)[::-1].tolist())
            after, now = rest - times * need, [*made, Group(pattern, times, left)]
            tail = best_fit(after, capacity)
            if used + times + tail.sequences < incumbent.sequences:
                incumbent = Plan([*now, *tail.groups])
            branches.append((after, now, waste + times * left))
        stack.extend(reversed(branches))
    return incumbent


def placements(plan: Plan, first_sequence: int) -> tuple[np.ndarray, ...]:
    """Runs of ranks: (length, first rank, pieces side by side, first sequence, offset), by length and rank."""
    taken: dict[int, int] = {}
    rows = []
    sequence = first_sequence
    for group in plan.groups:
        offset = 0
        for length, side in group.pattern:
            rank = taken.get(length, 0)
            rows.append((length, rank, side, sequence, offset))
            taken[length] = rank + group.count * side
            offset += length * side
        sequence += group.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(table.T)


# ---- the operator


def pack(cut: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Pieces (doc_id, piece, length, ...) with sequence_id and offset; none is lost or cut.

    `cut` is read twice: give it as a written table. Sequences are numbered from 0 and
    filled from offset 0 without gaps. No pieces, no rows.
    """
    found = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["n"]
    whole = int(counts[capacity])
    counts[capacity] = 0  # these fill a sequence each
    length_, rank_, side_, sequence_, offset_ = placements(bin_completion(counts, capacity, nodes), whole)
    key_ = (length_ << 44) | rank_

    def place(batches: Batches) -> Batches:
        for batch in batches:
            length, rank = np.array(batch.column("length")), np.array(batch.column("__rank"))
            sequence, offset = rank.copy(), np.zeros(len(rank), np.int64)
            some = np.flatnonzero(length < capacity)
            at = np.searchsorted(key_, (length[some] << 44) | rank[some], side="right") - 1
            past = rank[some] - rank_[at]
            sequence[some] = sequence_[at] + past // side_[at]
            offset[some] = offset_[at] + past % side_[at] * length[some]
            names = [n for n in batch.schema.names if n != "__rank"]
            arrays = [*(batch.column(n) for n in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])

    spread = cut.withColumn("__spread", F.xxhash64("doc_id", "piece"))
    numbered = ranked(spread, ["length"], ["doc_id", "piece"], "__spread", "__rank").select(*cut.columns, "__rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from packed pieces with ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(inside["ids"]).alias("ids"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack; the pieces are written to the shared folder once."""
    return pack(saved(pieces(docs, path, capacity), "pieces"), capacity)


def op2_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in as few sequences as found."""
    return pack_documents(documents(spark, sf_dir), tokenizer_path())

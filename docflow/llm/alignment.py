"""Operator 13: alignment of two tokenizers over a corpus.

A text is cut by a byte-level BPE (A, a space in front) and by a SentencePiece model (B,
which adds that space). Tokens of the two link where their byte ranges overlap; offsets
where tokens of both end cut a text into groups. How many documents hold a pair of ids
linked is its count, and the partners of an id are ranked by it.

Inverted bitmaps. Documents are numbered within chunks of at most PLACES documents. For each
pair and chunk there is a compressed bitmap of the documents that hold the pair, and, for
those that hold it more than once, planes: bitmaps of the bits of that number less one. The
bitmaps of the blocks of texts of a chunk are ORed together. Their population counts, summed
over chunks, are the pair's documents; planes add up to its links. Then the postings are
read the other way: every chunk gets its pairs' counts, walks their bitmaps and returns to
each document its sums.

A chunk ends after so many documents or pairs, so a task holds a bounded part; a pair that
stands in all documents has one row a chunk, and counts combine before they are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import bitmaps as b, words as w
from docflow.llm.frames import Batches, documents, saved

CHUNK_POSTINGS = 3_000_000
CHUNKS_OF_A_TASK = 24  # bits
PLANE_BITS = 6  # of a bitmap's key
_ROWS = (
    "chunk long, pair long, n_docs long, docs binary, planes binary, "
    "doc_id long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]
_EMPTY = ["n_a", "n_b", "n_groups", "n_links"]

# Characters that both splitters of A class alike beyond doubt; other texts take the slower one.
_USUAL = re.compile("[\x00-\x7f\xa0-ɏΑ-ΡΣ-ϿА-я‐-‧　-〠ぁ-ゖァ-ヺ一-龥가-힣]*")
_LONG_RUN = re.compile(r"[^\s]{2000}|\s{2000}")  # a run on which the faster one takes long


def _byte_characters() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others are moved beyond 255 in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in set(shown)]
    return {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids and bytes of its tokens.

    The file's own tokenizer and one over the same merges give the same ids; the second is
    faster and used for texts of usual characters.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = _byte_characters()
        special = {t.content for t in self.own.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        size = self.own.get_vocab_size()
        self.texts = [b""] * size
        for text, i in ranks.items():
            self.texts[i] = text
        for i, t in self.own.get_added_tokens_decoder().items():
            self.texts[i] = t.content.encode()
        self.fast = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for text in texts:
            if _USUAL.fullmatch(text) and not _LONG_RUN.search(text):
                out.append(self.fast.encode_ordinary(text))
            else:
                out.append(self.own.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        return out


# Fixed value: how byte-level BPE splits a text before merging.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Pieces:
    """Tokenizer B: ids and bytes of its tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if self.model.get_piece_size() > 1 << 16:
            raise ValueError("ids of more than two bytes")
        self.texts = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.texts.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@cache
def _tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


@dataclass
class Aligned:
    """Tokens of some texts in a row; offs_a, offs_b, offs_l are where each text's begin.

    link_a and link_b are places in ids_a and ids_b. groups_sha256 has a digest a text.
    """

    ids_a: np.ndarray
    ids_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    offs_a: np.ndarray
    offs_b: np.ndarray
    offs_l: np.ndarray
    n_groups: np.ndarray
    groups_sha256: list[str]


def _numbers(size: int) -> list[str]:
    return [f"{i}{end}" for i in range(size) for end in (",", "|", ";")]


_NUMBERS: list[str] = []


def align(texts: list[str], a: ByteLevel, pieces: Pieces) -> Aligned:
    """Tokens, links and groups of texts; those that the two do not cover alike have none."""
    global _NUMBERS
    spaced = [f" {t}" for t in texts]
    all_a, all_b = a(spaced), pieces(texts)
    for i, text in enumerate(spaced):
        raw = text.encode()
        same = len(raw) > 1 and b"".join(map(a.texts.__getitem__, all_a[i])) == raw
        if not same or b"".join(map(pieces.texts.__getitem__, all_b[i])) != raw:
            all_a[i], all_b[i] = [], []
    sides = []
    for ids, table in ((all_a, a.texts), (all_b, pieces.texts)):
        offs = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(offs[-1]))
        sides.append((flat, offs, np.cumsum(_lengths(table)[flat])))
    (ids_a, offs_a, ends_a), (ids_b, offs_b, ends_b) = sides
    # Both cover the same bytes, so between two neighbouring ends lies one token of each: a link.
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two runs in order
    ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
    link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    offs_l = np.searchsorted(link_a, offs_a)
    cut_a = np.zeros(len(ids_a), bool)
    cut_b = np.zeros(len(ids_b), bool)
    both = (ends_a[link_a] == ends) & (ends_b[link_b] == ends) if len(ends) else np.zeros(0, bool)
    cut_a[link_a[both]] = True
    cut_b[link_b[both]] = True
    n_groups = w.per_text(cut_a, offs_a)
    # Numbers of both sides by group, A before B; what follows a number tells whether a side or a group ends.
    group = np.concatenate([np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b])
    side = np.repeat([0, 1], [len(ids_a), len(ids_b)])
    order = np.argsort(2 * group + side, kind="stable")
    if len(_NUMBERS) < 3 * max(len(a.texts), len(pieces.texts)):
        _NUMBERS = _numbers(max(len(a.texts), len(pieces.texts)))
    code = 3 * np.concatenate([ids_a, ids_b]) + np.where(np.concatenate([cut_a, cut_b]), 1 + side, 0)
    words = list(map(_NUMBERS.__getitem__, code[order].tolist()))
    shas, at = [], (offs_a + offs_b).tolist()
    for begin, end in zip(at, at[1:], strict=False):
        shas.append(hashlib.sha256("".join(words[begin:end])[:-1].encode()).hexdigest() if end > begin else "")
    return Aligned(ids_a, ids_b, link_a, link_b, offs_a, offs_b, offs_l, n_groups, shas)


_LENGTHS: dict[int, np.ndarray] = {}


def _lengths(table: list[bytes]) -> np.ndarray:
    if id(table) not in _LENGTHS:
        _LENGTHS[id(table)] = np.array([len(t) for t in table], np.int64)
    return _LENGTHS[id(table)]


def _binaries(data: np.ndarray, lens: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(data))])


def _bit_rows(pair: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps of links given one by one, as (key, bytes, lengths). A key is the pair and, in
    its last bits, 0 for the documents that hold it or 1 + k for plane k of their number less one."""
    posting, number = np.unique(pair << 16 | place, return_counts=True)
    keys, places = [(posting >> 16) << PLANE_BITS], [posting & 0xFFFF]
    more, plane = number - 1, 0
    while more.any():
        some = more & 1 == 1
        keys.append(((posting[some] >> 16) << PLANE_BITS) + plane + 1)
        places.append(posting[some] & 0xFFFF)
        posting, more = posting[more > 1], more[more > 1] >> 1
        plane += 1
    key, at = np.concatenate(keys), np.concatenate(places)
    order = np.argsort(key, kind="stable")
    key, counts = np.unique(key, return_counts=True)
    return key, *b.packed(at[order], counts)


def _pair_rows(chunk: int, key: np.ndarray, data: np.ndarray, lens: np.ndarray) -> pa.RecordBatch:
    """A row a pair from the bitmaps of a chunk, whose keys are in order and each there once."""
    whole = key & ((1 << PLANE_BITS) - 1) == 0
    pair = key[whole] >> PLANE_BITS
    starts = np.cumsum(lens) - lens
    docs, rest = data[w.ragged(starts[whole], lens[whole])], data[w.ragged(starts[~whole], lens[~whole])]
    owner = np.searchsorted(pair, key[~whole] >> PLANE_BITS)
    plane = (key[~whole] & ((1 << PLANE_BITS) - 1)) - 1
    counts = b.popcounts(docs, lens[whole])
    return _rows(
        len(pair), chunk, pair=pa.array(pair), n_docs=pa.array(counts),
        docs=_binaries(docs, lens[whole]), planes=_planes(len(pair), owner, plane, rest, lens[~whole]),
    )


def _planes(n: int, owner: np.ndarray, plane: np.ndarray, data: np.ndarray, lens: np.ndarray) -> pa.Array:
    """By row its planes in a row: the plane's number, its length in pairs of bytes, its bitmap."""
    whole = lens + 4
    out = np.zeros(int(whole.sum()), np.uint8)
    at = np.cumsum(whole) - whole
    out[at] = plane
    out[at + 2] = (lens // 2) & 255
    out[at + 3] = (lens // 2) >> 8
    out[w.ragged(at + 4, lens)] = data
    return _binaries(out, np.bincount(owner, weights=whole, minlength=n).astype(np.int64))


def _each_plane(data: np.ndarray, lens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(owner, plane, bitmaps, lengths): the first planes of all rows, then the second ones, ..."""
    at, end = np.cumsum(lens) - lens, np.cumsum(lens)
    row = np.arange(len(lens))
    while True:
        left = at < end
        row, at, end = row[left], at[left], end[left]
        if len(row) == 0:
            return
        size = 2 * (data[at + 2].astype(np.int64) + 256 * data[at + 3].astype(np.int64))
        yield row, data[at].astype(np.int64), data[w.ragged(at + 4, size)], size
        at = at + 4 + size


def _rows(n: int, chunk: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"docs": pa.binary(), "planes": pa.binary(), "place": pa.int32(), "groups_sha256": pa.string()}
    arrays = [pa.array(np.full(n, chunk, np.int64)), *(columns.get(c, pa.nulls(n, kinds.get(c, pa.int64()))) for c in _NAMES[1:])]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


class _Chunk:
    """The bitmaps of a chunk's blocks so far."""

    def __init__(self, number: int):
        self.number, self.n, self.held = number, 0, 0
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, pair: np.ndarray, place: np.ndarray) -> None:
        if len(pair):
            self.blocks.append(_bit_rows(pair, place))
            self.held += len(self.blocks[-1][1]) // 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The chunk's pairs, the bitmaps of its blocks ORed."""
        if self.blocks:
            key, data, lens = b.merged(*(np.concatenate(x) for x in zip(*self.blocks, strict=True)))
            self.blocks = []
            yield _pair_rows(self.number, key, data, lens)


def _inverted(path_a: str, path_b: str, batches: Batches) -> Batches:
    """(doc_id, text) -> a row for each document, and for each pair of each chunk its bitmaps."""
    a, pieces = _tokenizers(path_a, path_b)
    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << CHUNKS_OF_A_TASK
    chunk = _Chunk(base)
    for batch in batches:
        for first in range(0, batch.num_rows, b.PLACES):
            part = batch.slice(first, b.PLACES)
            for block in w.blocks(part.column("text")):
                if chunk.n + block.n > b.PLACES or (chunk.held and chunk.held + len(block.buf) // 3 > CHUNK_POSTINGS):
                    yield from chunk.rows()
                    chunk = _Chunk(chunk.number + 1)
                out = align([block.text(i) for i in range(block.n)], a, pieces)
                n_links = np.diff(out.offs_l)
                place = chunk.n + np.arange(block.n)
                chunk.add(out.ids_a[out.link_a] << 16 | out.ids_b[out.link_b], np.repeat(place, n_links))
                chunk.n += block.n
                numbers = [np.diff(out.offs_a), np.diff(out.offs_b), out.n_groups, n_links]
                columns = {c: pa.array(x.astype(np.int64)) for c, x in zip(_EMPTY, numbers, strict=True)}
                columns["doc_id"] = part.column("doc_id").slice(block.first, block.n)
                columns["place"] = pa.array(place, pa.int32())
                yield _rows(block.n, chunk.number, groups_sha256=pa.array(out.groups_sha256, pa.string()), **columns)
    yield from chunk.rows()


def _returned(batches: Batches) -> Batches:
    """Rows of chunks in order, a chunk's pairs before its documents -> documents with n_best and
    count_sum. Only the sums of the current chunk are kept from batch to batch."""
    current = None
    best = total = np.zeros(0, np.int64)
    names = ["doc_id", *_EMPTY, "n_best", "count_sum", "groups_sha256"]
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]])) if len(chunks) else []
        for begin, end in zip(cuts, [*cuts[1:], len(chunks)], strict=True):
            part = batch.slice(int(begin), int(end - begin))
            if chunks[begin] != current:
                current, best, total = chunks[begin], np.zeros(b.PLACES, np.int64), np.zeros(b.PLACES, np.int64)
            is_pair = part.column("pair").is_valid()
            pairs = part.filter(is_pair)
            if pairs.num_rows:
                _walk(pairs, best, total)
            docs = part.filter(pc.invert(is_pair))
            if docs.num_rows:
                place = docs.column("place").to_numpy()
                sums = {"n_best": pa.array(best[place]), "count_sum": pa.array(total[place])}
                yield pa.RecordBatch.from_arrays([sums.get(n, docs.column(n) if n not in sums else None) for n in names], names=names)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and lengths of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], np.diff(offs)


def _walk(pairs: pa.RecordBatch, best: np.ndarray, total: np.ndarray) -> None:
    """Add to each place, for every link of a pair that its document holds, the pair's count."""
    count, top = pairs.column("count").to_numpy(), pairs.column("is_best").to_numpy(zero_copy_only=False).astype(bool)

    def add(row: np.ndarray, data: np.ndarray, lens: np.ndarray, links: np.ndarray) -> None:
        owner, place = b.places_of(data, lens)
        rows = row[owner]
        np.add.at(total, place, links[owner] * count[rows])
        some = top[rows]
        np.add.at(best, place[some], links[owner][some])

    every = np.arange(pairs.num_rows)
    add(every, *_flat(pairs.column("docs")), np.ones(len(every), np.int64))
    for row, plane, data, lens in _each_plane(*_flat(pairs.column("planes"))):
        add(row, data, lens, np.int64(1) << plane)


def inverted(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The index over docs, to be saved: a row of each document and the bitmaps of each pair and chunk."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: _inverted(path_a, path_b, batches), _ROWS)


def _link_count(batches: Batches) -> Batches:
    """(pair, n_docs, docs, planes) -> (pair, n_docs, n_links), by population counts."""
    for batch in batches:
        links = b.popcounts(*_flat(batch.column("docs")))
        docs = links.copy()
        for row, plane, data, lens in _each_plane(*_flat(batch.column("planes"))):
            links[row] += b.popcounts(data, lens) << plane
        yield pa.RecordBatch.from_arrays([batch.column("pair"), pa.array(docs), pa.array(links)], names=["pair", "n_docs", "n_links"])


def pair_counts(index: DataFrame) -> DataFrame:
    """(id_a, id_b, n_docs, n_links): in how many documents each pair is linked, and how often."""
    pairs = index.filter("pair is not null").select("pair", "docs", "planes")
    counted = pairs.mapInArrow(_link_count, "pair long, n_docs long, n_links long")
    sums = counted.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    return sums.select(F.shiftright("pair", 16).alias("id_a"), F.col("pair").bitwiseAND(0xFFFF).alias("id_b"), "n_docs", "n_links")


def aligned(index: DataFrame) -> DataFrame:
    """Each document of a saved index with n_a, n_b, n_groups, n_links, n_best (links whose pair
    has the highest count of its A id, ties included), count_sum (over links) and groups_sha256.

    Null and empty texts, and texts that the two tokenizers do not cover with the same bytes
    (a space and the text), have no tokens: zeros and an empty digest. Rows are documents of
    their own, whatever their id.
    """
    pairs = index.filter("pair is not null")
    counts = pairs.groupBy("pair").agg(F.sum("n_docs").alias("count")).withColumn("id_a", F.shiftright("pair", 16))
    counts = saved(counts, "pairs")
    tops = counts.groupBy("id_a").agg(F.max("count").alias("top"))  # a row for each id of A's vocabulary at most
    scored = counts.join(F.broadcast(tops), "id_a").select("pair", "count", (F.col("count") == F.col("top")).alias("is_best"))
    # Counts grow with the corpus: they are never broadcast, whatever their size.
    postings = pairs.select("chunk", "pair", "docs", "planes").join(scored.hint("merge"), "pair")
    both = postings.unionByName(index.filter("pair is null").drop("pair", "n_docs", "docs", "planes"), allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", F.col("pair").isNull())
    sums = ", ".join(f"{c} long" for c in ["doc_id", *_EMPTY, "n_best", "count_sum"])
    return dealt.mapInArrow(_returned, f"{sums}, groups_sha256 string")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op13_inverted_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups, links and scores of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return aligned(saved(inverted(docs, *tokenizer_paths()), "index"))

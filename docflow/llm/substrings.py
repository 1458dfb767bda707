"""Operator 6: duplicate passages by relative Lempel-Ziv parsing.

A document is factored against the documents with smaller ids: words that stand in an
earlier document in the same order, WINDOW or more of them, are duplicate spans. Such a run
holds whole windows of WINDOW words, so the reference index holds windows. A document's
windows are looked up, each alone, in place of the greedy parse; neighbouring windows whose
references lie side by side in one document are put together as one factor. A factor is
thus not the longest that could be made: another earlier document may hold a longer run.
Spans, which only ask whether a window stands in an earlier document, do not depend on that.

The index lies in blocks, one to a partition, and is never gathered. A window travels to
the block of its anchor: of its 5-word runs the one with the least hash. Neighbouring
windows mostly share the anchor, so they go as one row, each as 40 bits of its hash beside
the anchor's 64. Within a batch windows are looked up before they leave; those found in an
earlier document of the batch need no index, so of a passage that a third of all documents
share, each batch sends one copy. Windows of one anchor stream through their block in
order of document id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import Batches, documents, widened

WINDOW = 13
ANCHOR = 5
_TAG = 5  # bytes of a window's hash that travel
_FACTOR = "doc_id long, first int, windows int, ref_doc long, ref_first int"


def _runs(block: w.Block) -> tuple[np.ndarray, ...]:
    """All windows of a block: (text, place in the text, hash, anchor hash, whether a run of one anchor begins)."""
    words = w.split_words(block)
    hashes, at = w.ngrams(words, WINDOW)
    doc = words.doc[at]
    place = at - words.offs[doc]
    small, small_at = w.ngrams(words, ANCHOR)
    by_word = np.zeros(len(words.hashes) + WINDOW, np.uint64)
    by_word[small_at] = small
    least, which = by_word[at], at.copy()
    for j in range(1, WINDOW - ANCHOR + 1):
        other = by_word[at + j]
        less = other < least
        least = np.where(less, other, least)
        which[less] = at[less] + j
    new = np.ones(len(at), bool)
    new[1:] = (which[1:] != which[:-1]) | (doc[1:] != doc[:-1])
    return doc, place, hashes, least, new


def _first_of(key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each entry the index of the entry of its key with the least (doc, place)."""
    order = np.lexsort((place, doc, key))
    sorted_key = key[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return first


def _factors(doc: np.ndarray, place: np.ndarray, ref_doc: np.ndarray, ref_place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows found elsewhere, in text order, joined where window and reference move on together."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    new[1:] |= (ref_doc[1:] != ref_doc[:-1]) | (ref_place[1:] != ref_place[:-1] + 1)
    at = np.flatnonzero(new)
    return doc[at], place[at], np.diff(np.append(at, len(doc))), ref_doc[at], ref_place[at]


def _index_rows(batches: Batches) -> Batches:
    """(doc_id, text) -> rows for the index blocks, and factors found within the batch (tags null).

    A row for the index: anchor, doc_id, first (place of the run's first window), windows,
    tags. A factor: anchor is any number, and ref_doc and ref_first are set.
    """
    for batch in batches:
        ids = np.array(batch.column("doc_id"))
        found = []
        for block in w.blocks(batch.column("text")):
            doc, place, hashes, anchor, new = _runs(block)
            found.append((ids[block.first + doc], place, hashes, anchor, new))
        if not found:
            continue
        doc, place, hashes, anchor, new = (np.concatenate(x) for x in zip(*found, strict=True))
        first = _first_of(hashes, doc, place)
        known = doc[first] < doc
        some = np.flatnonzero(known)
        f = _factors(doc[some], place[some], doc[first[some]], place[first[some]])
        yield _rows(w.mix(f[0].astype(np.uint64)), f[0], f[1], f[2], None, f[3], f[4])
        send = np.flatnonzero(~known)
        if len(send) == 0:
            continue
        begins = np.ones(len(send), bool)
        begins[1:] = (np.diff(send) != 1) | new[send[1:]]
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(send)))
        tags = hashes[send].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_TAG]
        offsets = pa.array(np.append(at, len(send)) * _TAG, pa.int32())
        packed = pa.Array.from_buffers(pa.binary(), len(at), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(tags))])
        yield _rows(anchor[send[at]], doc[send[at]], place[send[at]], size, packed, None, None)


def _rows(anchor, doc, place, size, tags, ref_doc, ref_place) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor.astype(np.uint64).view(np.int64)),
            pa.array(doc, pa.int64()),
            pa.array(place, pa.int32()),
            pa.array(size, pa.int32()),
            tags if tags is not None else pa.nulls(n, pa.binary()),
            pa.array(ref_doc, pa.int64()) if ref_doc is not None else pa.nulls(n, pa.int64()),
            pa.array(ref_place, pa.int32()) if ref_place is not None else pa.nulls(n, pa.int32()),
        ],
        names=["anchor", "doc_id", "first", "windows", "tags", "ref_doc", "ref_first"],
    )


def _looked_up(batches: Batches) -> Batches:
    """Index rows in order of (anchor, doc_id) -> factors. Only the windows of the current
    anchor, each once, are kept from batch to batch."""
    held = [np.zeros(0, np.int64)] * 4  # anchor, tag, doc, place
    for batch in batches:
        passed = batch.column("tags").is_null()
        ready = batch.filter(passed)
        if ready.num_rows:
            yield _as_factors(*(np.array(ready.column(n)) for n in ("doc_id", "first", "windows", "ref_doc", "ref_first")))
        rows = batch.filter(pc.invert(passed))
        if rows.num_rows == 0:
            continue
        size = np.array(rows.column("windows"), dtype=np.int64)
        raw = np.frombuffer(b"".join(rows.column("tags").to_pylist()), np.uint8).reshape(-1, _TAG)
        tag = np.zeros((len(raw), 8), np.uint8)
        tag[:, :_TAG] = raw
        tag = tag.view("<i8")[:, 0]
        anchor = np.repeat(np.array(rows.column("anchor")), size)
        doc = np.repeat(np.array(rows.column("doc_id")), size)
        place = w.ragged(np.array(rows.column("first"), dtype=np.int64), size)
        n = len(held[0])
        anchor, tag, doc, place = (np.concatenate(x) for x in zip(held, (anchor, tag, doc, place), strict=True))
        order = np.lexsort((place, doc, tag, anchor))
        new = np.ones(len(order), bool)
        a, t = anchor[order], tag[order]
        new[1:] = (a[1:] != a[:-1]) | (t[1:] != t[:-1])
        first = np.empty(len(order), np.int64)
        first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        some = n + np.flatnonzero(doc[first[n:]] < doc[n:])
        yield _as_factors(*_factors(doc[some], place[some], doc[first[some]], place[first[some]]))
        last = order[new & (a == anchor[-1])]
        held = [anchor[last], tag[last], doc[last], place[last]]


def _as_factors(doc, first, windows, ref_doc, ref_first) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(first, pa.int32()), pa.array(windows, pa.int32()), pa.array(ref_doc, pa.int64()), pa.array(ref_first, pa.int32())],
        names=["doc_id", "first", "windows", "ref_doc", "ref_first"],
    )


def factors(docs: DataFrame) -> DataFrame:
    """(doc_id, first, windows, ref_doc, ref_first): parts of duplicate spans.

    `windows` windows of `docs` from word `first` on stand at word `ref_first` of an earlier
    document: the first of the Arrow batch that holds them, or else the first of all. So
    references, and where factors are cut, depend on the batches; the words that factors
    cover do not. A null doc_id has no order: such rows neither lose words nor
    are referred to. Rows of one doc_id count as one document.
    """
    rows = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = "anchor long, doc_id long, first int, windows int, tags binary, ref_doc long, ref_first int"
    dealt = rows.mapInArrow(_index_rows, index).repartition("anchor")
    return dealt.sortWithinPartitions("anchor", "doc_id").mapInArrow(_looked_up, _FACTOR)


def with_spans(docs: DataFrame) -> DataFrame:
    """docs with `spans`, the (first, windows) of their duplicate spans; null if there are none."""
    spans = factors(docs).groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("first", "windows")).alias("spans"))
    rows = docs.drop("spans")
    return rows.join(spans, rows["doc_id"] == spans["__id"], "left").drop("__id")


def _kept(batch: pa.RecordBatch) -> Iterator[tuple[w.Block, w.Words, np.ndarray]]:
    """By block: its words, and which of them are kept."""
    spans = batch.column("spans")
    lens = np.array(spans.value_lengths().fill_null(0))
    flat = spans.flatten()
    first, windows = (np.array(flat.field(i), dtype=np.int64) for i in (0, 1))
    row = np.repeat(np.arange(len(lens)), lens)
    for block in w.blocks(batch.column("text")):
        words = w.split_words(block)
        mine = (row >= block.first) & (row < block.last)
        r = row[mine] - block.first
        end = np.minimum(first[mine] + windows[mine] + WINDOW - 1, words.counts[r])
        begin = np.minimum(first[mine], end)
        change = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(change, words.offs[r] + begin, 1)
        np.add.at(change, words.offs[r] + end, -1)
        yield block, words, np.cumsum(change[:-1]) == 0


def _kept_digests(batch: pa.RecordBatch) -> list:
    n, removed, shas = [], [], []
    for block, words, keep in _kept(batch):
        kept = w.per_text(keep, words.offs)
        n.append(words.counts)
        removed.append(words.counts - kept)
        starts, size = words.starts[keep], (words.ends - words.starts)[keep] + 1  # and a space
        at = w.ragged(starts, size)
        raw = np.append(block.buf, np.uint8(32))[at]
        raw[np.cumsum(size) - 1] = 32
        ends = np.cumsum(w.per_text(size, np.concatenate([[0], np.cumsum(kept)]))).tolist()
        data = raw.tobytes()
        shas += [hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n, removed)]
    return [pa.array(whole[0], pa.int64()), pa.array(whole[1], pa.int64()), pa.array(shas, pa.string())]


def _kept_texts(batch: pa.RecordBatch) -> list:
    """The texts without their duplicate words and the space after those; n_removed beside."""
    texts, removed = [], []
    for block, words, keep in _kept(batch):
        gone = np.flatnonzero(~keep)
        doc = words.doc[gone]
        last = np.append(words.starts[1:], 0)[gone]
        final = gone == words.offs[doc + 1] - 1
        last = np.where(final, block.offs[doc + 1], last)
        alive = np.ones(len(block.buf), bool)
        alive[w.ragged(words.starts[gone], last - words.starts[gone])] = False
        ends = np.cumsum(w.per_text(alive, block.offs)).tolist()
        data = block.buf[alive].tobytes()
        texts += [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        removed.append(np.bincount(doc, minlength=block.n))
    return [pa.array(texts, pa.string()), pa.array(np.concatenate(removed) if removed else [], pa.int64())]


def remove(docs: DataFrame) -> DataFrame:
    """docs with duplicate spans cut out of `text`, and n_chars, if there is one, set anew.

    Documents that lose nothing stay as they are, null texts too; documents that lose all
    their words go. The first document that holds a passage keeps it.
    """
    inner = docs.select("doc_id", "text", F.struct("*").alias("__row"))
    cut = widened(with_spans(inner), [("__text", "string"), ("__removed", "long")], _kept_texts, without=("text", "spans", "doc_id"))
    text = F.when(F.col("__removed") > 0, F.col("__text")).otherwise(F.col("__row.text"))
    columns = []
    for field in docs.schema.fields:
        own = F.col("__row")[field.name]
        if field.name == "text":
            own = text
        elif field.name == "n_chars":
            own = F.when(F.col("__removed") > 0, F.char_length("__text").cast(field.dataType)).otherwise(own)
        columns.append(own.alias(field.name))
    return cut.filter((F.col("__removed") == 0) | (F.trim("__text") != "")).select(*columns)


def op6_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and duplicate words of every document, and the hash of what is kept."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    fields = [("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")]
    return widened(with_spans(docs), fields, _kept_digests, without=("text", "spans"))

"""Greedy packing of a document's pages into chunks of bounded size.

Packing is sequential inside a document: whether a page opens a chunk depends
on where the previous chunk began. It is still done in parallel, exactly:

1. A document's pages are cut into segments of ``SEGMENT_PAGES`` pages; a task
   holds the page sizes of one segment, however long the document is.
2. A segment after the first does not know how full the open chunk is when it
   begins. It becomes a function of that size, in steps: for every page that
   could open the first new chunk, how the segment would end. Only pages within
   one target's worth of bytes can, so there are few steps.
3. Functions of ``FAN`` neighbours compose to one of all of them, in ``LEVELS``
   levels. The way back gives each group, then each segment its starting state.
   No task takes all functions of a document.
4. Every segment is packed from its starting state.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docflow.operators.split import Split

SEGMENT_PAGES = 50_000
FAN = 32  # functions composed to one
LEVELS = 2  # levels of groups; the last fold of a document takes 1/FAN**LEVELS of its segments


def number_chunks(docs: DataFrame, parts: str, doc: str = "document_id") -> DataFrame:
    """One row per part of an array column with its 1-based ``chunk_no``.

    The number comes with the explode, so numbering needs no shuffle.
    """
    return docs.select(doc, F.posexplode(parts).alias("_i", "part")).select(
        doc, (F.col("_i") + 1).cast("long").alias("chunk_no"), "part"
    )


def text_pages(texts: DataFrame, doc: str, text: str = "text", sep: str = "\n") -> DataFrame:
    """Pages of a text: its separator-delimited pieces, numbered from 1."""
    pieces = texts.select(doc, F.split(F.col(text), sep).alias("_pieces"))
    return number_chunks(pieces, "_pieces", doc).select(
        doc,
        F.col("chunk_no").alias("page_no"),
        F.col("part").alias("page_text"),
        F.octet_length("part").cast("long").alias("n_bytes"),
    )


def _notable(pages: DataFrame, target_bytes: int, segment_pages: int, doc: str) -> DataFrame:
    """Documents with a page over the target or several segments; only their such pages are shuffled."""
    over = F.col("n_bytes") > target_bytes
    return (
        pages.where(over | (F.col("page_no") > segment_pages))
        .groupBy(doc)
        .agg(
            F.max("n_bytes").alias("largest_page"),
            F.count_if(over).alias("n_over_target"),
            F.max("page_no").alias("_last_page"),
        )
    )


def _fold_batches(
    batches: Iterator[pd.DataFrame], doc: str, target: int
) -> Iterator[pd.DataFrame]:
    """Number the chunks of pages that arrive sorted by document, segment and page.

    Only the open chunk's size and number are kept from batch to batch, so
    memory does not depend on how many pages a document has.
    """
    key: tuple | None = None
    size = chunk = 0
    for batch in batches:
        sizes = batch["n_bytes"].to_numpy(np.int64)
        ends = np.cumsum(sizes)
        docs, segments = batch[doc].to_numpy(), batch["_segment"].to_numpy()
        changed = np.ones(len(batch), dtype=bool)
        changed[1:] = (docs[1:] != docs[:-1]) | (segments[1:] != segments[:-1])
        starts = np.append(np.flatnonzero(changed), len(batch))
        numbers = np.empty(len(batch), dtype=np.int64)
        for first, stop in zip(starts[:-1], starts[1:], strict=True):
            if (docs[first], segments[first]) != key:
                key = (docs[first], segments[first])
                size = int(batch["_carried"].iloc[first])
                chunk = int(batch["_before"].iloc[first]) + 1
            # Byte offset at which the open chunk began.
            base = int(ends[first] - sizes[first]) - size
            at = first
            while at < stop:
                nxt = min(int(np.searchsorted(ends, base + target, side="right")), stop)
                numbers[at:nxt] = chunk
                if nxt < stop:
                    chunk += 1
                    base = int(ends[nxt - 1]) if nxt else 0
                at = nxt
            size = int(ends[stop - 1]) - base
        yield pd.DataFrame(
            {doc: docs, "page_no": batch["page_no"], "n_bytes": sizes, "chunk_no": numbers}
        )


class _Ends(NamedTuple):
    """How pages end, as a function of the size carried in, in steps of falling limit.

    A carried size takes the last step whose ``limit`` is at least that size: ``chunks``
    are opened, and the last one has ``carry`` bytes at the end. Where none is opened
    ``carry`` is what the pages add to the carried size; only the last step can be so.
    """

    limit: np.ndarray
    chunks: np.ndarray
    carry: np.ndarray

    def of(self, carried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunks opened, size of the open chunk at the end) for carried sizes."""
        step = np.searchsorted(-self.limit, -carried, side="right") - 1
        chunks = self.chunks[step]
        return chunks, np.where(chunks == 0, carried, 0) + self.carry[step]

    def then(self, other: _Ends) -> _Ends:
        """These pages and then the other's."""
        opened = self.chunks > 0
        chunks, carry = other.of(self.carry[opened])
        parts = [(self.limit[opened], self.chunks[opened] + chunks, carry)]
        for size in self.carry[~opened]:  # one at most: the other's steps, that much earlier
            in_reach = other.limit >= size
            adds = np.where(other.chunks == 0, size, 0) + other.carry
            parts.append((other.limit[in_reach] - size, other.chunks[in_reach], adds[in_reach]))
        limit, chunks, carry = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Neighbours that end alike are one step, but for the last, which may open no chunk.
        new = np.ones(len(limit), dtype=bool)
        new[1:] = (chunks[1:] != chunks[:-1]) | (carry[1:] != carry[:-1]) | (chunks[1:] == 0)
        return _Ends(limit[new], chunks[new], carry[new])

    def at_the_start(self) -> _Ends:
        """The step of an empty carried size only."""
        return _Ends(*(x[-1:] for x in self))


def _ends(sizes: np.ndarray, target: int) -> _Ends:
    """The function of a run of pages."""
    ends = np.cumsum(sizes)
    n = len(ends)
    begins = ends - sizes
    # Page i+1 opens the next chunk after one opened by page i; each round doubles the jumps.
    following = np.searchsorted(ends, begins + target, side="right")
    chunks = np.ones(n, dtype=np.int64)
    last = np.arange(n, dtype=np.int64)
    some = np.flatnonzero(following < n)
    while len(some):
        nxt = following[some]
        chunks[some] += chunks[nxt]
        last[some] = last[nxt]
        following[some] = following[nxt]
        some = some[following[some] < n]
    # Page i opens the first chunk iff carried + begins[i] <= target < carried + ends[i].
    reachable = np.flatnonzero((begins <= target) & (sizes > 0))
    limit = target - begins[reachable]
    carry = (ends[-1] - begins[last])[reachable]
    if ends[-1] > target:
        return _Ends(limit, chunks[reachable], carry)
    return _Ends(*(np.append(x, y) for x, y in zip((limit, chunks[reachable], carry), (target - ends[-1], 0, ends[-1]), strict=True)))


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Runs of equal keys of rows that arrive sorted by them, one run in memory at a time."""
    key: tuple | None = None
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        values = [batch[k].to_numpy() for k in keys]
        changed = np.ones(len(batch), dtype=bool)
        changed[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
        starts = np.append(np.flatnonzero(changed), len(batch))
        for first, stop in zip(starts[:-1], starts[1:], strict=True):
            here = tuple(v[first] for v in values)
            if here != key:
                if held:
                    yield key, pd.concat(held)
                key, held = here, []
            held.append(batch.iloc[first:stop])
    if held:
        yield key, pd.concat(held)


def _in_order(df: DataFrame, *keys: str, within: list[Column | str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *within)


def _rows(doc: str, key: object, unit: int, ends: _Ends) -> pd.DataFrame:
    return pd.DataFrame({doc: key, "_unit": unit, **ends._asdict()})


def _segment_ends(batches: Iterator[pd.DataFrame], doc: str, target: int) -> Iterator[pd.DataFrame]:
    """The functions of segments of documents with several; of a first one the step it takes."""
    several = (batch[batch["_last_segment"] > 0] for batch in batches)
    for (key, segment), pages in _runs(several, [doc, "_segment"]):
        ends = _ends(pages["n_bytes"].to_numpy(np.int64), target)
        yield _rows(doc, key, segment, ends if segment else ends.at_the_start())


def _composed(batches: Iterator[pd.DataFrame], doc: str) -> Iterator[pd.DataFrame]:
    """The functions of groups, from those of their units in order."""
    group: tuple | None = None
    whole: _Ends | None = None
    for (key, number, _), steps in _runs(batches, [doc, "_group", "_unit"]):
        ends = _Ends(*(steps[c].to_numpy(np.int64) for c in _Ends._fields))
        if (key, number) != group:
            if whole is not None:
                yield _rows(doc, *group, whole)
            group, whole = (key, number), ends
        else:
            whole = whole.then(ends)
    if whole is not None:
        yield _rows(doc, *group, whole)


def _followed(batches: Iterator[pd.DataFrame], doc: str, by: str) -> Iterator[pd.DataFrame]:
    """The starting states of the units, from that of the first of each (document, by)."""
    group: tuple | None = None
    carried = before = 0
    for (key, number, unit), steps in _runs(batches, [doc, by, "_unit"]):
        if (key, number) != group:
            group = (key, number)
            carried, before = (int(steps[c].iloc[0]) for c in ("_carried", "_before"))
        if unit:
            yield pd.DataFrame({doc: [key], "_unit": [unit], "_carried": [carried], "_before": [before]})
        ends = _Ends(*(steps[c].to_numpy(np.int64) for c in _Ends._fields))
        chunks, size = ends.of(np.array([carried]))
        carried, before = int(size[0]), before + int(chunks[0])


def _starting_states(functions: DataFrame, doc: str, levels: int, fan: int) -> DataFrame:
    """(doc, unit, carried, chunks before) of every unit but a document's first."""
    doc_type = f"`{doc}` {functions.schema[doc].dataType.simpleString()}"
    states = f"{doc_type}, _unit long, _carried long, _before long"
    order = ["_unit", F.desc("limit")]
    nothing = functions.withColumns({"_group": F.lit(0), "_carried": F.lit(0), "_before": F.lit(0)})
    if levels == 0:
        return _in_order(nothing, doc, within=order).mapInPandas(
            lambda batches: _followed(batches, doc, "_group"), states
        )
    grouped = functions.withColumn("_group", F.floor(F.col("_unit") / fan))
    groups = _in_order(grouped, doc, "_group", within=order).mapInPandas(
        lambda batches: _composed(batches, doc), f"{doc_type}, _unit long, limit long, chunks long, carry long"
    )
    begun = _starting_states(groups, doc, levels - 1, fan).withColumnRenamed("_unit", "_group")
    known = grouped.join(begun, [doc, "_group"], "left").fillna(0, ["_carried", "_before"])
    return _in_order(known, doc, "_group", within=order).mapInPandas(
        lambda batches: _followed(batches, doc, "_group"), states
    )


def pack_pages(
    pages: DataFrame,
    target_bytes: int,
    doc: str = "document_id",
    segment_pages: int = SEGMENT_PAGES,
    levels: int = LEVELS,
    fan: int = FAN,
) -> Split:
    """Assign ``chunk_no`` to every page of the packable documents.

    A page joins the open chunk while the chunk stays at or below the target,
    otherwise it opens the next one. ``valid`` is (doc, page_no, n_bytes,
    chunk_no); ``rejected`` lists documents with a page over the target. Page
    numbers count from 1. Only page sizes are moved, never page contents.
    """
    notable = _notable(pages, target_bytes, segment_pages, doc)
    rejected = notable.where(F.col("largest_page") > target_bytes).drop("_last_page")
    segment = [F.floor((F.col(c) - 1) / segment_pages) for c in ("page_no", "_last_page")]
    # One exchange, which both the functions and the states' join read.
    sized = _in_order(
        pages.select(doc, "page_no", "n_bytes")
        .join(notable.select(doc, "largest_page", "_last_page"), doc, "left")
        .where(F.coalesce("largest_page", F.lit(0)) <= target_bytes)
        .select(
            doc, "page_no", "n_bytes", segment[0].alias("_segment"),
            F.coalesce(segment[1], F.lit(0)).alias("_last_segment"),
        ),
        doc, "_segment", within=["page_no"],
    )
    doc_type = pages.schema[doc].dataType.simpleString()
    functions = sized.mapInPandas(
        lambda batches: _segment_ends(batches, doc, target_bytes),
        f"`{doc}` {doc_type}, _unit long, limit long, chunks long, carry long",
    )
    states = _starting_states(functions, doc, levels, fan).withColumnRenamed("_unit", "_segment")
    known = sized.join(states, [doc, "_segment"], "left").fillna(0, ["_carried", "_before"])
    in_order = _in_order(known, doc, "_segment", within=["page_no"])
    packed = in_order.mapInPandas(
        lambda batches: _fold_batches(batches, doc, target_bytes),
        f"`{doc}` {doc_type}, page_no long, n_bytes long, chunk_no long",
    )
    return Split(packed, rejected)


def chunk_sizes(packed: DataFrame, doc: str = "document_id") -> DataFrame:
    """First and last page, page count and bytes of every chunk."""
    return packed.groupBy(doc, "chunk_no").agg(
        F.min("page_no").alias("first_page"),
        F.max("page_no").alias("last_page"),
        F.count("*").alias("n_pages"),
        F.sum("n_bytes").alias("chunk_bytes"),
    )


def chunk_texts(
    pages: DataFrame, packed: DataFrame, doc: str = "document_id", sep: str = "\n"
) -> DataFrame:
    """Text of every chunk, its pages joined in order; bounded by the chunk target."""
    numbered = pages.join(packed.select(doc, "page_no", "chunk_no"), [doc, "page_no"])
    page = F.struct("page_no", "page_text")
    return numbered.groupBy(doc, "chunk_no").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(page)), lambda p: p["page_text"]), sep
        ).alias("chunk_text")
    )

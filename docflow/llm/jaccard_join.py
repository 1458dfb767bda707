"""Operator 5: an exact Jaccard join of documents on word shingles, by pivots.

A document's set holds its distinct 5-word shingles (A-Z lower-cased; a shorter text is one
shingle). Jaccard distance, one minus intersection over union, is a metric; documents link
at distance 1/4 or less.

Level 0. Nearly all documents are at distance 1 from one another, so cells around document
pivots alone would overlap fully. The first pivots are therefore single shingles, in one
order of all shingles, frequent ones last. A document's nearest cells are those of its
first shingles in this order; two documents that link differ in at most a quarter of
either, so a document that is copied to its first |x| - ceil(3|x|/4) + 1 cells shares one
with each that it links to. Cells with the same documents are one region, named by the
first of them. A row stays in a cell only if another of the cell may link with it by the
sizes and places of both: shingles that unlike documents share by chance, which grow faster
than the documents, are dropped where they meet.

Further levels. In a region one document is pivot and meets the others. Components of the
links found are the region's new cells. A region within one component is done: more links
could not change the result. In a region of at most LEAF documents all documents of
different cells then meet, and it is done too. In any larger one, further pivots (from its
smaller cells, eight times as many in each round) meet the documents of other cells. A
pivot has then met all it can link to in the region and leaves it. The rounds end when all
regions are done, so the components are exact.

Who meets. Documents too unlike in size, or whose shingles after the region's are too few
to link (the first shingle two documents share names a region they meet in), do not. Of
each set the shingles are counted in hash buckets, 256 or so many more that a bucket has FULL
at most on average: in fuller ones unlike documents come close by chance. Counts of two sets
are compared in the buckets of the smaller number. The distance of these counts (the sum of
absolute differences) is never above the symmetric difference, and a link allows
(|x| + |y|) / 7. In 256 buckets it is a pseudometric: boundary documents are those within the
triangle inequality's window, whose distances there to the region's first pivot differ by no
more than that. Pairs within it are compared by counts, and only those that are close there by
their texts.

Equal sets are one document throughout. Sets are compared by 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.components import components
from docflow.llm.frames import Batches, dealt, documents, forget, named, saved

SHINGLE = 5
NEAR, OF = 3, 4  # link when intersection / union >= 3/4
FREQUENT = 1 << 18  # shingles known as frequent; only the order depends on it
BUCKETS = 256
FULL = 8  # shingles a bucket on average, at most; MOST buckets, whatever the set's size
MOST = 1 << 16
ASKED = 1 << 20  # ids of documents whose texts are compared that go to all tasks: some tens of MB
LEAF = 64
WHOLE = 1 << 15  # rows of a cell that are held at once
_SET = "kind int, doc_id long, n_shingles long, set_a long, set_b long, counts binary"


def shingle_sets(block: w.Block) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = w.split_words(block, lower=True)
    hashes, at = w.ngrams(words, SHINGLE)
    first = np.searchsorted(at, words.offs)
    out = [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE)).tolist():
        mine = words.hashes[words.offs[i] : words.offs[i + 1]]
        out[i] = w.mix(np.array([len(mine)], np.uint64) ^ (mine * w.keyed(len(mine), 0x5E7)).sum(dtype=np.uint64))
    return out


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    return [s for block in w.blocks(texts) for s in shingle_sets(block)]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), size


def bucket_counts(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Of each set how many shingles are in each bucket, 255 at most. Buckets are the first bits of
    hashes, 256 or a larger power of two that goes with the set's size."""
    flat, size = _flat(sets)
    wide = np.full(len(sets), BUCKETS)
    while (more := (wide * FULL < size) & (wide < MOST)).any():
        wide[more] *= 2
    bits = np.log2(wide).astype(np.uint64)
    begin = np.cumsum(wide) - wide
    at = np.repeat(begin, size) + (flat >> np.repeat(np.uint64(64) - bits, size)).astype(np.int64)
    counts = np.minimum(np.bincount(at, minlength=int(wide.sum())), 255).astype(np.uint8)
    return np.split(counts, begin[1:]) if sets else []


def _folded(counts: np.ndarray, wide: int) -> np.ndarray:
    """Rows of counts in fewer buckets: neighbours are added up."""
    if counts.shape[1] == wide:
        return counts.astype(np.int16)
    return np.minimum(counts.reshape(len(counts), wide, -1).sum(axis=2, dtype=np.int32), 255).astype(np.int16)


def _first_pass(batches: Batches) -> Batches:
    """Of each document id, size, two checksums and bucket counts of its set (kind 0); of
    shingles frequent in a block the count and the hash (kind 1: n_shingles, set_a)."""
    names = ["kind", "doc_id", "n_shingles", "set_a", "set_b", "counts"]
    for batch in batches:
        for block in w.blocks(batch.column("text")):
            sets = shingle_sets(block)
            flat, size = _flat(sets)
            offs = np.concatenate([[0], np.cumsum(size)])
            mixed = w.mix(flat ^ np.uint64(0x9E3779B97F4A7C15))
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (flat, mixed)]
            a, b = (s[offs[1:]] - s[offs[:-1]] for s in sums)
            n = len(size)
            counts = pa.array([row.tobytes() for row in bucket_counts(sets)], pa.binary())
            ids = batch.column("doc_id").slice(block.first, block.n)
            columns = [pa.array(np.zeros(n, np.int32)), ids, pa.array(size), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), counts]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            value, count = np.unique(flat, return_counts=True)
            some = count >= max(4, n // 2000)
            k = int(some.sum())
            columns = [pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.int64()), pa.array(count[some].astype(np.int64)), pa.array(value[some].view(np.int64)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _cells(docs: DataFrame, frequent: np.ndarray, level: np.ndarray) -> DataFrame:
    """(cell, doc_id, place, n): the documents' first shingles in the order of all, their places
    and the size of the set.

    A cell is a number: the shingle's level of frequency, then its hash, so cells compare
    as shingles do. Of equal sets in a block the least id is taken.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            every = np.array(batch.column("doc_id"))
            for block in w.blocks(batch.column("text")):
                ids = every[block.first : block.last]
                sets = shingle_sets(block)
                least: dict[bytes, int] = {}
                for i, s in enumerate(sets):
                    key = s.tobytes()
                    if len(s) and (key not in least or ids[i] < ids[least[key]]):
                        least[key] = i
                mine = sorted(least.values())
                flat, size = _flat([sets[i] for i in mine])
                cell = (flat >> np.uint64(7)).astype(np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)
                    cell |= np.where(frequent[at] == flat, level[at], 0) << 57
                owner = np.repeat(np.arange(len(mine)), size)
                order = np.lexsort((cell, owner))
                take = size - (NEAR * size + OF - 1) // OF + 1
                picked = order[w.ragged(np.cumsum(size) - size, take)]
                place = w.ragged(np.zeros(len(mine), np.int64), take)
                columns = [pa.array(cell[picked]), pa.array(ids[mine][owner[picked]], pa.int64()), pa.array(place, pa.int32()), pa.array(size[owner[picked]], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "doc_id", "place", "n"])

    return docs.mapInArrow(run, "cell long, doc_id long, place int, n int")


def _may_link(cell: np.ndarray, place: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether another row of the same cell may link with each, by sizes and places.

    Two sets whose first common shingle has these places share at most the least of n - place,
    and a link needs NEAR / (NEAR + OF) of both sizes; so each row has a largest size it can
    link to, and both must keep to the other's.
    """
    order = np.lexsort((n, cell))
    cell, place, n = cell[order], place[order], n[order]
    most = (NEAR + OF) * (n - place) // NEAR - n
    group = np.cumsum(np.concatenate([[0], cell[1:] != cell[:-1]]))
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    span = int(max(n.max(), most.max())) + 1
    end = np.searchsorted(group * span + n, group * span + np.maximum(most, 0), side="right")
    first, here = starts[group], np.arange(len(cell))
    longest = int(np.diff(np.append(starts, len(cell))).max())
    highest = [most]  # by k: the largest `most` of 2 ** k rows from each on
    while 2 << len(highest) - 1 <= longest:
        step, last = 1 << len(highest) - 1, highest[-1]
        highest.append(np.concatenate([np.maximum(last[:-step], last[step:]), last[-step:]]))
    table = np.stack(highest)

    def found(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether one of the rows low .. high - 1 can link to sets as large as this row's."""
        some = high > low
        k = np.frexp(np.where(some, high - low, 1).astype(np.float64))[1] - 1
        low = np.where(some, low, 0)
        high = np.where(some, high - (1 << k), 0)
        return some & (np.maximum(table[k, low], table[k, high]) >= n)

    out = np.zeros(len(cell), bool)
    out[order] = found(first, np.minimum(here, end)) | found(here + 1, end)
    return out


def _partnered(batches: Batches) -> Batches:
    """Rows (cell, doc_id, place, n) in the order of cells -> those that may link with another of
    their cell. Cells of more than WHOLE rows pass as they are."""
    names = ["cell", "doc_id", "place", "n"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    held = np.zeros((4, 0), np.int64)  # the rows of the last cell, which may go on
    passing = None  # a cell that is too large to be held

    def table(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=names)

    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        if passing is not None:
            more = np.searchsorted(rows[0], passing, side="right")
            if more:
                yield table(rows[:, :more])
            rows = rows[:, more:]
        if not rows.shape[1]:
            continue
        passing = None
        rows = np.concatenate([held, rows], axis=1)
        cut = np.searchsorted(rows[0], rows[0, -1])
        if cut:
            yield table(rows[:, :cut][:, _may_link(rows[0, :cut], rows[2, :cut], rows[3, :cut])])
        held = rows[:, cut:]
        if held.shape[1] > WHOLE:
            yield table(held)
            passing, held = held[0, 0], held[:, :0]
    if held.shape[1]:
        yield table(held[:, _may_link(held[0], held[2], held[3])])


def _count_distances(batches: Batches) -> Batches:
    """(..., counts_p, counts_o) -> (..., apart, apart_by_all): the distances of the bucket counts, in
    BUCKETS buckets and in all that both have."""
    for batch in batches:
        both = [batch.column(c) for c in ("counts_p", "counts_o")]
        wide = np.stack([pc.binary_length(x).to_numpy(zero_copy_only=False) for x in both]).astype(np.int64)
        apart = np.zeros((2, batch.num_rows), np.int64)
        for p, o in np.unique(wide, axis=1).T.tolist():
            at = np.flatnonzero((wide[0] == p) & (wide[1] == o))
            rows = [np.frombuffer(b"".join(x.take(pa.array(at)).to_pylist()), np.uint8).reshape(-1, n) for x, n in zip(both, (p, o), strict=True)]
            for k, n in enumerate((BUCKETS, min(p, o))):
                left, right = (_folded(x, n) for x in rows)
                apart[k, at] = np.abs(left - right).sum(axis=1, dtype=np.int64)
        names = [n for n in batch.schema.names if n not in ("counts_p", "counts_o")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *map(pa.array, apart)], names=[*names, "apart", "apart_by_all"])


def _links(batches: Batches) -> Batches:
    """(pivot, other, text_p, text_o) -> (u, v) of those that link. A pivot's set is made once a block."""
    for batch in batches:
        pivots, near = np.array(batch.column("pivot")), []
        for block in w.blocks(batch.column("text_o")):
            _, one, which = np.unique(pivots[block.first : block.last], return_index=True, return_inverse=True)
            left = sets_of(batch.column("text_p").take(pa.array(block.first + one)))
            for k, s in zip(which.tolist(), shingle_sets(block), strict=True):
                common = len(np.intersect1d(left[k], s, assume_unique=True))
                near.append(OF * common >= NEAR * (len(left[k]) + len(s) - common))
        kept = batch.select(["pivot", "other"]).filter(pa.array(near, pa.bool_()))
        yield pa.RecordBatch.from_arrays(kept.columns, names=["u", "v"])


_SHARED = "cell long, doc_id long, place int, low long, high long, size long, mark_a long, mark_b long"


def _of_two(batches: Batches) -> Batches:
    """Rows in the order of (cell, doc_id) -> those of cells with two documents or more, and
    behind them a row of the cell's marks (doc_id null). A document counts once in a cell; of
    the cell at hand only the first row and the sums are kept from batch to batch."""
    names = [x.split()[0] for x in _SHARED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
    held: tuple[int, int, int] | None = None  # the first row of the cell at hand, while it is alone
    marks = np.zeros(5, np.int64)  # of the cell at hand: low, high, size, two sums
    cell = last = None

    def table(columns: list) -> pa.RecordBatch:
        n = len(columns[0])
        full = [*columns, *[None] * (8 - len(columns))]
        return pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(full, kinds, strict=True)], names=names)

    def closed() -> Batches:
        if cell is not None and marks[2] > 1:
            yield table([[cell], None, None, *[[int(x)] for x in marks]])

    for batch in batches:
        cells, ids, places = (batch.column(c).to_numpy() for c in ("cell", "doc_id", "place"))
        if not len(cells):
            continue
        new = np.ones(len(cells), bool)
        new[1:] = (cells[1:] != cells[:-1]) | (ids[1:] != ids[:-1])
        new[0] = cells[0] != cell or ids[0] != last
        cells, ids, places = cells[new], ids[new], places[new]
        if not len(cells):
            continue
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        sizes = np.diff(np.append(starts, len(cells)))
        hashed = ids.astype(np.uint64)
        sums = [np.add.reduceat(w.mix(hashed ^ np.uint64(k)), starts).view(np.int64) for k in (0xA11, 0xB22)]
        found = np.stack([ids[starts], ids[starts + sizes - 1], sizes, *sums], axis=1)
        if cells[0] == cell:  # the cell at hand goes on
            if held is not None:
                yield table([[held[0]], [held[1]], [held[2]]])
                held = None
            found[:1, 2:] += marks[None, 2:]  # sums of hashes wrap
            found[0, 0] = marks[0]
        else:
            yield from closed()
            held = None
        more = found[:, 2] > 1
        rows = np.repeat(more, sizes)
        done = np.flatnonzero(more[:-1])  # the last cell may go on
        yield table([cells[rows], ids[rows], places[rows]])
        if len(done):
            yield table([cells[starts[done]], None, None, *found[done].T])
        cell, last, marks = int(cells[-1]), int(ids[-1]), found[-1]
        if not more[-1]:
            held = (cell, int(ids[-1]), int(places[-1]))
    yield from closed()


def _regions(cells: DataFrame, classes: DataFrame, useful: Callable[[Batches], Batches] = iter) -> DataFrame:
    """(region, id, n, place): the different sets of each region of two or more; n is the set's size.
    Of the rows of a cell those that `useful` leaves are taken.

    One pass over the cells in order finds those of two documents or more, and what tells
    cells with the same documents: size, ends and two sums of hashes, which do not cancel.
    """
    dealt = cells.filter("cell is not null and doc_id is not null").repartition("cell")
    ordered = dealt.sortWithinPartitions("cell", "doc_id", "place")
    shared = saved(ordered.mapInArrow(lambda batches: _of_two(useful(batches)), _SHARED), "cells")
    marks = ["low", "high", "size", "mark_a", "mark_b"]
    one = shared.filter("doc_id is null").groupBy(*marks).agg(F.min("cell").alias("cell"))
    inside = shared.filter("doc_id is not null").select("cell", "doc_id", "place").join(one.select("cell"), "cell", "left_semi")
    columns = [F.col("cell").alias("region"), F.col("set_id").alias("id"), F.col("n_shingles").alias("n"), "place"]
    return inside.join(classes, "doc_id").select(*columns).distinct()


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, components): sets (doc_id, n_shingles, set_id) has a row for each document,
    components (id, component) the least set_id reachable from each that has links."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = rows.filter(F.col("doc_id").isNotNull())
    first = saved(rows.mapInArrow(_first_pass, _SET), "sets")
    whole = first.filter("kind = 0").drop("counts")
    grouped = whole.filter("n_shingles > 0 and doc_id is not null")
    keys = ["n_shingles", "set_a", "set_b"]
    names = saved(grouped.groupBy(*keys).agg(F.min("doc_id").alias("set_id"), F.count("doc_id").alias("copies")), "names")
    own = F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id")
    sets = saved(named(whole, names, keys, "copies").select("doc_id", "n_shingles", own), "classes")
    forget(names)
    often = first.filter("kind = 1").groupBy("set_a").agg(F.sum("n_shingles").alias("n"))
    table = often.orderBy(F.desc("n"), "set_a").limit(FREQUENT).toArrow()
    value, count = np.array(table.column("set_a")).view(np.uint64), np.array(table.column("n"))
    level = np.minimum(np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 63)
    order = np.argsort(value)
    classes = sets.filter("set_id is not null")
    regions = saved(_regions(_cells(known, value[order], level[order]), classes, _partnered), "regions")
    counts = first.filter("kind = 0 and doc_id is not null").select("doc_id", "counts")
    comps = _joined(regions, counts, known)
    forget(first, regions)
    return sets, comps


def _met(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """(region, pivot, other, apart, near): pairs with the distance of their counts in BUCKETS buckets,
    and whether they may link by those in all buckets."""
    left = counts.select(F.col("doc_id").alias("pivot"), F.col("counts").alias("counts_p"))
    right = counts.select(F.col("doc_id").alias("other"), F.col("counts").alias("counts_o"))
    rows = pairs.join(left, "pivot").join(right, "other").select("region", "pivot", "other", "n_both", "counts_p", "counts_o")
    found = rows.mapInArrow(_count_distances, "region long, pivot long, other long, n_both long, apart long, apart_by_all long")
    return found.withColumn("near", 7 * F.col("apart_by_all") <= F.col("n_both")).drop("apart_by_all")


def _compared(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v) of the pairs (pivot, other) whose texts link, a saved table.

    Of docs only the texts of pairs are kept; up to ASKED ids go to the texts, which are not
    shuffled then. A pivot's text goes to its pairs, and these to the other documents, so that a
    pivot of many is compared by many tasks.
    """
    ids = saved(pairs.select(F.explode(F.array("pivot", "other")).alias("doc_id")).distinct(), "ids")
    asked = F.broadcast(ids) if ids.count() <= ASKED else ids.hint("merge")
    docs = saved(docs.join(asked, "doc_id", "left_semi"), "texts")
    forget(ids)
    left = docs.select(F.col("doc_id").alias("pivot"), F.col("text").alias("text_p"))
    right = docs.select(F.col("doc_id").alias("other"), F.col("text").alias("text_o"))
    rows = pairs.join(left, "pivot").join(right, "other").select("pivot", "other", "text_p", "text_o")
    out = saved(rows.mapInArrow(_links, "u long, v long"), "links")
    forget(docs)
    return out


def _meetings(active: DataFrame, chosen: DataFrame) -> DataFrame:
    """(region, pivot, other, n_both): pivots with the documents of other cells that they can
    link to; in small regions all documents are pivots."""
    columns = [F.col(c).alias(f"p_{c}") for c in ("id", "n", "place", "gap", "component")]
    small = active.filter("small")
    alone = small.select("region", *columns)
    n_both = F.col("n") + F.col("p_n")
    like = (
        (F.col("component") != F.col("p_component"))
        & (OF * F.least("n", "p_n") >= NEAR * F.greatest("n", "p_n"))
        & (7 * F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place")) >= 3 * n_both)
        & F.coalesce(7 * F.abs(F.col("gap") - F.col("p_gap")) <= n_both, F.lit(True))
    )
    within = small.join(alone, "region").filter(like & (F.col("p_id") < F.col("id")))
    around = active.filter("not small").join(chosen, "region").filter(like)
    found = [x.select("region", F.col("p_id").alias("pivot"), F.col("id").alias("other"), n_both.alias("n_both")) for x in (around, within)]
    return found[0].union(found[1])


def _joined(regions: DataFrame, counts: DataFrame, docs: DataFrame) -> DataFrame:
    """Components of all links within regions, by rounds of pivots.

    Texts (of docs) are read only for pairs that are close by their counts; a round without
    such pairs leaves the components as they are.
    """
    comps = None
    members = regions.withColumn("gap", F.lit(None).cast("long"))  # count distance to the region's first pivot
    pivots = 1
    while True:
        held = dealt(members)
        known = held.withColumn("component", F.col("id"))
        if comps is not None:
            named = dealt(comps).withColumnRenamed("component", "__c")
            known = held.join(named, "id", "left").withColumn("component", F.coalesce("__c", "id")).drop("__c")
        cells = known.groupBy("region", "component").agg(F.count(F.lit(1)).alias("size"))
        whole = cells.groupBy("region").agg(F.count(F.lit(1)).alias("cells"), F.sum("size").alias("all")).filter("cells > 1")
        small = F.lit(False) if comps is None else F.col("all") <= LEAF
        active = saved(known.join(whole.withColumn("small", small).drop("all"), "region"), "active")
        if comps is not None:
            if active.isEmpty():
                forget(active, members)
                return comps
        # The smallest cells give pivots; the last, largest cell never needs to while others are left.
        large = dealt(active).filter("not small").groupBy("region", "cells", "component").agg(
            F.count(F.lit(1)).alias("size"), F.min_by(F.struct("id", "n", "place", "gap"), F.struct(F.xxhash64("id"), "id")).alias("p")
        )
        rank = F.expr("row_number() over (partition by region order by size, p.id)")
        chosen = large.withColumn("rank", rank).filter(F.col("rank") <= pivots).filter(F.col("rank") < F.col("cells"))
        fields = [F.col(f"p.{c}").alias(f"p_{c}") for c in ("id", "n", "place", "gap")]
        chosen = saved(chosen.select("region", F.col("component").alias("p_component"), *fields), "pivots")
        met = saved(_met(_meetings(active, chosen), counts), "met")
        near = saved(met.filter("near").select("pivot", "other").distinct(), "near")
        if comps is None or not near.isEmpty():
            found = new = _compared(near, docs)
            if comps is not None:
                new = found.union(comps.select(F.col("id").alias("u"), F.col("component").alias("v")))
            was, comps = comps, components(new)
            forget(was, found)
        forget(near)
        left = dealt(active).filter("not small").join(dealt(chosen).select("region", F.col("p_id").alias("id")), ["region", "id"], "left_anti")
        left = left.select("region", "id", "n", "place", "gap")
        if pivots == 1:
            gaps = met.select("region", F.col("other").alias("id"), F.col("apart").alias("__gap"))
            left = left.drop("gap").join(gaps, ["region", "id"], "left").withColumnRenamed("__gap", "gap")
        was, members = members, saved(left, "members")
        forget(was, active, chosen, met)
        pivots *= 8


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs.

    Equal sets share a component. A null or empty text has no shingles and is a component
    of its own; a null doc_id links with nothing and has no component. Rows of one doc_id
    are linked by it.
    """
    sets, comps = links(docs)
    out = sets.join(comps.select(F.col("id").alias("set_id"), "component"), "set_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "set_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row for each component: that of the least doc_id. Rows with a null doc_id stay.

    Of repeated rows of that id one is kept.
    """
    keep = joined(docs).filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.filter(F.col("doc_id").isNotNull()).join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def op5_pivot_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and component, links at 3/4 or more."""
    return joined(documents(spark, sf_dir).select("doc_id", "text"))

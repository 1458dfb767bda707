"""Operator 12: near duplicates by one-permutation MinHash, banded buckets and stars.

A document's set holds its distinct 4-word shingles (A-Z lower-cased; a shorter text is one
shingle). Documents link when intersection over union of their sets is 4/5 or more.

Signature. One hash deals the shingles of a set to BINS bins and orders them in each; the
least of a bin is its value. An empty bin takes the value of a filled one, found by probing
bins in an order that is a hash of the bin's number alone (optimal densification), so any
two sets agree in a bin with the probability of their similarity, however small they are.

Bands. ROWS bins in a row make a bucket key, and sets that share a bucket are candidates.
Sets with similarity s share none of the BANDS buckets with probability
(1 - s ** ROWS) ** BANDS: 3e-6 at 4/5, and less above. This is the one loss of the method;
more bands lower it.

Stars. A bucket of n sets is not expanded into pairs. Every set meets the least id of all its
buckets, by the agreement of signatures and then by their full sets, which joins most
copies. A bucket whose sets are then in one component is done.

Mixed buckets. Where several components are left in a bucket, its sets are dealt anew, and
exactly, by shingles: in one order of all their shingles, rare ones first, two sets that
link share one of the first n - 4n/5 + 1 of each, and behind the first shared one at least
4/9 of both sizes must be left. A passage that many have in common stands last in that
order, so it brings nothing together by itself. In these buckets some sets become centres
of stars and meet the sets of other components. A centre has then met all it can link to
there and leaves the bucket. Each round has sixteen times as many centres a bucket, from the
smallest components on, until all buckets are done. No candidate is dropped: every two sets
of a bucket end in one component or have met, or cannot link.

Equal sets are one set throughout. Sets are compared by 64-bit hashes of shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.components import components
from docflow.llm.frames import Batches, dealt, documents, forget, named, saved

SHINGLE = 4
NEAR, OF = 4, 5  # link when intersection / union >= 4/5
ROWS, BANDS = 6, 42
BINS = ROWS * BANDS
PROBES = 64
AGREE = 156  # bins in which two signatures agree at least if they are met by their sets: 202 expected at 4/5
CENTRES = 16  # of a mixed bucket in its first round; each later one has so many times more
SMALLEST = 4  # a set of fewer shingles links with equal ones only
_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bins binary"


def shingle_sets(block: w.Block) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = w.split_words(block, lower=True)
    hashes, at = w.ngrams(words, SHINGLE)
    first = np.searchsorted(at, words.offs).tolist()
    out = [np.unique(hashes[a:b]) for a, b in zip(first, first[1:], strict=False)]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE)).tolist():
        mine = words.hashes[words.offs[i] : words.offs[i + 1]]
        out[i] = w.mix(np.array([len(mine)], np.uint64) ^ (mine * w.keyed(len(mine), 0x5E7)).sum(dtype=np.uint64))
    return out


def _probes() -> np.ndarray:
    """(PROBES, BINS): where an empty bin looks, attempt by attempt."""
    return (w.keyed(PROBES * BINS, 0xD3F) % np.uint64(BINS)).astype(np.int64).reshape(PROBES, BINS)


_PROBE = _probes()


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(set, bin): the bins' values of sets that are not empty."""
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    value = w.mix(flat ^ np.uint64(0x0B1A5))
    at = np.repeat(np.arange(len(sets)), size) * BINS + (value % np.uint64(BINS)).astype(np.int64)
    table = np.full(len(sets) * BINS, most, np.uint64)
    np.minimum.at(table, at, value)
    filled = table != most
    empty = np.flatnonzero(~filled)
    out = table.copy()
    for attempt in range(PROBES):
        if len(empty) == 0:
            break
        source = empty - empty % BINS + _PROBE[attempt][empty % BINS]
        found = filled[source]
        out[empty[found]] = table[source[found]]
        empty = empty[~found]
    if len(empty):  # sets of few shingles: the next filled bin to the right, around
        rows = np.unique(empty // BINS)
        grid = filled.reshape(-1, BINS)[rows]
        place = np.where(np.concatenate([grid, grid], axis=1), np.arange(2 * BINS), 2 * BINS)
        after = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :BINS] % BINS
        row = np.searchsorted(rows, empty // BINS)
        out[empty] = table[empty - empty % BINS + after[row, empty % BINS]]
    return out.reshape(-1, BINS)


def _bands(signature: np.ndarray) -> np.ndarray:
    """(set, band): the bucket keys."""
    factor = w.keyed(BINS, 0xBA2D) | np.uint64(1)
    return w.mix((signature * factor).reshape(-1, BANDS, ROWS).sum(axis=2, dtype=np.uint64) + w.keyed(BANDS, 0xB))


def _signed(batches: Batches) -> Batches:
    """(doc_id, text) -> size and two checksums of the set, bucket keys and a byte of each bin;
    the last two are null for sets too small to link with others."""
    for batch in batches:
        for block in w.blocks(batch.column("text")):
            sets = shingle_sets(block)
            size = np.array([len(s) for s in sets], np.int64)
            sums = [np.array([f(s) for s in sets], np.uint64).view(np.int64) for f in (_sum, _mixed_sum)]
            some = np.flatnonzero(size >= SMALLEST)
            signature = signatures([sets[i] for i in some.tolist()])
            least = (signature >> np.uint64(56)).astype(np.uint8)
            row = np.zeros(block.n, np.int64)
            row[some] = 1
            gone = pa.array(row == 0)
            keys = pa.array(_bands(signature).reshape(-1).view(np.int64))
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(row * BANDS)]), pa.int32()), keys, mask=gone)
            offsets = pa.array(np.concatenate([[0], np.cumsum(row * BINS)]), pa.int32())
            present = pa.array(row == 1).buffers()[1]
            bins = pa.Array.from_buffers(pa.binary(), block.n, [present, offsets.buffers()[1], pa.py_buffer(least.tobytes())])
            ids = batch.column("doc_id").slice(block.first, block.n)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size), pa.array(sums[0]), pa.array(sums[1]), bands, bins],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bins"],
            )


def _sum(s: np.ndarray) -> np.uint64:
    return s.sum(dtype=np.uint64)


def _mixed_sum(s: np.ndarray) -> np.uint64:
    return w.mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)


def _agreement(batches: Batches) -> Batches:
    """(u, v, bins_u, bins_v) -> (u, v) of signatures that agree in AGREE bins or more."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("bins_u", "bins_v"))
        near = (left == right).sum(axis=1) >= AGREE
        kept = batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))
        yield kept


def _confirmed(batches: Batches) -> Batches:
    """(u, v, text_u, text_v) -> (u, v) of sets that link. The set of a u is made once a batch."""
    for batch in batches:
        _, one, which = np.unique(batch.column("u").to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
        left = [s for block in w.blocks(batch.column("text_u").take(pa.array(one))) for s in shingle_sets(block)]
        near, at = [], 0
        for block in w.blocks(batch.column("text_v")):
            for s in shingle_sets(block):
                other = left[which[at]]
                common = len(np.intersect1d(other, s, assume_unique=True))
                near.append(OF * common >= NEAR * (len(other) + len(s) - common))
                at += 1
        yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))


def _linked(pairs: DataFrame, bins: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets link: first by signatures, then by the full sets.

    The text of v goes to its pairs, these to u, so a centre of many is compared by many tasks.
    """

    def beside(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for end in ("v", "u"):
            rows = rows.join(table.select(F.col("id").alias(end), F.col(column).alias(f"{column}_{end}")), end)
        return rows.select("u", "v", f"{column}_u", f"{column}_v")

    like = saved(beside(pairs, bins, "bins").mapInArrow(_agreement, "u long, v long"), "like")
    out = saved(beside(like, texts, "text").mapInArrow(_confirmed, "u long, v long"), "links")
    forget(like)
    return out


def _shared(cells: DataFrame) -> DataFrame:
    """(bucket, id, n, place, low): the cells (bucket, id, n, place) of buckets with two sets or
    more, low their least id; of buckets that hold the same sets the one with the least places."""
    mark = F.xxhash64("id")
    sums = [F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("mark_a"), F.sum(F.shiftrightunsigned(mark, 32)).alias("mark_b")]
    places = F.sum("place").alias("places")
    shared = cells.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("n").alias("size"), places, *sums)
    one = shared.filter("low < high").groupBy("low", "high", "size", "mark_a", "mark_b").agg(F.min(F.struct("places", "bucket")).alias("b"))
    return cells.join(one.select("b.bucket", "low"), "bucket")


def _buckets(sets: DataFrame) -> DataFrame:
    """The shared cells of the sets' bands; a bucket of bands has no order, so all places are 0."""
    cells = sets.filter("bands is not null").select(F.explode("bands").alias("bucket"), "id", "n", F.lit(0).cast("long").alias("place"))
    return _shared(cells)


def _shingled(batches: Batches) -> Batches:
    """(id, text) -> (id, n, shingle) of every distinct shingle."""
    for batch in batches:
        for block in w.blocks(batch.column("text")):
            sets = shingle_sets(block)
            size = np.array([len(s) for s in sets], np.int64)
            ids = batch.column("id").slice(block.first, block.n).to_numpy()
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            columns = [pa.array(np.repeat(ids, size)), pa.array(np.repeat(size, size)), pa.array(flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "shingle"])


def _dealt_anew(texts: DataFrame) -> DataFrame:
    """The shared cells of sets by the first of their shingles, rare ones first. Exact: sets that
    link share one, and `place` is where each has it."""
    every = saved(texts.mapInArrow(_shingled, "id long, n long, shingle long"), "shingles")
    often = every.groupBy("shingle").agg(F.count("n").alias("often")).filter("often > 1")
    known = every.join(often, "shingle", "left").fillna(1, ["often"])
    order = F.expr("row_number() over (partition by id, n order by often, shingle)")
    first = known.withColumn("place", (order - 1).cast("long")).filter(f"{OF} * (n - place) >= {NEAR} * n and often > 1")
    return _shared(first.select(F.col("shingle").alias("bucket"), "id", "n", "place"))


def _alike() -> F.Column:
    """Whether sizes and places allow a link: of each set, what is behind its place must be
    NEAR / (NEAR + OF) of both sizes together."""
    left = F.least(F.col("n") - F.col("place"), F.col("p_n") - F.col("p_place"))
    return (NEAR + OF) * left >= NEAR * (F.col("n") + F.col("p_n"))


def _first_stars(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(u, v): each set of a bucket and the least id of its buckets, if their sizes allow a link."""
    low = members.groupBy("id", "n").agg(F.min("low").alias("u"), F.min("place").alias("place")).filter("u < id")
    centres = sizes.select(F.col("id").alias("u"), F.col("n").alias("p_n"), F.lit(0).alias("p_place"))
    return low.join(centres, "u").filter(_alike()).select("u", F.col("id").alias("v"))


def _components_within(members: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, component) of all sets that link with another, from the buckets' members."""
    links = _linked(_first_stars(members, sets), sets, texts)
    comps = components(links)
    forget(links)
    members, centres = members.drop("low"), 0
    while True:
        known = dealt(members).join(dealt(comps), "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = known.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        active = saved(known.join(mixed.filter("least < most").select("bucket"), "bucket"), "active")
        if active.isEmpty():
            forget(active, members)
            return comps
        if not centres:
            some = active.select("id").distinct()
            members, centres = saved(_dealt_anew(texts.join(some, "id", "left_semi")).drop("low"), "members"), CENTRES
            forget(active)
            continue
        cells = dealt(active).groupBy("bucket", "component").agg(F.min(F.struct(F.xxhash64("id"), "id", "n", "place")).alias("p"), F.count("n").alias("size"))
        rank = F.expr("row_number() over (partition by bucket order by size, p.id)")
        chosen = cells.withColumn("rank", rank).filter(F.col("rank") <= centres)
        chosen = saved(chosen.select("bucket", F.col("component").alias("p_component"), *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("id", "n", "place")]), "centres")
        met = active.join(chosen, "bucket").filter(_alike() & (F.col("component") != F.col("p_component")))
        met = saved(met.select(F.col("p_id").alias("u"), F.col("id").alias("v")).distinct(), "met")
        if not met.isEmpty():
            links = _linked(met, sets, texts)
            if not links.isEmpty():
                was, comps = comps, components(links.union(comps.select(F.col("id").alias("u"), F.col("component").alias("v"))))
                forget(was)
            forget(links)
        rest = dealt(active).join(dealt(chosen).select("bucket", F.col("p_id").alias("id")), ["bucket", "id"], "left_anti")
        before, members = members, saved(rest.select("bucket", "id", "n", "place"), "members")
        forget(before, active, chosen, met)
        centres *= CENTRES


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs.

    Equal sets share a component. A null or empty text has no shingles and is a component
    of its own; a null doc_id links with nothing and has no component. Rows of one doc_id
    with unlike texts have the components of these. Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = saved(rows.mapInArrow(_signed, _SIGNED), "signed")
    keys = ["n_shingles", "set_a", "set_b"]
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    names = saved(some.groupBy(*keys).agg(F.min("doc_id").alias("set_id"), F.count("doc_id").alias("copies")), "names")
    whole = named(signed.select("doc_id", *keys), names, keys, "copies")
    mine = F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id")
    whole = saved(whole.select("doc_id", "n_shingles", mine), "whole")
    firsts = names.select(*keys, F.col("set_id").alias("doc_id"))
    sets = some.join(firsts, [*keys, "doc_id"], "left_semi").dropDuplicates([*keys, "doc_id"])
    sets = saved(sets.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands", "bins"), "sets")
    forget(signed, names)
    members = saved(_buckets(sets), "members")
    found = members.select("id").distinct()
    bare = saved(sets.drop("bands").join(found, "id", "left_semi"), "bins")
    forget(sets)
    texts = rows.withColumnRenamed("doc_id", "id").join(found.hint("merge"), "id", "left_semi").dropDuplicates()
    texts = saved(texts, "texts")
    comps = _components_within(members, bare, texts)
    forget(texts, bare, members)
    out = whole.join(comps.select(F.col("id").alias("set_id"), "component"), "set_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "set_id", "doc_id").alias("component_id"))


def op12_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size, component and whether it stays (the least id of its component)."""
    return classes(documents(spark, sf_dir).select("doc_id", "text")).withColumn("kept", F.expr("doc_id = component_id"))

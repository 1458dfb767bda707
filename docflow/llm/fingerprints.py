"""Operator 1: document fingerprints by consistent weighted sampling.

A text's terms are its pairs of consecutive words (a text of one word: the word), each
weighted by how often it occurs. For every sample k a term draws, from its hash alone, two
gamma(2, 1) variates r and c and a uniform b. With the logarithm of its weight rounded down
to the grid r * (t - b), t = floor(ln(weight) / r + b), the term's bid is
ln(c) - r * (t - b) - r; the sample is (term, t) of the least bid. Two texts agree in a
sample with the probability of their generalised Jaccard similarity, sum(min) / sum(max)
of the weights. A fingerprint holds SAMPLES samples as four hex digits each.

The variates come from fixed tables of TABLE draws: three parts of a term's hash say where
its SAMPLES consecutive values begin in each table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import Batches, documents, widened

SAMPLES = 64
TABLE = 1 << 16
TILE = 2048  # terms evaluated at a time


def _uniform(key: int) -> np.ndarray:
    return ((w.keyed(TABLE + SAMPLES, key) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


_R = -np.log(_uniform(1) * _uniform(2))
_VIEW = np.lib.stride_tricks.sliding_window_view
R = _VIEW(_R.astype(np.float32), SAMPLES)
INVERSE_R = _VIEW((1 / _R).astype(np.float32), SAMPLES)
LOG_C = _VIEW(np.log(-np.log(_uniform(3) * _uniform(4))).astype(np.float32), SAMPLES)
B = _VIEW(_uniform(5).astype(np.float32), SAMPLES)


def weighted_terms(block: w.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term hash, weight) of the block's distinct terms, in text order."""
    words = w.split_words(block)
    pairs, at = w.ngrams(words, 2)
    alone = np.flatnonzero(words.counts == 1)
    doc = np.concatenate([words.doc[at], alone])
    term = np.concatenate([pairs, words.hashes[words.offs[alone]]])
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return doc[at], term[at], np.diff(np.append(at, len(doc)))


def _bids(term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Bids by (term, sample) as doubles whose lowest 16 bits name the sampled (term, t)."""
    mask = np.uint64(TABLE - 1)
    i, j, k = ((term >> np.uint64(s) & mask).astype(np.int64) for s in (0, 16, 32))
    r, b = R[i], B[k]
    t = np.floor(np.log(weight).astype(np.float32)[:, None] * INVERSE_R[i] + b)
    bid = (LOG_C[j] - r * (t - b) - r).astype(np.float64)
    name = (term >> np.uint64(32)).astype(np.uint32)[:, None] ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
    name = (name * np.uint32(0x85EBCA77)) >> np.uint32(16)
    bits = bid.view(np.uint64)
    bits &= np.uint64(0xFFFFFFFFFFFF0000)
    bits |= name
    return bid


def samples(block: w.Block) -> np.ndarray:
    """The samples of each text, by (text, sample), as 16-bit numbers; -1 where a text has no word."""
    doc, term, weight = weighted_terms(block)
    least = np.full((block.n, SAMPLES), np.inf)
    for first in range(0, len(doc), TILE):
        part = slice(first, first + TILE)
        bids, owner = _bids(term[part], weight[part]), doc[part]
        at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        rows = owner[at]
        least[rows] = np.minimum(least[rows], np.minimum.reduceat(bids, at, axis=0))
    out = (least.view(np.uint64) & np.uint64(0xFFFF)).astype(np.int32)
    out[np.isinf(least[:, 0])] = -1
    return out


def signatures(texts: pa.Array) -> np.ndarray:
    """Samples of every text of an array; a null text is an empty one."""
    found = [samples(b) for b in w.blocks(texts)]
    return np.concatenate(found) if found else np.zeros((0, SAMPLES), np.int32)


def as_text(signature: np.ndarray) -> list[str]:
    """Fingerprints; a text without words has the empty one."""
    raw = signature.astype(">u2").tobytes().hex()
    size = 4 * SAMPLES
    return ["" if row < 0 else raw[i * size : (i + 1) * size] for i, row in enumerate(signature[:, 0])]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples: the estimated similarity. Two texts without words: 1."""
    return (a == b).mean(axis=1)


def fingerprints(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """docs with a fingerprint of each text; rows pass in place, without a shuffle.

    Equal texts have equal fingerprints. Null and empty texts have the empty fingerprint.
    """
    return widened(docs, [(column, "string")], lambda batch: [pa.array(as_text(signatures(batch.column(text))), pa.string())])


def in_falling_order(docs: DataFrame, parts: int) -> DataFrame:
    """(part, guest, doc_id, text): ids falling within each part, all parts falling too.

    After its own rows each part has a guest: a copy of the row that follows them in the
    order of all rows (after the last row: the first). Only ids are read to cut the parts;
    the cuts and each part's highest id, `parts` numbers each, are held by the driver.
    Null ids count as the lowest. Rows of one id are ordered by text.
    """
    lowest = -(1 << 63)
    ids = docs.select(F.coalesce(F.col("doc_id"), F.lit(lowest)).alias("id"))
    shares = [i / parts for i in range(1, parts)]
    cuts = ids.agg(F.percentile_approx("id", F.lit(shares or [0.5]), 100 * parts)).first()[0] or []
    cuts = np.unique(np.array(cuts if shares else [], np.int64))

    @F.pandas_udf("int")
    def part_of(id_):  # the highest ids come first
        return len(cuts) - np.searchsorted(cuts, id_.to_numpy(), side="left").astype("int32") + id_ * 0

    heads = {r["part"]: r["id"] for r in ids.groupBy(part_of("id").alias("part")).agg(F.max("id").alias("id")).collect()}
    order = sorted(heads)
    host = {heads[p]: order[i - 1] for i, p in enumerate(order)}  # a head visits the part before
    head_ids = np.array(sorted(host), np.int64)
    hosts = np.array([host[h] for h in head_ids.tolist()], np.int64)

    @F.pandas_udf("int")
    def host_of(id_):
        at = np.minimum(np.searchsorted(head_ids, id_.to_numpy()), len(head_ids) - 1)
        found = np.where(head_ids[at] == id_.to_numpy(), hosts[at], -1)
        return (id_ * 0 + found).astype("int32")

    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id"), F.lit(lowest)).alias("id"))
    rows = rows.withColumn("part", part_of("id")).withColumn("host", host_of("id"))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("host").alias("part"), F.lit(True).alias("guest"))
    where = F.when(F.col("host") >= 0, F.array(own, visit)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", "id", F.explode(where).alias("at")).select("at.part", "at.guest", "doc_id", "text", "id")
    dealt = dealt.repartitionById(len(cuts) + 1, F.col("part"))
    return dealt.sortWithinPartitions("part", "guest", F.desc("id"), "text").drop("id")


def half_edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced from the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Batches) -> Batches:
    """Rows of in_falling_order -> each text's and edited text's fingerprint."""
    waiting = None  # the last row, until the next one comes: (part, guest, id, text, signature)
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
        signs = signatures(batch.column("text"))
        rows = [*zip(batch.column("part").to_pylist(), batch.column("guest").to_pylist(), batch.column("doc_id").to_pylist(), texts, signs, strict=True)]
        if waiting is not None:
            rows.insert(0, waiting)
        if not rows:
            continue
        waiting = rows[-1]
        pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1]]
        if not pairs:
            continue
        edited = [half_edited(a[3], b[3]) for a, b in pairs]
        own, following = np.stack([a[4] for a, _ in pairs]), np.stack([b[4] for _, b in pairs])
        changed = signatures(pa.array(edited, pa.string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a[2] for a, _ in pairs], pa.int64()),
                pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(as_text(own), pa.string()),
                pa.array(as_text(changed), pa.string()),
                pa.array(likeness(own, changed), pa.float64()),
                pa.array(likeness(own, following), pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def op1_weighted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, its edited text's, and how alike they are."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_falling_order(documents(spark, sf_dir).select("doc_id", "text"), parts)
    return rows.mapInArrow(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )

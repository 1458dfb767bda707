"""Operator 11: importance resampling toward a target distribution of hashed n-grams.

Words are runs of [0-9a-z] and of characters beyond ASCII, after lower-casing A-Z. Features
are all runs of one to three consecutive words; a feature's bucket is the CRC-32 of its
bytes modulo BUCKETS. How often the buckets occur in the raw texts and in the target's
gives each bucket a gain, a text's weight is the sum of its gains, and the highest scores
(weight plus Gumbel noise of the document's id) are drawn: a sample without replacement
from the raw texts, with probabilities that follow the ratio of the two distributions.

Dictionary. The distinct words of a block of texts, each between two delimiters, go into an
Aho-Corasick automaton; a word carries its CRC and its length as payload. The automaton
scans the block, in which every run of other characters is one delimiter, and emits the
payloads of the words in order. CRCs compose: that of "a b" follows from the CRCs of a and
b and the length of b. So adjacent payloads give the buckets of all longer features, and no
feature is ever written out. A dictionary holds the words of one block, so its size does
not grow with the corpus.

What Spark holds: the counts of each task are one row a bucket; gains, BUCKETS numbers, go
back to the tasks. Ranks are taken within ranges of scores, so no task sorts all documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.llm import words as w
from docflow.llm.frames import Batches, documents, saved, widened

BUCKETS = 10_000
LONGEST = 3  # words of a feature
LEAST_WORDS = 20  # shorter texts are never drawn
PERCENT = 5
SEED = 42
LONG_WORD = 256  # bytes; a longer word stands in the scanned text as a short sign
BLOCK_BYTES = 8 << 20
RANGE_ROWS = 2_000  # of drawn documents in a range of scores, until there are MOST_RANGES
MOST_RANGES = 1_024

INSIDE = np.zeros(256, bool)
INSIDE[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


def _table(polynomial: int = 0xEDB88320) -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(polynomial), value >> 1).astype(np.uint32)
    return value


_STEP = _table()
_SMALL = 64


def _apply(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given for each byte in each place, on many values."""
    out = operator[0][crc & 255]
    for k in (1, 2, 3):
        out = out ^ operator[k][(crc >> np.uint32(8 * k)) & 255]
    return out


def _operators() -> tuple[np.ndarray, list[np.ndarray]]:
    """What n bytes of zero do to a CRC: for n below _SMALL, and for the powers of two from there."""
    one = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    small = []
    for _ in range(_SMALL):
        small.append(one)
        one = (one >> 8) ^ _STEP[one & 255]
    powers = []
    for _ in range(_SMALL.bit_length() - 1, 31):
        powers.append(one)
        one = _apply(one, one)
    return np.stack(small), powers


_BELOW, _POWERS = _operators()


def advanced(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The share that a prefix with this CRC has in the CRC of itself and `length` more bytes."""
    low = (length % _SMALL) * 1024
    flat = _BELOW.reshape(-1)
    out = flat[low + (crc & 255)]
    for k in (1, 2, 3):
        out = out ^ flat[low + 256 * k + ((crc >> np.uint32(8 * k)) & 255)]
    rest = length // _SMALL
    for j, power in enumerate(_POWERS):
        if not (rest >> j).any():
            break
        some = (rest >> j) & 1 == 1
        out[some] = _apply(power, out[some])
    return out


def _scanned(buf: np.ndarray, words: w.Words) -> tuple[np.ndarray, np.ndarray]:
    """CRC and length of each word of a block, as the automaton over its distinct words emits them."""
    import ahocorasick

    n = len(words.hashes)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    dictionary = ahocorasick.Automaton()
    _, first = np.unique(words.hashes, return_index=True)
    signs: dict[int, bytes] = {}
    for i, word in zip(first.tolist(), w.strings(buf, words.starts[first], words.ends[first]), strict=True):
        payload = len(word) << 32 | zlib.crc32(word)
        if len(word) > LONG_WORD:  # the sign holds a character that no word has
            word = signs[int(words.hashes[i])] = b"\x01%d" % len(signs)
        dictionary.add_word(f" {word.decode('utf-8', 'replace')} ", payload)
    dictionary.make_automaton()
    inside = np.zeros(len(buf) + 1, bool)
    inside[w.ragged(words.starts, words.ends - words.starts)] = True
    text = np.append(buf, np.uint8(32))
    text[words.ends] = 32  # the delimiter behind each word
    inside[words.ends] = True
    text, apart = text[inside], np.flatnonzero(words.starts[1:] == words.ends[:-1]) + 1
    if len(apart):  # the last word of a text that touches the first of the next
        raise AssertionError("texts of a block are not delimited")
    if signs:
        lens = words.ends - words.starts + 1
        ends = np.cumsum(lens)
        raw, out, at = text.tobytes(), [], 0
        for i in np.flatnonzero(lens - 1 > LONG_WORD).tolist():
            begin = int(ends[i] - lens[i])
            out += [raw[at:begin], signs[int(words.hashes[i])], b" "]
            at = int(ends[i])
        scan = b"".join([*out, raw[at:]])
    else:
        scan = text.tobytes()
    found = dictionary.iter(" " + scan.decode("utf-8", "replace"))
    payload = np.fromiter(map(itemgetter(1), found), np.int64, n)
    return (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32


def _delimited(block: w.Block) -> w.Block:
    """The block in lower case, with a delimiter behind each text."""
    buf = np.insert(w.LOWER[block.buf], block.offs[1:], 32)
    return w.Block(block.first, block.last, buf, block.offs + np.arange(block.n + 1))


def features(texts: pa.Array) -> Iterator[tuple[w.Words, list[tuple[np.ndarray, np.ndarray]]]]:
    """Of each block of texts its words and, for 1 to LONGEST words, the features' first words
    and CRCs. A null text has no words."""
    for block in w.blocks(texts, BLOCK_BYTES):
        block = _delimited(block)
        starts, ends, counts = w.segments(INSIDE[block.buf], block.offs)
        offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        words = w.Words(starts, ends, counts, offs, w.hash_segments(block.buf, starts, ends))
        crc, length = _scanned(block.buf, words)
        behind = advanced(np.full(len(crc), zlib.crc32(b" "), np.uint32), length) ^ crc  # of a space and the word
        doc = words.doc
        at, value, out = np.arange(len(crc)), crc, [(np.arange(len(crc)), crc)]
        for n in range(2, LONGEST + 1):
            more = at + n - 1 < len(crc)
            at, value = at[more], value[more]
            same = doc[at] == doc[at + n - 1]
            at, value = at[same], value[same]
            last = at + n - 1
            value = advanced(value, length[last] + 1) ^ behind[last]
            out.append((at, value))
        yield words, out


def bucket_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(bucket, n): how many features of all texts are in each bucket that has any."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, found in features(batch.column(0)):
                for _, crc in found:
                    total += np.bincount(crc % np.uint32(BUCKETS), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counted = texts.select(column).mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket: a thousand times the logarithm of the ratio of its smoothed
    shares in target and raw, rounded down. Takes two tables of bucket_counts (BUCKETS rows at most)."""
    counts = []
    for table in (raw, target):
        rows, n = table.toArrow(), np.zeros(BUCKETS, np.int64)
        n[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        counts.append(n.astype(float))
    s, t = counts
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """docs without the text, with n_words, n_features, weight (the sum of its features' gains)
    and score (weight plus the noise of doc_id; a null doc_id counts as no characters)."""

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        out: list[list[np.ndarray]] = [[], [], []]
        for words, found in features(batch.column("text")):
            weight, number = np.zeros(len(words.counts), np.int64), np.zeros(len(words.counts), np.int64)
            for at, crc in found:
                value = np.zeros(len(words.hashes), np.int64)
                value[at] = gain[crc % np.uint32(BUCKETS)]
                weight += w.per_text(value, words.offs)
                value[at] = 1
                number += w.per_text(value, words.offs)
            for column, part in zip(out, (words.counts, number, weight), strict=True):
                column.append(part.astype(np.int64))
        return [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out]

    fields = [("n_words", "long"), ("n_features", "long"), ("weight", "long")]
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return widened(docs, fields, rows, without=("text",)).withColumn("score", F.col("weight") + noise)


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """scored with rank: 1, 2, ... of the floor(percent * N / 100) highest scores among the N
    rows of at least least_words words, ties to the smaller doc_id; null for the others.

    Ranges of scores near the cut-off and above are ranked one by one and their counts added
    up. Where the ranges lie decides which task ranks a row, not its rank. Reads `scored`
    several times: give a written table.
    """
    fit = F.col("n_words") >= least_words
    n = scored.filter(fit).count()
    take = n * percent // 100
    ranges = min(max(take // RANGE_ROWS, 1), MOST_RANGES)
    lowest = max(0.0, 1 - 1.2 * percent / 100)
    share = [lowest + (1 - lowest) * i / ranges for i in range(ranges)]
    edges = scored.filter(fit).agg(F.percentile_approx("score", share, 100_000).alias("e")).first()["e"] or []
    edges = sorted(set(edges))
    # Range 0 holds the highest scores; rows below all edges are the last one.
    above = F.lit(len(edges)) - F.size(F.filter(F.array(*map(F.lit, edges)).cast("array<long>"), lambda e: e <= F.col("score")))
    parts = scored.withColumn("__part", F.when(fit, above))
    counts = {r["__part"]: r["n"] for r in parts.filter(fit).groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, seen = {}, 0
    for part in sorted(counts):
        if seen >= take:
            break
        before[part] = seen
        seen += counts[part]
    chosen = F.coalesce(F.col("__part").isin(list(before)), F.lit(False))
    rest = parts.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    if not before:
        return rest.drop("__part")
    start = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("__part")]
    own = F.expr("row_number() over (partition by __part order by score desc, doc_id asc nulls last)")
    place = (start + own).cast("long")
    ranked = parts.filter(chosen).withColumn("__place", place)
    ranked = ranked.withColumn("rank", F.when(F.col("__place") <= take, F.col("__place"))).drop("__place")
    return rest.unionByName(ranked).drop("__part")


def resampled(docs: DataFrame, target: DataFrame) -> DataFrame:
    """docs without the text, with n_words, n_features, weight, score and rank (null: not drawn).

    docs has doc_id and text, target has text. Null and empty texts have no features and
    weight 0; with an empty target or no documents all counts are those of the smoothing.
    Repeated rows are rows of their own, each with its rank. Columns of docs with the name
    of a new one give way to it; others are kept.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    clean = docs.drop("score", "rank")
    return drawn(saved(weighted(clean, gain), "scored"))


def op11_aho_corasick_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight, score and rank; the target is `benchmark`."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    out = resampled(documents(spark, sf_dir).select("doc_id", "text"), target)
    return out.select("doc_id", "n_features", "weight", "score", "rank")

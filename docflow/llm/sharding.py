"""Operator 7: shards by rendezvous hashing.

Every shard draws a number for a record from the record's stable key; the record goes to
the shard with the best draw. A draw is an exponential variate over the shard's weight, so
a shard gets its weight's share of the records, and a shard that is added takes records
only into itself. Nothing is shuffled to find a shard: it is a column expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.llm.frames import documents, ranked

SHARDS = 40


def _draw(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight for u in (0, 1) from the hash of (key, shard)."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(math.ldexp(1.0, 53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: the index of the weight with the least draw.

    A weight of 0 takes nothing. Equal draws go to the lower shard. A null key counts as
    the empty text, so all null keys share a shard.
    """
    live = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a weight above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    draws = [F.struct(_draw(text, i, w).alias("draw"), F.lit(i).alias("shard")) for i, w in live]
    return F.array_min(F.array(*draws))["shard"]


def shard(
    df: DataFrame, key: str, weights: Sequence[float], column: str = "shard", slot: str | None = "slot"
) -> DataFrame:
    """df with the record's shard and its place there, gapless from 0.

    The place follows the hash of the key, then the key; rows of one key (repeated rows
    too) follow each other. No rows, no result rows.
    """
    out = df.withColumn(column, rendezvous(F.col(key), weights))
    if slot is None:
        return out
    spread = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(-1))
    return ranked(out.withColumn("__spread", spread), [column], [key], "__spread", slot).drop("__spread")


def op7_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of equal weight, by doc_id; with one shard more beside it."""
    text = F.col("text").cast("binary")
    narrow = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    grown = narrow.withColumn("grown_shard", rendezvous(F.col("doc_id"), [1.0] * (SHARDS + 1)))
    out = shard(grown, "doc_id", [1.0] * SHARDS)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

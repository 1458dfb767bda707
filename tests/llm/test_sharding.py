import math
import zlib

import xxhash
from pyspark.sql import functions as F

from docflow.llm import sharding as s
from tests.llm import plain


def plain_shard(key, weights):
    def draw(i, weight):
        seed = xxhash.xxh64((key or "").encode(), seed=42).intdigest()
        bits = xxhash.xxh64(i.to_bytes(4, "little"), seed=seed).intdigest() >> 11
        return -math.log((bits + 0.5) / 2.0**53) / weight, i

    return min(draw(i, x) for i, x in enumerate(weights) if x > 0)[1]


def test_shards_equal_plain_ones_and_follow_the_weights(spark):
    weights = [1.0, 0.0, 3.0, 2.0]
    df = s.shard(spark.range(4000).select(F.col("id").alias("doc_id")), "doc_id", weights)
    rows = df.collect()
    assert all(r["shard"] == plain_shard(str(r["doc_id"]), weights) for r in rows[:600])
    for i, share in enumerate([1 / 6, 0, 3 / 6, 2 / 6]):
        mine = sorted(r["slot"] for r in rows if r["shard"] == i)
        assert mine == list(range(len(mine))) and abs(len(mine) / 4000 - share) < 0.04


def test_one_more_shard_takes_only_into_itself(spark):
    df = spark.range(3000).select("id", s.rendezvous(F.col("id"), [1.0] * 9).alias("a"), s.rendezvous(F.col("id"), [1.0] * 10).alias("b"))
    moved = df.filter("a <> b")
    assert moved.filter("b <> 9").count() == 0 and 200 < moved.count() < 400


def test_query_on_awkward_rows(spark, tmp_path):
    plain.frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    rows = s.op7_rendezvous(spark, str(tmp_path)).collect()
    assert len(rows) == len(plain.awkward())
    sizes = {(i, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t, *_ in plain.awkward()}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == sizes
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == plain_shard(key, [1.0] * 40) and r["grown_shard"] == plain_shard(key, [1.0] * 41)
    for shard in {r["shard"] for r in rows}:
        mine = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert mine == list(range(len(mine)))
    assert s.shard(spark.createDataFrame([], plain.SCHEMA), "doc_id", [1.0]).count() == 0

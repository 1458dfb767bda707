import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.llm import importance as m
from tests.llm import plain

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    ws = WORD.findall(plain.lower(text))
    runs = [" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]
    return len(ws), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_rows(docs, target):
    """doc_id, n_features, weight, score, rank of each row."""
    mine = [plain_buckets(t) for _, t in docs]
    s, t = Counter(b for _, bs in mine for b in bs), Counter(b for x in target for b in plain_buckets(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for (i, _), (n, bs) in zip(docs, mine, strict=True):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in bs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[5] = k + 1
    return sorted(((*r[:4], r[5]) for r in out), key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_crcs_compose():
    rng = random.Random(4)
    for size in [0, 1, 5, 63, 64, 65, 1000, 70_000]:
        a, b = rng.randbytes(9), rng.randbytes(size)
        got = m.advanced(np.array([zlib.crc32(a)], np.uint32), np.array([size])) ^ np.uint32(zlib.crc32(b))
        assert int(got[0]) == zlib.crc32(a + b)


def test_payloads_are_those_of_the_words():
    texts = ["A b c", None, "", "  ", "a-b_c", "é日本 x9", "tail", "q" * 300 + " " + "z" * 70_000 + " q " + "q" * 300, "\x01" + "0 1", "1"]
    found = [(words.doc[at].tolist(), crc.tolist()) for words, parts in m.features(pa.array(texts)) for at, crc in parts]
    got = Counter((d, c) for docs, crcs in found for d, c in zip(docs, crcs, strict=True))
    want = Counter()
    for d, text in enumerate(texts):
        ws = WORD.findall(plain.lower(text))
        want += Counter((d, zlib.crc32(" ".join(ws[i : i + n]).encode())) for n in (1, 2, 3) for i in range(len(ws) - n + 1))
    assert got == want


def test_small_blocks_give_the_same(monkeypatch):
    texts = [t for _, t, *_ in plain.awkward()]
    whole = [sorted(c.tolist()) for _, parts in m.features(pa.array(texts)) for _, c in parts]
    monkeypatch.setattr(m, "BLOCK_BYTES", 100)
    split = [[], [], []]
    for _, parts in m.features(pa.array(texts)):
        for k, (_, c) in enumerate(parts):
            split[k] += c.tolist()
    assert [sorted(x) for x in split] == whole


def test_rows_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(m, "RANGE_ROWS", 3)
    rng = random.Random(11)
    texts = [" ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(rng.choice([0, 5, 19, 20, 21, 60]))) for _ in range(300)]
    docs = [(900 - 3 * k, t) for k, t in enumerate(texts)]
    docs += [(7, texts[5])] * 40 + [(None, texts[3] * 3), (None, None), (1, ""), (2, None)]
    target = [" ".join(f"w{int(rng.expovariate(0.2))}" for _ in range(50)) for _ in range(5)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = m.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"))
    assert rows(got) == plain_rows(docs, target)
    assert got.filter("rank is not null").count() == 5 * sum(plain_buckets(t)[0] >= 20 for _, t in docs) // 100


@pytest.mark.parametrize("target", [[], ["the cat sat"]])
def test_awkward_rows_and_no_rows(spark, target):
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    docs = plain.frame(spark).withColumn("rank", F.lit("x")).withColumn("weight", F.lit("x"))
    got = m.resampled(docs, wanted)
    assert set(got.columns) == set(docs.columns) - {"text"} | {"n_features", "weight", "score", "rank"}
    assert rows(got) == plain_rows([(i, t) for i, t, *_ in plain.awkward()], target)
    assert m.resampled(spark.createDataFrame([], plain.SCHEMA), wanted).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    scored = spark.createDataFrame([(i, 30, 5) for i in range(100, 0, -1)] + [(0, 3, 99)], "doc_id long, n_words long, score long")
    got = m.drawn(scored).filter("rank is not null").orderBy("rank").collect()
    assert [(r["doc_id"], r["rank"]) for r in got] == [(k, k) for k in range(1, 6)]


def test_query(spark, tmp_path):
    plain.frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "word1 of the text")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = m.op11_aho_corasick_resampling(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(got) == plain_rows([(i, t) for i, t, *_ in plain.awkward()], ["word1 of the text"])

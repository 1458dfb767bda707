import zlib

import numpy as np

from docflow.llm import quality_classifier as q
from tests.llm import plain

SF = "/root/testdata/sf0.01"


def test_pairwise_fit_ranks_and_cuts_at_the_quantile():
    rng = np.random.default_rng(1)
    good = rng.random(3000) < 0.8
    x = rng.normal(size=(3000, 4)) + np.outer(good, [2.0, -1.0, 0, 0])
    ranker = q.fit(x, good, 1 - good.mean(), pairs=20_000)
    score = ranker.score(x)
    better = np.mean(score[good][:, None] > score[~good][None, :])
    assert better > 0.93
    assert abs((score < 0.5).mean() - (1 - good.mean())) < 0.01  # the quantile
    d = q.fit(x, np.ones(3000, bool), 0.0).score(x)
    assert (d == 0.5).all()


def test_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = q.op9_bradley_terry(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_awkward_rows_and_labels(spark):
    docs = plain.frame(spark)
    labels = spark.createDataFrame([(1, 1, 0), (15, 0, 0), (15, 0, 1), (17, 0, 0), (None, 1, 0), (7, None, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    kept = q.accept(docs, labels)
    assert kept.columns == docs.columns
    scores = q.scored(docs.select("doc_id", "text"), q.learn(docs, labels)).collect()
    assert len(scores) == len(plain.awkward())
    by_text = {}
    for r in scores:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    none = labels.filter("false")
    assert q.accept(docs, none).count() == docs.count()
    assert q.accept(docs.filter("false"), labels).count() == 0


def test_every_labelled_row_is_learned_from(spark):
    texts = [f"word{i % 7} " * (1 + i % 40) + "\n" * (i % 3) for i in range(17_000)] + ["# * $ | " * (1 + i % 9) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", (docs.doc_id < 17_000).cast("int").alias("quality"))
    ranker = q.learn(docs, labels)
    x = np.concatenate([q.features(b) for b in q.w.blocks(q.pa.array(texts))])
    assert np.allclose(ranker.mean, x.mean(axis=0)) and np.allclose(ranker.scale, x.std(axis=0), atol=1e-6)
    score = ranker.score(x)
    assert (score < 0.5).sum() == 400 and (score[-400:] < 0.5).all()


def test_each_row_has_a_pair(spark):
    rows = [(0, [float(i)], i) for i in range(5)] + [(1, [float(i)], i) for i in range(13)]
    frame = spark.createDataFrame(rows, "quality int, x array<double>, place long")
    pairs = q.paired(frame, {0: 5, 1: 13}).collect()
    assert len(pairs) == 13 * q.ROUNDS
    assert {p["up"][0] for p in pairs} == set(range(13)) and {p["down"][0] for p in pairs} == set(range(5))


def test_cut_is_the_quantile_of_all_scores(spark):
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=900), rng.integers(0, 5, 900) / 3, np.zeros(900)):
        good = rng.random(900) < 0.7
        order = np.sort(values)
        bad = int((~good).sum())
        frame = spark.createDataFrame([(int(g), float(v)) for g, v in zip(good, values)], "quality int, raw double")
        assert q.cut_at(frame, {0: bad, 1: 900 - bad}, bad / 900) == (order[bad - 1] + order[bad]) / 2

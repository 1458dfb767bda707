import random

from docflow.llm import substrings as s
from tests.llm import plain


def compare(spark, rows):
    from docflow.llm.frames import widened

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fields = [("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string")]
    got = widened(s.with_spans(docs), fields, s._kept_digests, without=("text", "spans")).collect()
    assert len(got) == len(rows)
    want = plain.removed(rows)
    for r in got:
        if r["doc_id"] is not None:
            w, gone = want[r["doc_id"]]
            kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), sum(gone), plain.sha(kept)), r["doc_id"]


def texts(rng, n):
    pool = [[f"s{k}_{rng.randrange(9)}" for _ in range(rng.randint(5, 70))] for k in range(12)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts += p[a : a + rng.randint(1, 60)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 8))]
        out.append(rng.choice([" ", "\n", " \t "]).join(parts))
    return out


def test_removed_words_equal_plain_search(spark):
    rng = random.Random(3)
    rows = [(k * 5 % 83, t) for k, t in enumerate(texts(rng, 80))]
    compare(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # nothing depends on the batches
    try:
        compare(spark, rows)
        compare(spark, [(i, "the cat " * n) for i, n in ((4, 30), (2, 8), (3, 5), (9, 60))])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in plain.awkward()]
    compare(spark, rows)
    docs = plain.frame(spark)
    out = s.remove(docs)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()]
    want = plain.removed(rows)
    for i, t, n in got:
        if i is None or not any(want[i][1]):
            assert (i, t) in [(a, b) for a, b in rows]
        else:
            assert plain.words(t) == [x for x, g in zip(*want[i], strict=True) if not g] and n == len(t)
    assert {i for i, *_ in got if i is not None} == {i for i, (w, g) in want.items() if not w or not all(g)}
    assert s.remove(docs.filter("false")).count() == 0


def test_factors_point_at_equal_words(spark):
    rng = random.Random(6)
    rows = list(enumerate(texts(rng, 40)))
    by_id = {i: plain.words(t) for i, t in rows}
    found = s.factors(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert found
    for r in found:
        n = r["windows"] + s.WINDOW - 1
        assert r["ref_doc"] < r["doc_id"]
        assert by_id[r["doc_id"]][r["first"] : r["first"] + n] == by_id[r["ref_doc"]][r["ref_first"] : r["ref_first"] + n]

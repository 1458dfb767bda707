import random

import numpy as np

from docflow.llm import frames, minhash as m, oracles
from tests.llm import plain


def shingles(text):
    w = plain.words(plain.lower(text))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def plain_classes(rows):
    """doc_id -> (set size, least doc_id reachable), over all pairs; one text a doc_id."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def compare(spark, rows):
    got = m.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    want = plain_classes(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r


def edited(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_all_pairs(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for g in range(8):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 120, 400]))]
        texts += edited(rng, base, 12, 4 if len(base) < 200 else 12)
    for k in range(60):  # a passage that many share, with little or much of their own: buckets of unlike sets
        own = [f"o{k}_{i}" for i in range(rng.choice([3, 6, 8, 12, 25, 60]))]
        texts.append(" ".join(passage + own))
    texts += ["a b c d e f g h", "a b c d e f g", "A B c d e F g H", "x", "x", "X", "one two three", "one two", "a b c d", "a b c d e"]
    texts += [texts[0]] * 30
    rng.shuffle(texts)
    compare(spark, [(100 - 3 * k, t) for k, t in enumerate(texts)])


def test_a_long_chain_is_one_class(spark):
    words = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(25):  # each a step from the one before, the ends unlike
        rows.append((500 - k, " ".join(words)))
        words[4 * k] = f"n{k}"
    want = plain_classes(rows)
    assert {low for _, low in want.values()} == {476}
    compare(spark, rows)


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(5)
    for size, common in ((400, 320), (60, 48), (10, 9), (5, 4)):
        rates = []
        for _ in range(200):
            u = rng.integers(1, 1 << 62, 2 * size - common).astype(np.uint64)
            a, b = np.sort(u[:size]), np.sort(u[size - common :])
            x, y = m.signatures([a, b])
            rates.append(np.mean(x == y))
        assert abs(np.mean(rates) - common / (2 * size - common)) < 0.02
        similar = common / (2 * size - common) >= 0.8
        assert not similar or min(rates) * m.BINS >= m.AGREE
    one = m.signatures([np.array([7], np.uint64)])
    assert len(np.unique(one)) == 1


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in plain.awkward()]
    compare(spark, rows)
    got = m.classes(plain.frame(spark))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == len(rows)
    assert m.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    compare(spark, [(1, "a b c d e"), (2, "f g h i j"), (3, None)])


def test_rows_of_one_id_with_unlike_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (3, a), (4, b + " x"), (5, a)]
    got = m.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(3, 37, 3), (4, 38, 4), (5, 37, 3), (5, 37, 3), (5, 37, 4)]


def test_hot_keys_are_named_like_others(spark):
    rows = spark.createDataFrame([(i, i % 7 if i % 3 else 100) for i in range(600)] + [(1, None)], "id long, k long")
    names = spark.createDataFrame([(k, k * 10, n) for k, n in ((100, 200), (1, 60), (2, 50))], "k long, name long, copies long")
    got = frames.named(rows, names, ["k"], "copies", share=4).collect()
    known = {100: 1000, 1: 10, 2: 20}
    assert len(got) == 601 and all(r["name"] == known.get(r["k"]) for r in got)


def test_query_and_its_sql(spark, tmp_path):
    import duckdb

    docs = spark.createDataFrame([r for r in plain.awkward() if r[0] is not None], plain.SCHEMA).dropDuplicates(["doc_id"])
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op12_one_permutation_minhash(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = db.execute(oracles.SQL["op12_one_permutation_minhash"])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())

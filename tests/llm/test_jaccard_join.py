import random

import pyarrow as pa
import pytest

from docflow.llm import components as c, jaccard_join as j
from tests.llm import plain


def compare(spark, rows):
    got = j.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = plain.components(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
        out.append(" ".join(w))
    return out


def test_links_equal_all_pairs(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 120]))]
        texts += variants(rng, base, 9, 6)
    for k in range(25):  # a passage that many share, with little or much of their own
        own = [f"o{k}_{i}" for i in range(rng.choice([3, 12, 20, 25, 60]))]
        texts.append(" ".join(passage + own))
    texts += ["a b c d e f", "a b c d e f g", "A B c d e F", "x", "x", "X", "one two three four", "one two three"]
    rng.shuffle(texts)
    compare(spark, [(100 - 3 * k, t) for k, t in enumerate(texts)])


def test_rows_repeated_in_other_batches(spark):
    rows = []
    for g in range(40):  # 5 and 7 link with 1 only, each by one cell, which 9 is in as well
        w = [f"g{g}w{k}" for k in range(9)]
        rows += [(10 * g + i, " ".join(t)) for i, t in ((1, w[:8]), (5, w[1:8]), (7, w[:7]), (9, w))]
    want = {(i, *x) for i, x in plain.components(rows).items()}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(size)
    spark.conf.set(size, len(rows))
    try:
        for more in (rows, [r for r in rows if r[0] % 10 in (5, 7)]):
            docs = spark.createDataFrame(spark.sparkContext.parallelize(rows + more, 1), "doc_id long, text string")
            got = j.joined(docs).collect()
            assert len(got) == len(rows) + len(more)
            assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == want
    finally:
        spark.conf.set(size, was)


def test_cells_of_other_documents_are_not_merged(spark):
    cells = [(cell, i, 0) for cell, ids in ((1, (1, 5, 5, 9)), (2, (1, 7, 7, 9)), (3, (1, 5, 5, 9))) for i in ids]
    sets = spark.createDataFrame([(i, 8, i) for i in (1, 5, 7, 9)], "doc_id long, n_shingles long, set_id long")
    got = j._regions(spark.createDataFrame(cells, "cell long, doc_id long, place int"), sets).collect()
    assert sorted((r["region"], r["id"]) for r in got) == [(1, 1), (1, 5), (1, 9), (2, 1), (2, 7), (2, 9)]


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_cells_of_two_documents_in_any_batches(size):
    rng = random.Random(size)
    cells = sorted((rng.randrange(30), rng.randrange(12), 0) for _ in range(90)) + [(50, 1, 0), (50, 1, 0)]
    cells += [(52, k, k) for k in range(7)] + [(53, 4, 0)]
    batches = [pa.RecordBatch.from_pylist(cells_as_rows(cells[i : i + size])) for i in range(0, len(cells), size)]
    rows = [r for b in j._of_two(iter(batches)) for r in b.to_pylist()]
    want = {}
    for cell, doc, _ in cells:
        want.setdefault(cell, set()).add(doc)
    want = {c: d for c, d in want.items() if len(d) > 1}
    got = {}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["doc_id"] not in got.setdefault(r["cell"], [])
            got[r["cell"]].append(r["doc_id"])
    assert {c: set(d) for c, d in got.items()} == want
    marks = {r["cell"]: (r["low"], r["high"], r["size"]) for r in rows if r["doc_id"] is None}
    assert marks == {c: (min(d), max(d), len(d)) for c, d in want.items()}
    sums = {}
    for r in rows:
        if r["doc_id"] is None:
            sums.setdefault(frozenset(want[r["cell"]]), set()).add((r["mark_a"], r["mark_b"]))
    assert all(len(v) == 1 for v in sums.values()) and len({next(iter(v)) for v in sums.values()}) == len(sums)


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_rows_that_may_link_with_another_of_their_cell(monkeypatch, size):
    rng = random.Random(size)
    for most in (3, 40, 400):
        rows = sorted((rng.randrange(9), rng.randrange(20), rng.randrange(n // 4 + 1), n) for n in (rng.randrange(1, 60) for _ in range(most)))
        names = ["cell", "doc_id", "place", "n"]
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
        want = []
        for i, (cell, _, place, n) in enumerate(rows):
            others = [r for k, r in enumerate(rows) if k != i and r[0] == cell]
            if any(7 * min(n - place, m - at) >= 3 * (n + m) for _, _, at, m in others):
                want.append(rows[i])
        assert [tuple(r.values()) for b in j._partnered(iter(batches)) for r in b.to_pylist()] == want
        with monkeypatch.context() as m:  # cells that are not held pass whole
            m.setattr(j, "WHOLE", 5)
            got = {tuple(r.values()) for b in j._partnered(iter(batches)) for r in b.to_pylist()}
        assert set(want) <= got <= set(rows)


def test_shingles_shared_by_chance_make_no_region(spark):
    rng = random.Random(3)
    texts = [" ".join(f"d{i}w{k}" for k in range(200 if i % 2 else 60)) for i in range(60)]
    for i in range(60):  # every two neighbours, too unlike in size, share one shingle
        at = rng.randrange(1, 50)
        words = texts[i].split()
        words[at : at + 5] = texts[i - 1].split()[at : at + 5]
        texts[i] = " ".join(words)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(1)
    none = j.np.zeros(0, "uint64"), j.np.zeros(0, "int64")
    cells = j._cells(docs, *none).localCheckpoint()
    classes = spark.createDataFrame([(i, 56, i) for i in range(60)], "doc_id long, n_shingles long, set_id long")
    every, some = j._regions(cells, classes).count(), j._regions(cells, classes, j._partnered).count()
    assert some == 0 < every


def test_sets_are_made_in_blocks(monkeypatch):
    most = []
    make = j.shingle_sets

    def seen(block):
        most.append(len(block.buf))
        return make(block)

    monkeypatch.setattr(j, "shingle_sets", seen)
    text = " ".join(f"w{k}" for k in range(20_000))
    texts = pa.array([f"{i} {text}" for i in range(60)])
    ids = pa.array(range(60), pa.int64())
    list(j._first_pass(iter([pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])])))
    pairs = pa.RecordBatch.from_arrays([ids, ids, texts, texts], names=["pivot", "other", "text_p", "text_o"])
    assert sum(b.num_rows for b in j._links(iter([pairs]))) == 60
    assert max(most) <= j.w.BLOCK_BYTES


def cells_as_rows(cells):
    return [{"cell": c, "doc_id": d, "place": p} for c, d, p in cells]


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in plain.awkward()]
    compare(spark, rows)
    docs = plain.frame(spark)
    kept = j.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {i for i, (_, low) in plain.components(rows).items() if i == low}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 2


def test_nothing_and_no_links(spark):
    assert j.joined(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    compare(spark, [(1, "a b c d e"), (2, "f g h i j"), (3, None)])


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["id"]: r["component"] for r in c.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert c.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_components_of_few_edges_need_no_exchange(spark, monkeypatch, few):
    rng = random.Random(few)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(30)]
    plans = []
    keep = c.saved

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(c, "saved", seen)
    monkeypatch.setattr(c, "FEW", few)
    got = {r["id"]: r["component"] for r in c.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, {a}).add(b)
        near.setdefault(b, {b}).add(a)
    want = {x: x for a, b in edges if a != b for x in (a, b)}
    for _ in want:
        want = {x: min(want[y] for y in near[x]) for x in want}
    assert got == want
    assert any("Exchange hashpartitioning" in p for p in plans[1:]) == (few == 0)


def test_long_texts_that_are_unlike_are_apart_by_counts():
    rng = random.Random(3)

    def text(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    first = text(12000)
    edited = list(first)
    for k in range(0, 12000, 400):
        edited[k] = "other"
    texts = [first, edited, first[:9500], text(12000), text(11000), text(1500), text(40)]
    sets = j.sets_of(pa.array([" ".join(t) for t in texts]))
    counts = j.bucket_counts(sets)
    assert [len(c) for c in counts] == [2048, 2048, 2048, 2048, 2048, 256, 256]
    for a, b in [(a, b) for a in range(len(sets)) for b in range(len(sets))]:
        columns = {"n_both": [len(sets[a]) + len(sets[b])], "counts_p": [counts[a].tobytes()], "counts_o": [counts[b].tobytes()]}
        (row,) = next(iter(j._count_distances(iter([pa.RecordBatch.from_pydict(columns)])))).to_pylist()
        common = len(set(sets[a].tolist()) & set(sets[b].tolist()))
        both = row["n_both"]
        assert row["apart"] <= row["apart_by_all"] <= both - 2 * common  # never above the symmetric difference
        linked = j.OF * common >= j.NEAR * (both - common)
        assert linked == ({a, b} <= {0, 1, 2} or a == b)
        assert (7 * row["apart_by_all"] <= both) == linked


def test_texts_of_pairs_are_found_with_many_ids_as_with_few(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b c d e f g h{i // 2}") for i in range(12)], "doc_id long, text string")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, 11)], "pivot long, other long")
    want = {(i, i + 1) for i in range(0, 11, 2)}
    for most in (j.ASKED, 3):
        monkeypatch.setattr(j, "ASKED", most)
        assert {tuple(r) for r in j._compared(pairs, docs).collect()} == want

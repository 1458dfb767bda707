import random

import numpy as np
import pytest

from docflow.operators import packing
from docflow.operators.packing import chunk_sizes, chunk_texts, pack_pages, text_pages


def greedy(sizes, target):
    """Chunk number per page, or None if a page cannot be packed."""
    if any(s > target for s in sizes):
        return None
    numbers, open_size, chunk = [], 0, 1
    for size in sizes:
        if open_size + size > target:
            chunk, open_size = chunk + 1, 0
        open_size += size
        numbers.append(chunk)
    return numbers


def documents(seed, n_docs, max_pages, target, oversize=0.02):
    rng = random.Random(seed)
    docs = {}
    for doc in range(n_docs):
        top = target + 3 if rng.random() < oversize else rng.choice([1, target // 4, target])
        docs[f"d{doc}"] = [rng.choice([0, 1, rng.randint(0, top)]) for _ in range(rng.randint(1, max_pages))]
    docs["heavy"] = [rng.randint(0, target) for _ in range(max_pages * n_docs // 3)]
    return docs


@pytest.mark.parametrize(
    "segment_pages, batch, levels, fan",
    [(50_000, 10_000, 2, 32), (7, 10_000, 1, 3), (5, 3, 0, 2), (1, 10_000, 2, 4), (3, 10_000, 3, 2)],
)
def test_packing_equals_the_greedy_rule(spark, segment_pages, batch, levels, fan):
    target = 40
    docs = documents(segment_pages + batch, 40, 25, target)
    rows = [(d, i, s) for d, sizes in docs.items() for i, s in enumerate(sizes, 1)]
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        pages = spark.createDataFrame(rows, "doc string, page_no long, n_bytes long").repartition(4)
        packed, rejected = pack_pages(pages, target, "doc", segment_pages, levels, fan)
        got = {(r["doc"], r["page_no"]): r["chunk_no"] for r in packed.collect()}
        bad = {r["doc"] for r in rejected.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {d: greedy(sizes, target) for d, sizes in docs.items()}
    assert bad == {d for d, numbers in want.items() if numbers is None}
    assert got == {
        (d, i): n for d, numbers in want.items() if numbers for i, n in enumerate(numbers, 1)
    }


def ended(sizes, target, carried):
    """(chunks opened, size of the open one) after pages that begin with a carried size."""
    opened = 0
    for size in sizes:
        if carried + size > target:
            opened, carried = opened + 1, 0
        carried += size
    return opened, carried


def test_functions_of_runs_compose_to_that_of_all_pages():
    rng = random.Random(8)
    for _ in range(150):
        target = rng.randint(1, 60)
        runs = [[rng.choice([0, 1, rng.randint(0, target)]) for _ in range(rng.randint(1, 20))] for _ in range(6)]
        parts = [packing._ends(np.array(run), target) for run in runs]
        left = parts[0]
        for part in parts[1:]:
            left = left.then(part)
        halves = parts[0].then(parts[1]).then(parts[2]), parts[3].then(parts[4].then(parts[5]))
        for run, ends in ((sum(runs, []), left), (sum(runs, []), halves[0].then(halves[1])), (runs[0], parts[0])):
            chunks, size = ends.of(np.arange(target + 1))
            assert list(zip(chunks.tolist(), size.tolist())) == [ended(run, target, c) for c in range(target + 1)]
            assert (np.diff(ends.limit) < 0).all()


def test_a_long_document_of_small_pages_keeps_tasks_small(spark, monkeypatch):
    pages = spark.range(1, 40_001).selectExpr("'a' as doc", "id as page_no", "10L as n_bytes").repartition(4)
    packed = pack_pages(pages, 4096, "doc", 500, 1, 8).valid
    rows = sorted((r["page_no"], r["chunk_no"]) for r in packed.collect())
    assert rows == [(i + 1, i // 409 + 1) for i in range(40_000)]
    steps = packing._ends(np.full(500, 10), 4096)
    assert len(steps.limit) == 410  # pages within one target of the segment's begin


def test_pages_are_read_twice_at_most(spark, tmp_path):
    spark.range(1, 3001).selectExpr("id % 3 as doc", "(id - 1) div 3 + 1 as page_no", "10L as n_bytes").write.parquet(str(tmp_path / "pages"))
    packed = pack_pages(spark.read.parquet(str(tmp_path / "pages")), 4096, "doc", 100).valid
    assert len(packed.collect()) == 3000
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("Initial Plan")].count("FileScan parquet") <= 2


def test_limit_is_inclusive_and_texts_come_back_whole(spark):
    texts = spark.createDataFrame([(1, "aaaa\nbbbb\n\ncc"), (2, ""), (3, "x" * 11)], "doc long, text string")
    pages = text_pages(texts, "doc")
    packed, rejected = pack_pages(pages, 8, "doc")
    chunks = {(r["doc"], r["chunk_no"]): r["chunk_text"] for r in chunk_texts(pages, packed, "doc").collect()}
    assert chunks == {(1, 1): "aaaa\nbbbb\n", (1, 2): "cc", (2, 1): ""}
    assert [r["doc"] for r in rejected.collect()] == [3]
    assert max(r["chunk_bytes"] for r in chunk_sizes(packed, "doc").collect()) == 8

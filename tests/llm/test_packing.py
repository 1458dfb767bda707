import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from docflow.llm import packing as p
from docflow.llm.frames import saved
from tests.llm import plain


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: k for k, b in enumerate(bins) if b + items[i] <= capacity}.values():
            bins[j] += items[i]
            go(i + 1, bins)
            bins[j] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def held(plan, capacity):
    got = np.zeros(capacity + 1, np.int64)
    for g in plan.groups:
        assert g.count > 0 and g.left >= 0 and sum(x * n for x, n in g.pattern) + g.left == capacity
        for x, n in g.pattern:
            got[x] += n * g.count
    return got.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_whole_and_as_small_as_can_be(seed):
    rng = random.Random(seed)
    for _ in range(40):
        capacity = rng.choice([10, 20, 50, 100])
        items = [rng.randint(1, capacity - 1) for _ in range(rng.randint(1, 10))]
        counts = np.bincount(items, minlength=capacity + 1)
        fit, plan = p.best_fit(counts, capacity), p.bin_completion(counts, capacity)
        assert held(fit, capacity) == held(plan, capacity) == counts.tolist()
        best = fewest(items, capacity)
        assert p.lower_bound(counts, capacity) <= best <= plan.sequences <= fit.sequences
        assert plan.sequences == best


def test_search_improves_on_best_fit_and_plans_stay_small():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(400, 1000, 1000), minlength=2049)
    assert p.bin_completion(counts, 2048).sequences < p.best_fit(counts, 2048).sequences
    many = p.best_fit(np.bincount(rng.integers(1, 2048, 10**6), minlength=2049), 2048)
    assert len(many.groups) <= 3 * 2047


def verify(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(p.tokenizer_path())
    want, total = defaultdict(list), 0
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            want[i, k].append((s, len(part), zlib.crc32(part.tobytes())))
    got, inside = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"]].append((r["start"], r["length"], r["ids_crc32"]))
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(inside), -(-total // capacity)


@pytest.mark.parametrize("capacity", [7, 2048])
def test_awkward_rows(spark, capacity):
    docs = plain.frame(spark)
    rows = p.pack_documents(docs, p.tokenizer_path(), capacity).collect()
    used, least = verify(rows, [(i, t) for i, t, *_ in plain.awkward()], capacity)
    assert used >= least
    assert p.pack_documents(docs.filter("false"), p.tokenizer_path()).count() == 0


def test_sequences_hold_the_ids(spark):
    rows = [(i, "the cat sat on the mat " * (i % 9)) for i in range(30)]
    cut = saved(p.pieces(spark.createDataFrame(rows, "doc_id long, text string"), p.tokenizer_path(), 64, with_ids=True), "p")
    packed = p.pack(cut, 64)
    whole = {r["sequence_id"]: r["ids"] for r in p.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert max(map(len, whole.values())) <= 64


def test_query_over_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, least = verify(p.op2_bin_completion(spark, sf).collect(), docs, 2048)
    assert used <= least + 1

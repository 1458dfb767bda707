from collections import Counter

import numpy as np
import pyarrow as pa

from docflow.llm import fingerprints as f
from tests.llm import plain


def similarity(a, b):
    def terms(t):
        w = plain.words(t)
        return Counter(zip(w, w[1:], strict=False)) if len(w) > 1 else Counter(w)

    x, y = terms(a), terms(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collision_rate_is_the_weighted_similarity():
    rng = np.random.default_rng(4)
    pairs = []
    for i in range(250):
        a = [str(x) for x in rng.integers(0, 12, 100)] + [f"own{i}_{j}" for j in range(20)]
        b = list(a)
        for _ in range(rng.integers(0, 60)):
            b[rng.integers(0, len(b))] = str(rng.integers(0, 12))
        pairs.append((" ".join(a), " ".join(b)))
    one, two = (f.signatures(pa.array([p[k] for p in pairs])) for k in (0, 1))
    want = np.array([similarity(a, b) for a, b in pairs])
    error = f.likeness(one, two) - want
    assert abs(error.mean()) < 0.015
    assert error.std() < 1.25 * np.sqrt((want * (1 - want)).mean() / f.SAMPLES)


def test_edited_texts_and_order(spark):
    rows = [(i, t) for i, t, *_ in plain.awkward() if i is not None]
    rows = list(dict(rows).items())  # one row for each id
    for parts in (1, 3, 8):
        got = f.in_falling_order(spark.createDataFrame(rows, "doc_id long, text string"), parts).mapInArrow(
            f._compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
        )
        found = {r["doc_id"]: r for r in got.collect()}
        order = sorted(rows, key=lambda r: -r[0])
        assert len(found) == len(order)
        for k, (i, t) in enumerate(order):
            t, n = t or "", order[(k + 1) % len(order)][1] or ""
            half = len(t) // 2
            r = found[i]
            assert (r["n_chars"], r["edited_sha256"]) == (len(t), plain.sha(t[: len(t) - half] + n[:half]))
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_nulls_repeats_and_clashes(spark):
    got = f.fingerprints(plain.frame(spark)).select("doc_id", "text", "fingerprint").collect()
    assert len(got) == len(plain.awkward())
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
        assert r["fingerprint"] == "" if not plain.words(r["text"]) else len(r["fingerprint"]) == 4 * f.SAMPLES
    everything = f.in_falling_order(plain.frame(spark).select("doc_id", "text"), 3)
    assert everything.filter("not guest").count() == len(plain.awkward())
    empty = spark.createDataFrame([], plain.SCHEMA)
    assert f.fingerprints(empty).count() == 0 and f.in_falling_order(empty, 4).count() == 0

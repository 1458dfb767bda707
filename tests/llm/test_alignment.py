import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from docflow.llm import alignment as m, bitmaps as b
from tests.llm import plain


@pytest.fixture(scope="module")
def tokenizers():
    return m._tokenizers(*m.tokenizer_paths())


def plain_rows(texts, tokenizers):
    """By text n_a, n_b, n_groups, n_links, n_best, count_sum, digest; spans compared one by one."""
    a, pieces = tokenizers
    known = []
    for text in texts:
        text = text or ""
        raw = f" {text}".encode()
        ids = [a.own.encode(f" {text}", add_special_tokens=False).ids, pieces.model.encode(text)] if text else [[], []]
        spans = []
        for side, table in zip(ids, (a.texts, pieces.texts), strict=True):
            at, mine = 0, []
            for i in side:
                mine.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(mine)
        if any(b"".join(t[i] for i in x) != raw for x, t in zip(ids, (a.texts, pieces.texts), strict=True)):
            spans = [[], []]
        left, right = spans
        links = [(x, y) for s, e, x in left for t, f, y in right if s < f and t < e]
        ends = {e for _, e, _ in left} & {e for _, e, _ in right}
        groups, begin = [], 0
        for end in sorted(ends):
            groups.append("|".join(",".join(str(i) for s, _, i in side if begin <= s < end) for side in (left, right)))
            begin = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        known.append((len(left), len(right), len(groups), links, digest))
    count = Counter(pair for *_, links, _ in known for pair in set(links))
    top = Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [
        (na, nb, g, len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest)
        for na, nb, g, links, digest in known
    ]


def sample(n, seed):
    rng = random.Random(seed)
    words = ["the", "of", "naïve", "日本", "x" * 30, "don't", "3.14", "  ", "\n", "<|endoftext|>", "<s>", "é", "word", "unrelated", "▁", "🙂", "\u0085"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def compare(spark, rows, tokenizers, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    from docflow.llm.frames import saved

    got = m.aligned(saved(m.inverted(df, *m.tokenizer_paths()), "index"))
    assert got.columns[0] == "doc_id"
    want = [(i, *r) for (i, _), r in zip(rows, plain_rows([t for _, t in rows], tokenizers), strict=True)]
    assert sorted(map(str, (tuple(r) for r in got.select("doc_id", *COLUMNS).collect()))) == sorted(map(str, want))


def test_rows_equal_plain_ones(spark, tokenizers):
    rows = [(k, t) for k, t in enumerate(sample(120, 1))] + [(7, "the the the word"), (None, "the of"), (None, None), (500, "")]
    compare(spark, rows, tokenizers)


def test_many_chunks_give_the_same(spark, tokenizers, monkeypatch):
    rows = [(k, t) for k, t in enumerate(sample(60, 2))]
    a = plain_rows([t for _, t in rows], tokenizers)
    out = []
    monkeypatch.setattr(m, "CHUNK_POSTINGS", 40)
    blocks = m.w.blocks
    monkeypatch.setattr(m.w, "blocks", lambda texts: blocks(texts, 200))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["doc_id", "text"])
    index = list(m._inverted(*m.tokenizer_paths(), iter([batch])))
    chunks = {c for x in index for c in x.column("chunk").to_pylist()}
    assert len(chunks) > 3
    spark_rows = spark.createDataFrame([r for x in index for r in x.to_pylist()], m._ROWS)
    out = m.aligned(spark_rows).select("doc_id", *COLUMNS).collect()
    assert sorted(map(tuple, out)) == sorted((i, *r) for (i, _), r in zip(rows, a, strict=True))


def test_pair_counts(spark, tokenizers):
    texts = ["the the of", "the", "of the the the the", ""]
    index = m.inverted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), *m.tokenizer_paths())
    got = {(r["id_a"], r["id_b"]): (r["n_docs"], r["n_links"]) for r in m.pair_counts(index).collect()}
    out = [m.align([t], *tokenizers) for t in texts]
    pairs = [list(zip(o.ids_a[o.link_a].tolist(), o.ids_b[o.link_b].tolist(), strict=True)) for o in out]
    docs, links = Counter(p for x in pairs for p in set(x)), Counter(p for x in pairs for p in x)
    assert got == {p: (docs[p], links[p]) for p in docs}


def test_awkward_rows(spark, tokenizers, tmp_path):
    rows = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t, *_ in plain.awkward()]
    compare(spark, rows, tokenizers, parts=1)
    plain.frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op13_inverted_bitmaps(spark, str(tmp_path))
    assert set(got.columns) == {"doc_id", *COLUMNS} and got.count() == len(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert m.aligned(m.inverted(empty, *m.tokenizer_paths())).count() == 0


def test_both_ways_to_the_first_tokenizer_agree(tokenizers):
    a, _ = tokenizers
    usual = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and m._USUAL.fullmatch(chr(c))]
    assert len(usual) > 20_000 and "\u0085" not in usual
    texts = [f" a{c}b {c} {c}{c}1{c}  {c}" for c in usual] + [t for t in sample(200, 3) if m._USUAL.fullmatch(t)]
    assert a.fast.encode_ordinary_batch(texts, num_threads=1) == [e.ids for e in a.own.encode_batch_fast(texts, add_special_tokens=False)]
    assert a(["x" * 50_000, "the"])[1] == a.own.encode("the").ids


def test_bitmaps():
    rng = np.random.default_rng(2)
    lists = [np.sort(rng.choice(b.PLACES, n, replace=False)) for n in (1, 0, 5000, b.SPARSE, b.SPARSE + 1, b.PLACES, 3)]
    counts = np.array([len(x) for x in lists])
    data, lens = b.packed(np.concatenate(lists), counts)
    assert b.popcounts(data, lens).tolist() == counts.tolist() and lens.max() == b.DENSE
    owner, place = b.places_of(data, lens)
    for k, x in enumerate(lists):
        assert np.array_equal(place[owner == k], x)
    key, ored, sizes = b.merged(np.array([5, 5, 1, 1, 5, 9, 1]), data, lens)
    owner, place = b.places_of(ored, sizes)
    for k, group in zip(key.tolist(), ([2, 3, 6], [0, 1, 4], [5]), strict=True):
        assert np.array_equal(place[owner == key.tolist().index(k)], np.unique(np.concatenate([lists[i] for i in group])))

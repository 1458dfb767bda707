import itertools
import tracemalloc

import numpy as np
import pyarrow as pa

from docflow.llm import language as g
from docflow.llm import words as w
from docflow.llm.frames import numbered
from tests.llm import plain

ENGLISH = "the house and the garden are by the river where we went with them this morning".split()
GERMAN = "das haus und der garten sind am fluss wohin wir heute morgen mit ihnen gegangen sind".split()
RUSSIAN = "дом и сад стоят у реки куда мы ходили с ними сегодня утром".split()


def training():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(90):
        lang, source = [("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN)][i % 3]
        rows.append((i, " ".join(rng.choice(source, 60)), lang, "s", 1))
    return rows


def test_viterbi_equals_trying_all_sequences():
    rng = np.random.default_rng(5)
    counts = np.array([4, 1, 0, 6, 5])
    scores = np.round(rng.normal(size=(16, 3)) * 4).astype(np.float32)
    label = g.viterbi(scores, counts, 3.0)
    at = 0
    for n in counts:
        mine = scores[at : at + n]

        def value(path):
            return sum(mine[i, x] for i, x in enumerate(path)) - 3 * sum(a != b for a, b in zip(path, path[1:], strict=False))

        if n:
            best = max(value(p) for p in itertools.product(range(3), repeat=int(n)))
            assert abs(value(label[at : at + n].tolist()) - best) < 1e-4
        at += n


def test_spans_of_mixed_text(spark):
    model = g.learn(plain.frame(spark, training()))
    assert model.names == ["de", "en", "ru"]
    text = " ".join(ENGLISH + GERMAN * 2 + ["123", "--"] + RUSSIAN)
    rows = [(1, text, None, None, 1), (2, "12 -- !!", None, None, 1), (3, None, None, None, 1), (4, " ".join(RUSSIAN), None, None, 1)]
    got = {r["doc_id"]: r for r in g.identify(plain.frame(spark, rows), model).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "de", "ru"] and got[1]["lang_pred"] == "de"
    first = [s["first"] for s in got[1]["spans"]]
    assert abs(first[1] - len(ENGLISH)) <= 1 and first[2] == len(ENGLISH) + 2 * len(GERMAN) + 2
    assert (got[2]["lang_pred"], got[2]["score"], got[2]["spans"]) == ("und", 0.0, [])
    assert got[3]["lang_pred"] == "und" and got[4]["lang_pred"] == "ru" and got[4]["score"] == 1.0


def test_awkward_and_empty(spark):
    docs = plain.frame(spark)
    model = g.learn(docs)
    rows = g.identify(docs, model).collect()
    assert len(rows) == len(plain.awkward())
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        assert 0 <= r["score"] <= 1
    none = g.learn(spark.createDataFrame([], plain.SCHEMA))
    assert none.names == [] and {r["lang_pred"] for r in g.identify(docs, none).collect()} == {"und"}
    assert g.accept(docs).columns == docs.columns


def test_a_block_takes_little_memory():
    rng = np.random.default_rng(3)
    model = g.Model(list("abcdefgh"), rng.normal(size=(g.SLOTS, 8)).astype(np.float32), np.ones((len(g.SCRIPT_NAMES), 8), bool))
    texts = pa.array([" ".join(rng.choice(ENGLISH + GERMAN, 400)) for _ in range(3_500)])
    memo, seen = g._memo(model), 0
    tracemalloc.start()
    for block in w.blocks(texts, g.BLOCK):
        g._label(model, memo, block)
        seen += block.n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len(texts) and texts.nbytes > 6 << 20 and peak < 200e6


def test_accept_passes_each_text_once_and_keeps_columns(spark):
    docs = plain.frame(spark, training()).withColumnsRenamed({"text": "Text", "n_chars": "score"}).selectExpr("*", "1 as `__row`", "2 as spans", "'x' as `a.b`")
    assert numbered(docs).columns.count("text") == 1 and len(numbered(docs).columns) == len(docs.columns)
    got = g.accept(docs)
    assert got.schema == docs.schema and sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))


def test_held_out_accuracy(spark):
    rows = g.op4_viterbi_spans(spark, "/root/testdata/sf0.001").join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)

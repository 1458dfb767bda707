"""The pipeline's rows against plain versions of each stage, on what the stage before left."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as c
from docflow.llm import language, packing, quality_classifier
from tests.llm import plain
from tests.llm.test_packing import verify

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in c.STAGES:
        out.append(c.saved(stage(spark, out[-1], SF), "test"))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_decide_as_plain_ones(spark, stages):
    docs, good, spoken, single, cut, packed = stages
    for df in stages[1:5]:
        assert df.columns == docs.columns
    ranker = quality_classifier.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(good) == ids(quality_classifier.scored(docs, ranker).filter("score >= 0.5"))
    assert 0 < good.count() < docs.count()
    found = language.identify(good, language.learn(good)).filter("lang_pred <> 'und' and score >= 0.5")
    assert ids(spoken) == ids(found)
    rows = [(r["doc_id"], r["text"]) for r in spoken.collect()]
    assert ids(single) == sorted(i for i, (_, low) in plain.components(rows).items() if i == low)
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    want = plain.removed(rows)
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert sorted(left) == sorted(i for i, (w, g) in want.items() if not w or not all(g))
    for i, t in left.items():
        assert plain.words(t) == [x for x, g in zip(*want[i], strict=True) if not g]
    verify(packed.collect(), list(left.items()), packing.CAPACITY)


def test_run_is_all_stages(spark, stages):
    last = stages[-1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, c.run(spark, SF).select(columns).collect())) == sorted(map(tuple, last.select(columns).collect()))


def test_clean_documents_pass_and_junk_goes(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = set(ids(stages[2]))
    marked = [(r["doc_id"], r["quality"]) for r in labels.collect()]
    assert sum(i in kept for i, q in marked if q == 1) >= 0.98 * sum(q == 1 for _, q in marked)
    assert sum(i in kept for i, q in marked if q == 0) <= 0.02 * len(marked)


@pytest.mark.parametrize("name", sorted(c.SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    result = db.execute(c.SQL[name])
    names = [d[0] for d in result.description]
    frame = entry.queries()[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(tuple, frame.select(names).collect())) == sorted(result.fetchall())


def tables(spark, path, rows):
    plain.frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], k % 2, 0) for k, r in enumerate(rows) if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_awkward_rows_and_clashing_columns_pass(spark, tmp_path):
    where = tables(spark, tmp_path, plain.awkward())
    packed = c.run(spark, where).collect()
    texts = {(i, t) for i, t, *_ in plain.awkward()}
    assert {r["doc_id"] for r in packed} <= {i for i, _ in texts}
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in c.STAGES[1:4]:  # each by itself, on all rows
        out = stage(spark, docs, where)
        assert out.columns == docs.columns and out.count() <= docs.count()


def test_no_documents_give_no_pieces(spark, tmp_path):
    assert c.run(spark, tables(spark, tmp_path, [])).count() == 0


def test_every_query_is_offered():
    assert set(c.QUERIES) <= set(entry.queries()) and set(c.SQL) <= set(entry.oracle_sql())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in c.QUERIES if q != "pipeline"}

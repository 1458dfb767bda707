"""What is shuffled, filtered and extracted on the way from landed items to staged records."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from docflow.checks import files
from docflow.checks.fixtures import Fixtures
from docflow.operators import gates
from docflow.sources.readers import explode_items


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def merged(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _docs(spark, *rows):
    columns = "i int, source_kind string, company_ticker string, company_id string, year int, date string, title string, url string, type string, filepath string, accession_number string, primary_document string"
    return spark.createDataFrame(
        [(i, "articles", "T1", "c", 2024, None, "t", url, "html", path, None, None) for i, url, path in rows], columns
    )


def test_gate_deals_documents_by_a_hash_and_compares_texts(spark, merged):
    hashed = spark.range(1).select(F.concat(F.lit("data/c/2024/"), F.md5(F.lit("u3")), F.lit(".html"))).head()[0]
    docs = _docs(spark, (1, "u1", "x/a.html"), (2, "u2", "x/b.html"), (3, "u3", hashed), (4, "u4", None), (5, "u5", hashed))
    names = spark.createDataFrame(
        [("source/knowledge/T1/2024/", "a.html"), ("source/knowledge/T1/2024/", "a.html"), ("source/knowledge/T2/2024/", "b.html"), (None, None)],
        "prefix string, filename string",
    )
    left = gates.anti_join_stored(docs, names)
    got = {r["i"]: (r["filepath"], r["prefix"], r["filename"]) for r in left.collect()}
    last = hashed.rsplit("/", 1)[1]
    prefix = "source/knowledge/T1/2024/"
    assert got == {2: ("x/b.html", prefix, "b.html"), 3: (hashed, prefix, last), 4: (None, prefix, None), 5: (hashed, prefix, last)}
    physical = left._jdf.queryExecution().sparkPlan().toString() + left._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key#" in physical and "hashpartitioning(prefix#" not in physical


def test_blank_texts_are_no_filter(spark):
    lines = spark.createDataFrame([(1, " \n"), (2, '{"title":"a"}'), (3, "[]"), (4, '[{"title":"b"},{"title":"c"}]'), (5, "x")], "pos int, value string")
    items = explode_items(lines)
    titles = [(r["pos"], r["item"] and r["title"]) for r in items.select("pos", "item", F.try_variant_get("item.title", "$", "string").alias("title")).collect()]
    assert sorted(titles) == [(2, "a"), (4, "b"), (4, "c"), (5, None)]
    assert "Filter" not in _plan(items)


def test_sizes_of_contents_do_not_shuffle_their_texts(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1, "u1", "<p>one</p>"), (7, "u7", "x")], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([(5, 2)], "o_orderkey long, o_custkey long").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(5, "text", 4)], "doc_id long, text string, n_chars long").write.parquet(f"{root}/documents.parquet")
    sizes = Fixtures(spark, root).contents.select("url", "n_bytes")
    filing = "https://www.sec.gov/Archives/edgar/data/2/5.htm"
    assert {tuple(r) for r in sizes.collect()} == {("u1", 10), ("u7/doc.PDF?x=1", 1), (filing, 4)}
    lines = _plan(sizes).split("\n")
    dealt = [lines[i + 1] for i, line in enumerate(lines) if "RepartitionByExpression" in line]
    assert len(dealt) == 1 and "octet_length(html" in dealt[0] and "html#" not in dealt[0].replace("octet_length(html#", "")


def test_records_are_written_once_before_both_families_are_staged(spark, tmp_path, monkeypatch):
    made = spark.range(3).withColumn("document_id", F.col("id").cast("string"))
    given = []
    monkeypatch.setattr(files, "_run", lambda t: SimpleNamespace(records=made))
    monkeypatch.setattr(files.writers, "stage_documents", lambda session, records, root: given.append(records) or {})
    files._staged(Fixtures(spark, str(tmp_path)))
    assert given[0].inputFiles() and given[0].count() == 3

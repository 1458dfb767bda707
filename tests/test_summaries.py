import pytest
from pyspark.sql import functions as F

from docflow.operators import backfill as bf
from docflow.operators import records as rc
from docflow.operators import summaries as sm
from docflow.schemas import ARTICLE_RECORD, FILING_COLUMNS

SOURCES = "company_ticker string, year int, source_kind string, pos long, n_docs int, error string"


def test_only_a_complete_failure_raises(spark):
    ok = spark.createDataFrame([("AA", 2024, "articles", 1, 2, None), ("AA", 2024, "edgar", 2, 0, "boom")], SOURCES)
    sm.fail_if_all_sources_failed(ok)
    sm.fail_if_all_sources_failed(spark.createDataFrame([("AA", 2024, "articles", 1, 0, None)], SOURCES))
    bad = spark.createDataFrame([("AA", 2024, "edgar", 2, 0, "late"), ("AA", 2024, "articles", 1, 0, "boom")], SOURCES)
    with pytest.raises(RuntimeError, match="failed for AA: articles: boom; edgar: late"):
        sm.fail_if_all_sources_failed(bad)
    assert sm.error_details(bad).head()["error_details"] == "articles: boom; edgar: late"


def test_run_summary_messages(spark):
    requests = spark.createDataFrame([("A", 1, None), ("B", 1, None), ("C", 1, "edgar")], "company_ticker string, year int, source string")
    rows = [("B", 1, "stored", 4, False), ("C", 1, "stored", 1, False), ("C", 1, "processed", 2, True),
            ("C", 1, "skipped", 1, False), ("C", 1, "duplicate", 5, False), ("C", 1, "failed", 1, False)]
    outcomes = spark.createDataFrame(rows, "company_ticker string, year int, outcome string, n long, promoted boolean")
    got = {r["company"]: r.asDict() for r in sm.run_summary(requests, outcomes).collect()}
    assert got["A"]["message"] == "No documents found." and got["A"]["ingested"] == 0
    assert got["B"]["message"] == "All documents already ingested." and got["B"]["processed"] is None
    c = got["C"]
    assert (c["discovered"], c["processed"], c["skipped"], c["promoted"]) == (10, 2, 1, 2)
    assert c["ingested"] is None and c["message"] == "Ingestion completed."


def test_outcomes_routing_and_uris(spark):
    rows = [("edgar", True, False, "gs://b/stage/edgar/v1/x", ""), ("articles", True, True, None, "gs://b/p"),
            ("metadata", False, False, "", None), ("other", None, None, "http://x", None)]
    df = spark.createDataFrame(rows, "source_kind string, success boolean, skipped boolean, stage_uri string, prod_uri string").coalesce(1)
    assert [r["outcome"] for r in sm.classify_outcomes(df).collect()] == ["processed", "skipped", "failed", "failed"]
    assert [r["table_id"] for r in sm.route_to_table(df).collect()] == ["edgar", "documents", "company_metadata", "documents"]
    assert [r["load_uri"] for r in sm.has_stage_uri(df, "prod_uri").valid.collect()] == ["gs://b/stage/edgar/v1/x", "gs://b/p", "http://x"]
    assert sm.has_stage_uri(df).rejected.count() == 2
    assert sm.valid_uri(df, "stage_uri", promotable=True).valid.count() == 1
    assert sm.valid_uri(df, "stage_uri").rejected.count() == 3


def test_first_company_per_ticker_in_file_and_line_order(spark):
    rows = [(1, 1, "X", "late"), (0, 2, "X", "second"), (0, 1, "X", "first"), (0, 3, "-", "cash"), (0, 4, "", "n"), (0, 5, None, "n"), (1, 9, "y", None), (1, 10, " Y ", "later")]
    df = spark.createDataFrame(rows, "file_no int, line_no int, ticker string, name string")
    firsts = bf.first_company_per_ticker(bf.valid_holdings(df))
    assert {r["ticker"]: r["name"] for r in firsts.collect()} == {"X": "first", "Y": ""}
    companies = {r["company_ticker"]: r for r in bf.holdings_to_companies(firsts).collect()}
    assert companies["Y"]["company_id"] == "com_y" and companies["X"]["base_url"].endswith("search?q=first")
    assert "WindowGroupLimit" in firsts._jdf.queryExecution().executedPlan().toString()


def test_schema_union_adds_only_what_is_missing(spark):
    df = spark.createDataFrame([("d", "10-K")], "document_id string, filing_type string")
    wide = rc.add_filing_columns(df)
    assert wide.columns == ["document_id", "filing_type"] + [c for c in FILING_COLUMNS if c != "filing_type"]
    assert wide.head()["filing_type"] == "10-K" and wide.head()["cik"] is None
    typed = rc.cast_stage_types(spark.createDataFrame([(5, "2024", "x")], "title int, year string, extra string"), ARTICLE_RECORD)
    assert [f.dataType.simpleString() for f in typed.schema] == ["string", "bigint", "string"]


def test_source_uri_prefers_a_downloaded_file(spark):
    docs = spark.createDataFrame([("u", True, "gs://b/own"), ("u", True, ""), ("u", False, "gs://b/own"), ("v", False, None)],
                                 "url string, downloaded boolean, gcs_uri string").withColumn("i", F.monotonically_increasing_id())
    fetched = spark.createDataFrame([("u", "gs://b/fetched")], "url string, fetched_uri string")
    got = [(r["source_gcs_uri"], r["needs_fetch"]) for r in rc.resolve_source_uri(docs, fetched).orderBy("i").collect()]
    assert got == [("gs://b/own", False), ("gs://b/fetched", True), ("gs://b/fetched", True), (None, True)]

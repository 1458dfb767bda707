import json

import pytest
from pyspark.sql import functions as F

from docflow.functions.items import item_fields
from docflow.operators import normalize as nz
from docflow.sources.readers import explode_items

CONTEXT = {"company_ticker": " aa ", "company_name": "Bramley", "company_id": " com_aa ", "base_url": " https://a "}


def items(spark, bodies):
    rows = [(i, json.dumps(b) if not isinstance(b, str) else b, 2024, *CONTEXT.values()) for i, b in enumerate(bodies)]
    schema = "pos long, j string, year int, company_ticker string, company_name string, company_id string, base_url string"
    return spark.createDataFrame(rows, schema).withColumn("item", item_fields(F.try_parse_json("j"))).drop("j").coalesce(1)


def test_company_defaults(spark):
    rows = [(" aa ", " Bramley\t", None, " u "), ("bb", "B", "  ", "u"), ("cc", "C", " id ", "u")]
    df = spark.createDataFrame(rows, "company_ticker string, company_name string, company_id string, base_url string")
    got = [tuple(r) for r in nz.normalize_company(df).coalesce(1).collect()]
    assert got == [("AA", "Bramley", "com_aa", "u"), ("BB", "B", "com_bb", "u"), ("CC", "C", "id", "u")]


@pytest.mark.parametrize("source, want", [(None, ("articles", "edgar")), (" Metadata ", ("metadata",)), ("EDGAR", ("edgar",))])
def test_requested_sources(source, want):
    assert nz.requested_sources(source) == want


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="newsletter"):
        nz.requested_sources("newsletter")
    df = spark.createDataFrame([("newsletter",), (None,)], "source string")
    split = nz.expand_sources(df)
    assert [r["source"] for r in split.rejected.collect()] == ["newsletter"]
    assert split.valid.count() == 2


def test_bad_items_are_set_aside_and_the_rest_goes_on(spark):
    good = {"title": "t", "url": "u"}
    bodies = [
        good, {**good, "title": ""}, {"url": "u"}, {"title": "t"}, {**good, "title": None}, {**good, "title": 5},
        {**good, "url": 1.5}, {**good, "date": 2024}, {**good, "date": None}, {**good, "type": 7, "filepath": 9},
        {**good, "cik": 5}, "not json", "[1]", '"text"',
    ]
    marked = nz.mark_invalid(items(spark, bodies)).orderBy("pos").collect()
    reasons = [None, None, "title", "url", "title", "title", "url", "date", None, None, None, "title", "title", "title"]
    assert [r["reject_reason"] for r in marked] == reasons
    valid, rejected = nz.split_invalid(items(spark, bodies))
    assert valid.count() + rejected.count() == len(bodies)


def test_filing_fields_are_checked(spark):
    good = {"title": "t", "url": "u"}
    bodies = [
        {**good, "filing_type": "10-K", "form": 3}, {**good, "filing_type": "", "form": 3}, {**good, "filing_type": 4},
        {**good, "form": "8-k"}, {**good, "cik": 5}, {**good, "report_date": None}, {**good, "accession_number": []},
        {**good, "filing_type": 0, "form": None},
    ]
    got = [r["reject_reason"] for r in nz.mark_invalid(items(spark, bodies), True).orderBy("pos").collect()]
    assert got == [None, "filing_type", "filing_type", None, "cik", None, "accession_number", None]


def test_article_dates_tell_absent_from_null(spark):
    good = {"title": " T ", "url": " u "}
    docs = nz.articles_to_documents(items(spark, [good, {**good, "date": None}, {**good, "date": " 2024-01-02 "}]))
    rows = docs.orderBy("pos").collect()
    assert [r["date"] for r in rows] == ["2024", None, " 2024-01-02 "]
    first = rows[0].asDict()
    # Titles, URLs and base URLs are kept as given.
    assert (first["title"], first["url"], first["base_url"]) == (" T ", " u ", " https://a ")
    assert (first["company_ticker"], first["company_id"], first["source_kind"]) == ("AA", "com_aa", "articles")
    assert first["downloaded"] is False and first["cik"] is None


def test_filing_documents(spark):
    body = {
        "title": "t", "url": "https://s/x.htm", "filing_type": "", "form": " 10-k ", "cik": " 320193 ",
        "accession_number": "  ", "primary_document": " d.htm ",
    }
    row = nz.filings_to_documents(items(spark, [body])).head().asDict()
    assert row["filing_type"] == "10-K" and row["cik"] == "0000320193"
    assert row["accession_number"] is None and row["primary_document"] == "d.htm"
    assert row["source_kind"] == "edgar" and row["type"] == "html"


def test_attach_company_by_ticker(spark):
    companies = nz.normalize_company(
        spark.createDataFrame([("Aa", "New", None, "w")], "company_ticker string, company_name string, company_id string, base_url string")
    )
    row = nz.attach_company(items(spark, [{"title": "t"}]), companies).head()
    assert (row["company_ticker"], row["company_name"], row["company_id"]) == ("AA", "New", "com_aa")


def test_companies_are_merged_whatever_their_guessed_size(spark):
    companies = spark.createDataFrame(
        [("T1", "n", "c", "u")], "company_ticker string, company_name string, company_id string, base_url string"
    )
    joined = nz.attach_company(items(spark, [{"title": "t"}]).withColumn("company_ticker", F.lit(" t1")), companies)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and joined.count() == 1


def test_taken_fields_give_the_same_documents(spark):
    good = {"title": "t", "url": "https://x/a.pdf"}
    bodies = [good, {**good, "date": None}, {**good, "date": "2024-01-02", "filepath": " d/a.html "}, {**good, "filepath": "https://x"},
              {**good, "title": 5}, {**good, "form": "8-k", "cik": "7"}, {**good, "filing_type": 4}, "not json"]
    for filing, made in ((False, nz.articles_to_documents), (True, nz.filings_to_documents)):
        whole = nz.split_invalid(items(spark, bodies), filing)
        taken = nz.split_invalid(nz.take_fields(items(spark, bodies), filing), filing)
        assert "item" not in taken.valid.columns
        assert sorted(made(taken.valid).collect()) == sorted(made(whole.valid).collect())
        reasons = [sorted(s.rejected.select("pos", "reject_reason").collect()) for s in (taken, whole)]
        assert reasons[0] == reasons[1]


def test_an_item_is_parsed_once(spark):
    lines = spark.createDataFrame([('{"title":"a","url":"b"}',), ('[{"title":"c"},{"title":"d"}]',), ("{} {}",)], "value string")
    found = explode_items(lines)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert sorted(r["item_no"] for r in found.collect()) == [0, 0, 0, 1]

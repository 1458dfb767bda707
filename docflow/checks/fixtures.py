"""Operator inputs derived from the given tables.

The ``SQL`` texts run unchanged on Spark and on the checking engine. Inputs that
depend on normalised documents are built on Spark from the operators and, for
the check, from independent SQL in :mod:`docflow.checks.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.config import Settings
from docflow.functions.identity import document_id
from docflow.operators import gates, normalize
from docflow.operators.packing import text_pages
from docflow.plans.ingest import Inputs, build_requests
from docflow.session import configure, work_dir
from docflow.sources.readers import explode_items

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _quoted(expr: str) -> str:
    """SQL for a JSON string literal of an SQL text."""
    slash = f"replace({expr}, chr(92), chr(92) || chr(92))"
    return f"""'"' || replace({slash}, '"', chr(92) || '"') || '"'"""


_PAGE_URL = "case when page_id % 7 = 0 then url || '/doc.PDF?x=1' else url end"
_FILING_URL = (
    "'https://www.sec.gov/Archives/edgar/data/' || cast(o_custkey as varchar(20)) "
    "|| '/' || cast(o_orderkey as varchar(20)) || '.htm'"
)
_FILING_TYPE = """case o_orderpriority when '1-URGENT' then '8-k' when '2-HIGH' then '10-K'
 when '3-MEDIUM' then ' 10-q ' when '4-NOT SPECIFIED' then '' else null end"""

# Whose filing it is: one of a hundred companies, or the order's own customer.
HUNDRED, OWN = "cast(1 + o_custkey % 100 as varchar(20))", "cast(o_custkey as varchar(20))"

SQL = {
    "fx_companies": """
select cast(c_custkey as varchar(20)) as row_key,
 ' t' || cast(c_custkey as varchar(20)) || ' ' as company_ticker, ' ' || c_name || ' ' as company_name,
 case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then '   '
  else ' cid' || cast(c_custkey as varchar(20)) end as company_id,
 'https://c' || cast(c_custkey as varchar(20)) || '.example.com ' as base_url from customer""",
    "fx_article_items": f"""
select page_id as pos, 'T' || cast(page_id % 25 as varchar(9)) as company_ticker,
 cast(2021 + page_id % 6 as int) as year,
 '{{"url":' || {_quoted(_PAGE_URL)}
 || case when page_id % 17 = 0 then ',"title":null'
   when page_id % 19 = 0 then ',"title":' || cast(page_id as varchar(20))
   when page_id % 29 = 0 then ''
   else ',"title":' || {_quoted("regexp_extract(html,'<title>([^<]*)</title>',1)")} end
 || case when page_id % 11 = 0 then ',"type":"PDF"' when page_id % 11 = 1 then ',"article_type":"press"' else '' end
 || case when page_id % 13 = 0 then ',"is_pdf":true' when page_id % 13 = 1 then ',"is_pdf":false'
   when page_id % 13 = 2 then ',"is_pdf":"yes"' else '' end
 || case when page_id % 23 = 0 then ',"date":2024' when page_id % 4 = 0 then ',"date":"2024-03-05"'
   when page_id % 4 = 1 then ',"date":"2024-3-5"' when page_id % 4 = 2 then ',"date":"20240305"'
   when page_id % 8 = 3 then ',"date":null' else '' end
 || case when page_id % 5 = 0 then ',"filepath":"data/x/' || cast(page_id as varchar(20)) || '.html"'
   when page_id % 5 = 1 then ',"filepath":' || {_quoted("url")}
   when page_id % 5 = 2 then ',"filepath":" data/shared/index.html "' else '' end
 || '}}' as item from pages""",
    "fx_filing_items": f"""
select o_orderkey as pos, 'T' || {HUNDRED} as company_ticker,
 cast(2021 + (year(o_orderdate) - 1995) % 6 as int) as year,
 '{{"title":"Filing ' || o_orderpriority || '","url":"' || {_FILING_URL}
 || '","date":"' || substring(cast(cast(o_orderdate as date) as varchar(10)),1,10) || '"'
 || coalesce(',"filing_type":"' || {_FILING_TYPE} || '"', '')
 || case when o_orderkey % 37 = 0 then ',"form":10'
   when o_orderpriority in ('4-NOT SPECIFIED','5-LOW') then ',"form":"DEF 14A"' else '' end
 || ',"filing_date":"' || substring(cast(cast(o_orderdate as date) as varchar(10)),1,10) || '"'
 || case when o_orderkey % 10 = 0 then ',"accession_number":"  "'
   else ',"accession_number":"' || lpad(cast(o_custkey as varchar(20)),10,'0') || '-'
    || substring(cast(year(o_orderdate) as varchar(4)),3,2) || '-'
    || lpad(cast(o_orderkey as varchar(20)),6,'0') || '"' end
 || case when o_orderkey % 4 = 0 then ',"primary_document":null'
   else ',"primary_document":"d' || cast(o_orderkey as varchar(20)) || '.htm"' end
 || case when o_orderkey % 31 = 0 then ',"cik":' || cast(o_custkey as varchar(20))
   else ',"cik":"' || cast(o_custkey as varchar(20)) || '"' end
 || '}}' as item from orders""",
    "fx_dates": """
select o_orderkey as pos, cast(year(o_orderdate) as int) as year,
 case o_orderkey % 9 when 0 then d when 1 then replace(d,'-','')
  when 2 then y || '-W' || lpad(cast(1 + o_custkey % 53 as varchar(2)),2,'0') || '-' || cast(1 + o_orderkey % 7 as varchar(1))
  when 3 then y || 'W' || lpad(cast(1 + o_custkey % 53 as varchar(2)),2,'0')
  when 4 then substring(d,1,7) when 5 then y || '-3-5' when 6 then d || 'T10:00'
  when 7 then ' ' || d || ' ' else y || '-02-30' end as raw_date
 from (select *, substring(cast(cast(o_orderdate as date) as varchar(10)),1,10) as d,
  cast(year(o_orderdate) as varchar(4)) as y from orders) x""",
    "fx_legacy_rows": """
select 'com_t' || cast(o_custkey % 25 as varchar(9)) || '_' || cast(o_orderkey as varchar(20)) as document_id,
 't' || cast(o_custkey % 25 as varchar(9)) as company_ticker,
 case when o_orderkey % 5 = 0 then null else cast(o_orderdate as date) end as date,
 cast(year(o_orderdate) as int) as year,
 case when o_orderkey % 3 = 0 then 'https://www.SEC.gov/ixviewer?doc=' || cast(o_orderkey as varchar(20))
  when o_orderkey % 3 = 1 then null else 'https://c.example.com/news' end as source_url,
 case when o_orderkey % 4 = 0 then 'Annual 10-K' else 'News' end as title,
 case when o_orderkey % 7 = 0 then '' when o_orderkey % 7 = 1 then 'gs://other/source/knowledge/a.html'
  else 'gs://b/source/knowledge/T/' || cast(o_orderkey as varchar(20))
   || case when o_orderkey % 2 = 0 then '.htm' else '' end end as source_gcs_uri,
 case when o_orderstatus = 'F' then 'pdf' else 'html' end as document_type,
 case when o_orderkey % 6 = 0 then '["gs://b/p1","gs://b/p2"]' when o_orderkey % 6 = 1 then '{bad'
  else null end as gemini_chunk_uris,
 o_orderkey as __index_level_0__ from orders""",
    "fx_holdings": """
select cast(s_suppkey % 2 as int) as file_no, cast(s_suppkey as int) as line_no,
 case when s_suppkey % 9 = 0 then '-' when s_suppkey % 9 = 1 then '' when s_suppkey % 9 = 2 then null
  when s_suppkey % 9 = 3 then ' t' || cast(s_nationkey as varchar(9)) || ' '
  else 'T' || cast(s_nationkey as varchar(9)) end as ticker, s_name as name from supplier""",
    "fx_metadata": """
select s_suppkey as row_key, ' s' || cast(s_suppkey as varchar(20)) as company_ticker, s_name || ' ' as company_name,
 'com_s' || cast(s_suppkey as varchar(20)) as company_id,
 'https://s' || cast(s_suppkey as varchar(20)) || '.example.com' as base_url,
 case when s_suppkey % 8 = 7 then 'other' else ' LSEG ' end as provider,
 case when s_suppkey % 10 = 9 then '[]'
  else '{"company_ticker":"s' || cast(s_suppkey as varchar(20)) || ' ","company_name":" ' || s_name || '",'
   || case when s_suppkey % 10 = 8 then '' else '"company_id":"com_s' || cast(s_suppkey as varchar(20)) || '",' end
   || '"base_url":"https://s' || cast(s_suppkey as varchar(20)) || '.example.com","matched_on":"company_ticker+base_url",'
   || '"source_snapshot_uri":"gs://b/snap.json",'
   || case when s_suppkey % 3 = 0 then '"source_snapshot_date":"2026-05-01",' else '' end
   || '"metadata":{"sector":"' || n_name || '","region":' || cast(n_regionkey as varchar(9)) || '},'
   || '"source_record":' || case when s_suppkey % 4 = 0 then 'null' else '{"z":[1,2],"a":"caf' || chr(233) || '"}' end
   || '}' end as response
 from supplier join nation on s_nationkey = n_nationkey""",
    "fx_errors": """
select event_id, case event_id % 9 when 0 then '429 RESOURCE_EXHAUSTED'
 when 1 then '400 INVALID_ARGUMENT file exceeds max allowed file size of 52428800 for `application/pdf` files'
 when 2 then '400 INVALID_ARGUMENT unsupported content' when 3 then 'Deadline_Exceeded'
 when 4 then 'schema mismatch 14290 items' when 5 then 'HTTP 503' when 6 then 'permission denied 403'
 when 7 then 'size 61000017, code 500.' else 'read timed out' end as message,
 case when event_id % 2 = 0 then 'application/pdf' else 'text/html' end as mime_type,
 case when event_id % 5 = 0 then 'chunk' else 'direct' end as stage from events""",
    "fx_outcomes": """
select event_id as pos, 'T' || cast(user_id % 25 as varchar(9)) as company_ticker,
 cast(2021 + user_id % 6 as int) as year,
 case when event_id % 3 = 0 then 'articles' when event_id % 3 = 1 then 'edgar' else 'metadata' end as source_kind,
 case when event_type = 'view' then null when event_type = 'click' then ' Edgar '
  when event_type = 'signup' then 'metadata' when event_type = 'purchase' then 'articles' else 'newsletter' end as source,
 event_type <> 'error' as success, event_type = 'signup' as skipped,
 case when event_type = 'purchase' then null when event_type = 'view' then ''
  else 'gs://b/stage/knowledge/' || cast(event_id as varchar(20)) || '.parquet' end as stage_uri,
 case when event_type = 'view' then 'gs://b/stage/edgar/v1/date=2024-12-31/' || cast(event_id as varchar(20)) || '.parquet'
  when event_type = 'click' then 'gs://b/other/x.parquet' when event_type = 'signup' then 'http://b/k'
  when event_type = 'purchase' then 'gs:///k' else 'gs://b/' end as other_uri,
 case when event_type = 'error' then 'boom ' || cast(event_id % 7 as varchar(3)) else null end as error,
 cast(case when event_type = 'error' then 0 else event_id % 3 end as int) as n_docs from events""",
    "fx_contents": f"""
select {_PAGE_URL} as url, 'gs://raw/' || cast(page_id as varchar(20)) || '.BIN' as source_gcs_uri,
 octet_length({{bytes}}) as n_bytes,
 case when page_id % 12 = 5 then null else html end as text,
 case when page_id % 12 <> 5 then null when page_id % 5 = 0 then '400 INVALID_ARGUMENT unsupported content'
  when page_id % 5 = 1 then 'HTTP 503' when page_id % 5 = 2 then 'permission denied 403'
  else '400 INVALID_ARGUMENT file exceeds max allowed file size of 52428800 for `application/pdf` files' end as error
 from pages
union all
select {_FILING_URL}, 'gs://raw/' || cast(o_orderkey as varchar(20)) || '.htm', n_chars, text, null
 from orders join documents on doc_id = o_orderkey""",
}

# The byte length of a text is the one function the two engines spell apart.
BYTES = {"spark": "html", "check": "encode(html)"}

# Where the given texts are small, so are the limits: both routes are reached.
SETTINGS = Settings(
    source_bucket="b", prod_bucket="b", direct_max_bytes=6_000, chunk_target_bytes=3_000
)
PAGE_TARGET = 2_000
RUN_YEAR = 2026


# A table may be one row group, so one task. Orders are dealt out by their key before items are made
# of them, which are longer; of pages, which are longer than what is made of them, the result is.
SPREAD = {"orders": "o_orderkey"}
SPREAD_MADE = {"fx_article_items": "pos"}
_LANDED: dict[tuple[str, str], str] = {}


def sql(name: str, engine: str) -> str:
    return SQL[name].replace("{bytes}", BYTES[engine])


class Fixtures:
    """Inputs of one scale-factor folder on Spark; everything stays lazy.

    ``own``: filings belong to the customers of their orders, not to a hundred companies.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, own: bool = False):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.own = own

    @cached_property
    def of_customers(self) -> Fixtures:
        return Fixtures(self.spark, self.sf_dir, own=True)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = sql(name, "spark").replace(HUNDRED, OWN if self.own else HUNDRED)
        for table in TABLES:
            if table in text:
                rows = self.table(table)
                rows = rows.repartition(SPREAD[table]) if table in SPREAD else rows
                rows.createOrReplaceTempView(table)
        rows = self.spark.sql(text)
        return rows.repartition(SPREAD_MADE[name]) if name in SPREAD_MADE else rows

    def items(self, name: str) -> DataFrame:
        """Item texts parsed the way landed files are."""
        lines = self.view(name).withColumnRenamed("item", "value")
        return explode_items(lines).drop("item_no")

    @cached_property
    def companies(self) -> DataFrame:
        return normalize.normalize_company(self.view("fx_companies"))

    @cached_property
    def article_items(self) -> DataFrame:
        return normalize.attach_company(self.items("fx_article_items"), self.companies)

    @cached_property
    def filing_items(self) -> DataFrame:
        return normalize.attach_company(self.items("fx_filing_items"), self.companies)

    @cached_property
    def articles(self) -> DataFrame:
        taken = normalize.take_fields(self.items("fx_article_items"))
        items = normalize.attach_company(taken, self.companies)
        return normalize.articles_to_documents(normalize.split_invalid(items).valid)

    @cached_property
    def filings(self) -> DataFrame:
        taken = normalize.take_fields(self.items("fx_filing_items"), filing=True)
        items = normalize.attach_company(taken, self.companies)
        return normalize.filings_to_documents(normalize.split_invalid(items, filing=True).valid)

    def landed(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Derived rows, written once for each folder of tables and session and read from then on."""
        key = (self.sf_dir, f"{name}-{self.own}-{self.spark.sparkContext.applicationId}")
        rows = make()
        if key not in _LANDED:
            path = work_dir(self.spark, name)
            rows.write.parquet(path)
            _LANDED[key] = path
        return self.spark.read.schema(rows.schema).parquet(_LANDED[key])

    @cached_property
    def docs(self) -> DataFrame:
        return self.landed("docs", lambda: normalize.union_sources([self.articles, self.filings]))

    @cached_property
    def objects(self) -> DataFrame:
        """Keys of stored raw files: a share of both families, some nested deeper."""
        stored = (
            F.col("filing_type").isin("8-K", "DEF 14A")
            | ((F.col("source_kind") == "articles") & F.col("url").startswith("https"))
            | (F.col("year") == 2022)
        )
        nested = F.when(F.col("type") == "pdf", "nested/").otherwise("")
        return (
            gates.with_source_key(self.docs.where(stored))
            .select(F.concat("prefix", nested, "filename").alias("key"))
            .distinct()
        )

    @cached_property
    def names(self) -> DataFrame:
        return self.landed("names", lambda: gates.object_names(self.objects))

    @cached_property
    def known(self) -> DataFrame:
        loaded = F.col("primary_document").isNull() & (F.col("source_kind") == "edgar") | (
            F.col("date") == "2024-03-05"
        )
        ids = self.docs.where(loaded).select("source_kind", document_id().alias("document_id"))
        return self.landed("known", ids.distinct)

    @cached_property
    def contents(self) -> DataFrame:
        """Contents of pages and of filings. Those of pages are dealt out by URL with the columns a
        reader takes, so that reading sizes alone does not shuffle texts; filings are dealt by the
        join with their texts."""
        for table in ("pages", "orders", "documents"):
            self.table(table).createOrReplaceTempView(table)
        of_pages, of_filings = sql("fx_contents", "spark").split("\nunion all\n")
        return self.spark.sql(of_pages).repartition("url").unionAll(self.spark.sql(of_filings))

    @cached_property
    def html_pages(self) -> DataFrame:
        raw = self.table("pages").select(
            F.when(F.col("page_id") % 7 == 0, F.concat("url", F.lit("/doc.PDF?x=1")))
            .otherwise(F.col("url")).alias("url"),
            "html",
        )
        return text_pages(raw, "url", "html", "</p>")

    @cached_property
    def text_pages(self) -> DataFrame:
        return text_pages(self.table("documents"), "doc_id")

    @cached_property
    def legacy(self) -> DataFrame:
        return self.view("fx_legacy_rows")

    @cached_property
    def legacy_listing(self) -> DataFrame:
        """URIs that exist: the web sources and the targets of PDF rows."""
        from docflow.operators.migration import with_target

        rows = with_target(self.legacy, "b", RUN_YEAR)
        old = rows.where((F.col("document_type") == "html") & (F.col("source_gcs_uri") != ""))
        new = rows.where((F.col("document_type") == "pdf") & (F.col("title") == "News"))
        return (
            old.select(F.col("source_gcs_uri").alias("uri"))
            .unionAll(new.select(F.col("target_uri").alias("uri")))
            .distinct()
        )

    def ingest_inputs(self) -> Inputs:
        return Inputs(
            requests=build_requests(self.view("fx_companies"), 2021, 2026),
            articles=self.items("fx_article_items"),
            filings=self.items("fx_filing_items"),
            names=self.names,
            known=self.known,
            contents=self.contents,
            pages=self.html_pages,
        )

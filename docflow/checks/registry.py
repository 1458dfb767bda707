"""Every operator as a query over the given tables, with its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from docflow import functions as fn
from docflow.checks import oracle as o
from docflow.checks.fixtures import HUNDRED, OWN, PAGE_TARGET, RUN_YEAR, SETTINGS, Fixtures
from docflow.functions.identity import document_id
from docflow.operators import (
    backfill as bf,
    company_metadata as cm,
    extract,
    gates,
    migration as mg,
    normalize as nz,
    packing,
    records as rc,
    summaries as sm,
)
from docflow.plans import backfill as backfill_plan
from docflow.plans import company_metadata as metadata_plan
from docflow.plans import ingest
from docflow.plans import migrate as migrate_plan

Query = Callable[[Fixtures], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CHUNK_ROOT = SETTINGS.chunk_root
DOCUMENT = (
    "pos, title, company_name, company_id, company_ticker, base_url, year, date, url, type, filepath, "
    "source_kind, filing_type, filing_date, report_date, accession_number, primary_document, cik"
)
COMPANY = "company_ticker, company_name, company_id, base_url"
RECORD = (
    "document_id, company_id, company_ticker, year, title, source_url, source_gcs_uri, document_type, "
    "standard_features, date, gemini_file_uri, gemini_chunk_uris, gemini_chunk_count"
)
FILING = "source_kind, filing_type, filing_date, report_date, accession_number, primary_document, cik"
FEATURES = (
    "summary, array_to_string(key_entities, '|') as key_entities, array_to_string(topics, '|') as topics"
)


def query(name: str, check: str | None = None, own: bool = False) -> Callable[[Query], Query]:
    """Register a query; ``check`` is SQL over the shared CTEs. ``own``: filings belong to the
    customers of their orders."""

    def register(run: Query) -> Query:
        QUERIES[name] = (lambda t: run(t.of_customers)) if own else run
        if check is not None:
            ORACLES[name] = o.assemble(check).replace(HUNDRED, OWN if own else HUNDRED)
        return run

    return register


def cols(names: str) -> list[str]:
    return [n.strip() for n in names.split(",")]


def feature_texts(features: str = "features") -> list:
    f = F.col(features)
    return [
        f["summary"].alias("summary"),
        F.array_join(f["key_entities"], "|").alias("key_entities"),
        F.array_join(f["topics"], "|").alias("topics"),
    ]


def comparable(records: DataFrame, names: str = RECORD) -> DataFrame:
    """Records without their run time, arrays and dates as text."""
    return records.withColumns(
        {
            "date": F.col("date").cast("string"),
            "gemini_chunk_uris": F.array_join("gemini_chunk_uris", "|"),
        }
    ).select(*cols(names))


# ---------------------------------------------------------------- projections


@query("normalize_company", f"select row_key, {COMPANY} from o_companies")
def _(t):
    return t.companies.select("row_key", *cols(COMPANY))


@query("normalize_document", f"select {DOCUMENT} from o_union")
def _(t):
    return nz.normalize_document(t.docs).select(*cols(DOCUMENT))


@query("articles_to_documents", f"select {DOCUMENT} from o_articles")
def _(t):
    return t.articles.select(*cols(DOCUMENT))


@query("filings_to_documents", f"select {DOCUMENT} from o_filings")
def _(t):
    return t.filings.select(*cols(DOCUMENT))


@query("union_sources", "select source_kind, pos, title, cik from o_union")
def _(t):
    return nz.union_sources([t.articles, t.filings]).select("source_kind", "pos", "title", "cik")


@query("attach_company", f"select pos, year, {COMPANY} from o_article_items union all "
       f"select pos, year, {COMPANY} from o_filing_items")
def _(t):
    both = t.article_items.unionByName(t.filing_items)
    return both.select("pos", "year", *cols(COMPANY))


@query("company_years", "select company_ticker, unnest(range(2021, 2027))::int as year from o_companies")
def _(t):
    return nz.company_years(t.companies, 2021, 2026).select("company_ticker", "year")


@query("build_requests", """select company_ticker, y as year, s as source_kind from o_companies
 cross join (select unnest(range(2021, 2027))::int as y) cross join (select unnest(['articles', 'edgar']) as s)""")
def _(t):
    made = ingest.build_requests(t.view("fx_companies"), 2021, 2026)
    return made.select("company_ticker", "year", "source_kind")


@query("drop_index_column", "select document_id, year from fx_legacy_rows")
def _(t):
    slim = mg.drop_index_column(t.legacy.select("document_id", "year", "__index_level_0__"))
    return slim


@query("add_filing_columns", f"""select document_id, year, null::varchar as source_kind, null::varchar as filing_type,
 null::varchar as filing_date, null::varchar as report_date, null::varchar as accession_number,
 null::varchar as primary_document, null::varchar as cik from fx_legacy_rows""")
def _(t):
    return rc.add_filing_columns(t.legacy.select("document_id", "year"))


@query("evolve_schema", """select pos::bigint as pos, title, null::varchar as cik from o_articles
 union all select pos, title, cik from o_filings""")
def _(t):
    return rc.evolve_schema(
        [t.articles.select("pos", "title"), t.filings.select("pos", "title", "cik")]
    )


# -------------------------------------------------------------------- filters


def _invalid(name: str, filing: bool, items: str, reason: str) -> None:
    attribute = items.removeprefix("o_")

    @query(name, f"select pos, {reason} as reject_reason from {items}")
    def _(t):
        marked = nz.mark_invalid(getattr(t, attribute), filing)
        return marked.select("pos", "reject_reason")


_invalid("split_invalid_articles", False, "o_article_items", o.ARTICLE_REASON)
_invalid("split_invalid_filings", True, "o_filing_items", o.FILING_REASON)


@query("split_invalid", f"""select 'articles' as family, ({o.ARTICLE_REASON}) is null as valid, count(*) as n
 from o_article_items group by all union all
 select 'edgar', ({o.FILING_REASON}) is null, count(*) from o_filing_items group by all""")
def _(t):
    def sides(family: str, items: DataFrame, filing: bool) -> DataFrame:
        split = nz.split_invalid(items, filing)
        tagged = split.valid.select(F.lit(True).alias("valid")).unionAll(
            split.rejected.select(F.lit(False).alias("valid"))
        )
        return tagged.select(F.lit(family).alias("family"), "valid")

    both = sides("articles", t.article_items, False).unionAll(
        sides("edgar", t.filing_items, True)
    )
    return both.groupBy("family", "valid").agg(F.count("*").alias("n"))


@query("require_provider", """select row_key, case when provider = 'lseg' then 'lseg' end as provider,
 provider = 'lseg' as valid from o_metadata""")
def _(t):
    valid, rejected = cm.require_provider(t.view("fx_metadata"))
    return valid.select("row_key", "provider", F.lit(True).alias("valid")).unionAll(
        rejected.select("row_key", F.lit(None).cast("string"), F.lit(False))
    )


@query("requested_sources", """select pos, unnest(case when source is null then ['articles', 'edgar']
 else [lower(trim(source))] end) as source_kind from fx_outcomes where source is null
 or lower(trim(source)) in ('articles', 'edgar', 'metadata')""")
def _(t):
    requests = t.view("fx_outcomes").select("pos", "source")
    return nz.expand_sources(requests).valid.select("pos", "source_kind")


@query("requested_sources_rejected", """select pos, source from fx_outcomes where source is not null
 and lower(trim(source)) not in ('articles', 'edgar', 'metadata')""")
def _(t):
    return nz.expand_sources(t.view("fx_outcomes").select("pos", "source")).rejected


@query("legacy_filing_candidates", "select document_id, source_gcs_uri, title from o_candidates")
def _(t):
    found = mg.legacy_filing_candidates(t.legacy, "b")
    return found.select("document_id", "source_gcs_uri", "title")


@query("optional_filters", """select document_id, date::varchar as date, 'ticker' as filter from fx_legacy_rows
 where upper(company_ticker) = 'T7' union all select document_id, date::varchar, 'date' from fx_legacy_rows
 where date = (select max(date) from fx_legacy_rows) union all select document_id, date::varchar, 'both'
 from fx_legacy_rows where upper(company_ticker) = (select max(upper(company_ticker)) from fx_legacy_rows
  where date = (select max(date) from fx_legacy_rows)) and date = (select max(date) from fx_legacy_rows)
 union all select document_id, date::varchar, 'none' from fx_legacy_rows""")
def _(t):
    last = t.legacy.agg(F.max("date").alias("d")).head()["d"]
    ticker = t.legacy.where(F.col("date") == last).agg(F.max(F.upper("company_ticker")).alias("t")).head()["t"]
    asked = {"ticker": ("t7", None), "date": (None, str(last)), "both": (ticker.lower(), last), "none": (None, None)}
    made = [
        mg.optional_filters(t.legacy, *values).select(
            "document_id", F.col("date").cast("string").alias("date"), F.lit(name).alias("filter")
        )
        for name, values in asked.items()
    ]
    return nz.union_sources(made)


@query("route_by_size", f"""select d.pos, d.source_kind, case when d.type = 'pdf' and c.n_bytes >
 {SETTINGS.direct_max_bytes} then 'chunk' else 'direct' end as route
 from o_docs d join fx_contents c on c.url = d.url""")
def _(t):
    sized = t.docs.join(t.contents.select("url", "n_bytes"), "url")
    routed = extract.route_by_size(sized, SETTINGS.direct_max_bytes)
    return routed.select("pos", "source_kind", "route")


@query("valid_holdings", """select file_no, line_no, ticker, name from fx_holdings
 where ticker is not null and ticker not in ('', '-')""")
def _(t):
    return bf.valid_holdings(t.view("fx_holdings"))


@query("classify_outcomes", """select pos, case when skipped then 'skipped' when success then 'processed'
 else 'failed' end as outcome from fx_outcomes""")
def _(t):
    return sm.classify_outcomes(t.view("fx_outcomes")).select("pos", "outcome")


@query("valid_metadata_response", """select row_key, json_type(response) = 'OBJECT'
 and json_exists(response, '$.company_id') as valid from o_metadata""")
def _(t):
    parsed = t.view("fx_metadata").withColumn("response", F.try_parse_json("response"))
    valid, rejected = cm.valid_metadata_response(parsed)
    return valid.select("row_key", F.lit(True).alias("valid")).unionAll(
        rejected.select("row_key", F.lit(False))
    )


_MOVE = """case when coalesce(c.source_gcs_uri, '') = '' then '{absent}'
 when not regexp_matches(c.source_gcs_uri, '^gs://[^/]+/.+') then 'error'
 when c.source_gcs_uri = c.target_uri then 'noop' {rest} end"""
_LEGACY_TARGET = "(select *, 'gs://b/' || target_key as target_uri from o_legacy) c"
_EXECUTE = """when exists (select 1 from o_listing l where l.uri = c.source_gcs_uri) then 'move'
 when exists (select 1 from o_listing l where l.uri = c.target_uri) then 'moved' else 'missing'"""


@query("classify_moves", f"""select document_id, {_MOVE.format(absent='missing', rest=_EXECUTE)} as move
 from {_LEGACY_TARGET}""")
def _(t):
    targeted = mg.with_target(t.legacy, "b", RUN_YEAR)
    located = mg.exists_in_listing(targeted, t.legacy_listing)
    return mg.classify_moves(located, allow_missing=True).select("document_id", "move")


@query("classify_moves_dry_run", f"""select document_id,
 {_MOVE.format(absent='error', rest="else 'planned'")} as move from {_LEGACY_TARGET}""")
def _(t):
    targeted = mg.with_target(t.legacy, "b", RUN_YEAR)
    return mg.classify_moves(targeted, dry_run=True).select("document_id", "move")


@query("valid_uri", """select pos, coalesce(regexp_matches(stage_uri, '^gs://[^/]+/.+'), false) as stage_ok,
 coalesce(regexp_matches(other_uri, '^gs://[^/]+/stage/(knowledge|edgar/v1)/'), false) as promotable
 from fx_outcomes""")
def _(t):
    rows = t.view("fx_outcomes").select("pos", "stage_uri", "other_uri")

    def flag(split, name: str) -> DataFrame:
        return split.valid.select("pos", F.lit(True).alias(name)).unionAll(
            split.rejected.select("pos", F.lit(False))
        )

    stage = flag(sm.valid_uri(rows, "stage_uri"), "stage_ok")
    return stage.join(flag(sm.valid_uri(rows, "other_uri", True), "promotable"), "pos")


@query("has_stage_uri", """select pos, coalesce(nullif(stage_uri, ''), nullif(other_uri, '')) as load_uri
 from fx_outcomes where coalesce(nullif(stage_uri, ''), nullif(other_uri, '')) is not null""")
def _(t):
    return sm.has_stage_uri(t.view("fx_outcomes"), "other_uri").valid.select("pos", "load_uri")


# Every third user's sources found nothing; some of these failed.
_FOUND = "case when pos % 2 = 0 or right(company_ticker, 1) in ('1', '4', '7') then 0 else n_docs end"


@query("fail_if_all_sources_failed", f"""select company_ticker, year, 'Document discovery failed for ' || company_ticker
 || ': ' || concat_ws('; ', 'articles: ' || a, 'edgar: ' || e) as message, true as raises from (
 select company_ticker, year, sum({_FOUND}) as n, count(error) as errors,
  arg_min(error, pos) filter (source_kind = 'articles' and error is not null) as a,
  arg_min(error, pos) filter (source_kind = 'edgar' and error is not null) as e
 from fx_outcomes group by all) where n = 0 and errors > 0""")
def _(t):
    sources = t.view("fx_outcomes").withColumn("n_docs", F.expr(_FOUND))
    try:
        sm.fail_if_all_sources_failed(sources)
        raised = False
    except RuntimeError:
        raised = True
    return sm.failed_discoveries(sources).withColumn("raises", F.lit(raised))


# ---------------------------------------------------------------------- joins


@query("anti_join_stored", "select source_kind, pos, prefix, filename from o_stored where not stored")
def _(t):
    fresh = gates.anti_join_stored(t.docs, t.names)
    return fresh.select("source_kind", "pos", "prefix", "filename")


@query("split_known", """select d.source_kind, d.pos, k.document_id is not null as skipped, d.document_id
 from o_docs d left join o_known k on k.source_kind = d.source_kind and k.document_id = d.document_id""")
def _(t):
    return gates.mark_known(t.docs, t.known).select(
        "source_kind", "pos", "skipped", "document_id"
    )


@query("exists_probe", """select d.source_kind, d.pos from o_docs d where exists (select 1 from o_known k
 where k.source_kind = d.source_kind and k.document_id = d.document_id)""")
def _(t):
    keyed = t.docs.withColumn("document_id", document_id())
    found = gates.split_known(t.docs, t.known).rejected.select("source_kind", "pos", "document_id")
    # The probe takes one id; it must agree with the join on the first id of either side.
    stored = t.known.agg(F.min("document_id")).head()[0]
    if stored is not None and not gates.exists_probe(t.known, stored):
        raise RuntimeError("a stored id was not found")
    lacking = keyed.join(t.known, "document_id", "left_anti").agg(F.min("document_id")).head()[0]
    if lacking is not None and gates.exists_probe(t.known, lacking):
        raise RuntimeError("an id that is not stored was found")
    return found.drop("document_id")


@query("exists_in_listing", f"""select document_id,
 exists (select 1 from o_listing l where l.uri = c.source_gcs_uri) as source_exists,
 exists (select 1 from o_listing l where l.uri = c.target_uri) as target_exists from {_LEGACY_TARGET}""")
def _(t):
    targeted = mg.with_target(t.legacy, "b", RUN_YEAR)
    located = mg.exists_in_listing(targeted, t.legacy_listing)
    return located.select("document_id", "source_exists", "target_exists")


def _text_chunks(t: Fixtures) -> DataFrame:
    packed = packing.pack_pages(t.text_pages, PAGE_TARGET, "doc_id").valid
    texts = packing.chunk_texts(t.text_pages, packed, "doc_id")
    return extract.extract_features(texts, text="chunk_text")


_CHUNK_URIS = """array_to_string(list_transform(generate_series(1, chunk_count), lambda i:
 'gs://b/stage/knowledge/gemini_chunks/' || doc || '/part-' || lpad(i::varchar, 5, '0') || '.pdf'), '|')
 as gemini_chunk_uris"""


@query("chunks_to_documents", f"""select doc as doc_id, lang, source, summary, chunk_count as gemini_chunk_count,
 {_CHUNK_URIS} from tp_merged join documents on doc_id = doc""")
def _(t):
    docs = t.table("documents").select("doc_id", "lang", "source")
    made = extract.chunks_to_documents(_text_chunks(t), docs, CHUNK_ROOT, "doc_id")
    return made.select(
        "doc_id", "lang", "source", F.col("features.summary").alias("summary"),
        "gemini_chunk_count", F.array_join("gemini_chunk_uris", "|").alias("gemini_chunk_uris"),
    )


# --------------------------------------------------------------- aggregations


@query("run_summary", """select r.company_ticker as company, r.year, null::varchar as source,
 coalesce(c.discovered, 0) as discovered, case when coalesce(c.new, 0) = 0 then 0 end as ingested,
 case when c.new > 0 then c.processed end as processed, case when c.new > 0 then c.skipped end as skipped,
 case when c.new > 0 then c.processed end as promoted,
 case when c.new > 0 then nullif(concat_ws('; ', 'articles: ' || e.a, 'edgar: ' || e.e), '') end as source_errors,
 case when coalesce(c.discovered, 0) = 0 then 'No documents found.' when c.new = 0
 then 'All documents already ingested.' else 'Ingestion completed.' end as message
 from (select company_ticker, y as year from o_companies cross join (select unnest(range(2021, 2027))::int as y)) r
 left join (select company_ticker, year, count(*) as discovered, count(*) filter (pos % 5 <> 0) as new,
  count(*) filter (success and not skipped and pos % 5 <> 0) as processed,
  count(*) filter (skipped and pos % 5 <> 0) as skipped
  from fx_outcomes group by all) c
 on c.company_ticker = r.company_ticker and c.year = r.year
 left join (select company_ticker, year, arg_min(error, pos) filter (source_kind = 'articles') as a,
  arg_min(error, pos) filter (source_kind = 'edgar') as e from fx_outcomes where error is not null group by all) e
 on e.company_ticker = r.company_ticker and e.year = r.year""")
def _(t):
    requests = ingest.request_keys(ingest.build_requests(t.view("fx_companies"), 2021, 2026))
    rows = t.view("fx_outcomes")
    results = sm.classify_outcomes(rows)
    # Gate 1 found every fifth file.
    stored = F.col("pos") % 5 == 0
    outcomes = results.select(
        "company_ticker", "year",
        F.when(stored, "stored").otherwise(F.col("outcome")).alias("outcome"),
        F.lit(1).cast("long").alias("n"),
        ((F.col("outcome") == "processed") & ~stored).alias("promoted"),
    )
    errors = rows.select("company_ticker", "year", "source_kind", "pos", "error")
    return sm.run_summary(requests, outcomes, errors)


@query("success_counts", """select company_ticker, year, count(*) filter (success) as successes,
 count(*) as total from fx_outcomes group by all""")
def _(t):
    return sm.success_counts(t.view("fx_outcomes"))


def _placed(ordered: DataFrame) -> DataFrame:
    """The place of each row in the order a frame has, from 1: partitions before it, then its own."""
    marked = ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_at", 33)
    )
    sizes = marked.groupBy("_part").agg(F.count("*").alias("_n"))
    run = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("_part", F.coalesce(run, F.lit(0)).alias("_before"))  # a row per partition
    place = F.col("_before") + F.col("_at") % (1 << 33) + 1
    return marked.join(before, "_part").withColumn("place", place).drop("_at", "_part", "_before")


@query("planned_by_date", """select row_date as partition_date, count(*) as row_count,
 row_number() over (order by row_date) as place from o_candidates group by row_date""")
def _(t):
    return _placed(mg.planned_by_date(mg.legacy_filing_candidates(t.legacy, "b"), RUN_YEAR))


@query("move_counts", f"""select count(*) filter (move in ('noop', 'move', 'moved')) as moved,
 count(*) filter (move = 'missing') as missing from (
 select {_MOVE.format(absent='missing', rest=_EXECUTE)} as move from {_LEGACY_TARGET})""")
def _(t):
    targeted = mg.with_target(t.legacy, "b", RUN_YEAR)
    located = mg.exists_in_listing(targeted, t.legacy_listing)
    return mg.move_counts(mg.classify_moves(located, allow_missing=True))


@query("table_row_count", "select count(*) as row_count from fx_legacy_rows")
def _(t):
    return sm.table_row_count(t.legacy)


_TABLE = "case source_kind when 'edgar' then 'edgar' when 'metadata' then 'company_metadata' else 'documents' end"


@query("load_row_counts", f"""select {_TABLE} as table_id, stage_uri as source_uri, count(*) as row_count
 from fx_outcomes group by all""")
def _(t):
    routed = sm.route_to_table(t.view("fx_outcomes"))
    return sm.load_row_counts(routed.withColumnRenamed("stage_uri", "source_uri"))


@query("route_to_table", f"select pos, {_TABLE} as table_id from fx_outcomes")
def _(t):
    return sm.route_to_table(t.view("fx_outcomes")).select("pos", "table_id")


@query("merge_chunk_features", f"select doc as doc_id, {FEATURES}, chunk_count from tp_merged")
def _(t):
    merged = extract.merge_chunk_features(_text_chunks(t), "doc_id")
    return merged.select("doc_id", *feature_texts(), "chunk_count")


@query("chunk_metadata", f"""select doc as doc_id, chunk_count as gemini_chunk_count, {_CHUNK_URIS}
 from (select doc, max(chunk_no) as chunk_count from tp_packed group by doc)""")
def _(t):
    packed = packing.pack_pages(t.text_pages, PAGE_TARGET, "doc_id").valid
    chunks = packing.chunk_sizes(packed, "doc_id")
    made = extract.chunk_metadata(chunks, CHUNK_ROOT, "doc_id")
    return made.withColumn("gemini_chunk_uris", F.array_join("gemini_chunk_uris", "|"))


@query("error_details", """select company_ticker, year, concat_ws('; ', 'articles: ' || a, 'edgar: ' || e)
 as error_details from (select company_ticker, year,
  arg_min(error, pos) filter (source_kind = 'articles') as a,
  arg_min(error, pos) filter (source_kind = 'edgar') as e
 from fx_outcomes where error is not null group by all)""")
def _(t):
    return sm.error_details(t.view("fx_outcomes"))


@query("stored_names_by_prefix", """select p as prefix, split_part(key, '/', -1) as filename from (
 select key, unnest(list_transform(generate_series(4, len(string_split(key, '/')) - 1),
  lambda n: array_to_string(string_split(key, '/')[1:n], '/') || '/')) as p from o_objects) group by all""")
def _(t):
    return gates.stored_names_by_prefix(t.names)


@query("discovery_counts", """select d.source_kind, count(*) as discovered,
 count(*) filter (not stored) as new_documents from o_flagged d group by d.source_kind""")
def _(t):
    return gates.discovery_counts(t.docs, gates.anti_join_stored(t.docs, t.names))


# ------------------------------------------------------ windows, order, limits


@query("first_company_per_ticker", """select upper(trim(ticker)) as ticker, arg_min(name, (file_no, line_no)) as name
 from fx_holdings where ticker is not null and ticker not in ('', '-') group by all""")
def _(t):
    return bf.first_company_per_ticker(bf.valid_holdings(t.view("fx_holdings")))


@query("number_chunks", "select doc_id, page_no as chunk_no, page_text as part from fx_text_pages")
def _(t):
    parts = t.table("documents").select("doc_id", F.split("text", "\n").alias("parts"))
    return packing.number_chunks(parts, "parts", "doc_id")


@query("pack_pages", "select doc as doc_id, page_no, n_bytes, chunk_no from tp_packed")
def _(t):
    return packing.pack_pages(t.text_pages, PAGE_TARGET, "doc_id").valid


@query("pack_pages_rejected", f"""select doc_id, max(n_bytes) as largest_page, count(*) as n_over_target
 from fx_text_pages where n_bytes > {PAGE_TARGET} group by doc_id""")
def _(t):
    return packing.pack_pages(t.text_pages, PAGE_TARGET, "doc_id").rejected


@query("chunk_sizes", """select doc as doc_id, chunk_no, min(page_no) as first_page, max(page_no) as last_page,
 count(*) as n_pages, sum(n_bytes)::bigint as chunk_bytes from tp_packed group by all""")
def _(t):
    packed = packing.pack_pages(t.text_pages, PAGE_TARGET, "doc_id").valid
    return packing.chunk_sizes(packed, "doc_id")


@query("one_per_ingestion_key", """select ingestion_key, arg_min(pos, pos) as pos, count(*) as n_same_key
 from o_docs group by ingestion_key""")
def _(t):
    return gates.one_per_ingestion_key(t.docs).select("ingestion_key", "pos", "n_same_key")


# Filings have a key each, so documents of three companies' filings share a file name here.
_SHARED = "case when source_kind = 'edgar' and pos % 3 = 0 then 'x/annual.htm' else filepath end"


@query("mark_duplicates", f"""select source_kind, pos, key as ingestion_key,
 row_number() over (partition by key order by pos) > 1 as duplicate from (select *, 'knowledge-ingestion-'
 || company_ticker || '-' || year || '-' || source_kind || '-' || split_part({_SHARED}, '/', -1) as key from o_docs)""")
def _(t):
    docs = t.docs.withColumn("filepath", F.expr(_SHARED))
    return gates.mark_duplicates(docs).select("source_kind", "pos", "ingestion_key", "duplicate")


@query("order_candidates", """select document_id, company_ticker, date::varchar as date, row_number() over (
 order by company_ticker nulls first, date nulls first, document_id) as place from o_candidates""")
def _(t):
    ordered = mg.order_candidates(mg.legacy_filing_candidates(t.legacy, "b"))
    return _placed(ordered).select(
        "document_id", "company_ticker", F.col("date").cast("string").alias("date"), "place"
    )


@query("limit_candidates", """select document_id, company_ticker, date::varchar as date from o_candidates
 order by company_ticker nulls first, date nulls first, document_id limit 100""")
def _(t):
    top = mg.limit_candidates(mg.legacy_filing_candidates(t.legacy, "b"), 100)
    return top.select("document_id", "company_ticker", F.col("date").cast("string").alias("date"))


@query("latest_key", "select max(key) as key from o_objects")
def _(t):
    return cm.latest_key(t.objects)


# ----------------------------------------------------------- scalar functions


@query("document_id", "select source_kind, pos, document_id from o_docs")
def _(t):
    return t.docs.select("source_kind", "pos", fn.document_id().alias("document_id"))


@query("metadata_id", "select row_key, metadata_id from o_metadata_id")
def _(t):
    asked = cm.require_provider(nz.normalize_company(t.view("fx_metadata"))).valid
    asked = asked.withColumn("year", F.lit(RUN_YEAR))
    return asked.select("row_key", fn.metadata_id().alias("metadata_id"))


@query("document_type", "select source_kind, pos, type from o_docs")
def _(t):
    def typed(items: DataFrame, kind: str, filing: bool) -> DataFrame:
        valid = nz.split_invalid(items, filing).valid
        return valid.select(F.lit(kind).alias("source_kind"), "pos", fn.document_type().alias("type"))

    return typed(t.article_items, "articles", False).unionAll(typed(t.filing_items, "edgar", True))


@query("document_filepath", "select source_kind, pos, filepath from o_docs")
def _(t):
    return t.docs.select("source_kind", "pos", "filepath")


@query("partition_date", f"select pos, {o._iso('raw_date', 'year')} as partition_date from fx_dates")
def _(t):
    return t.view("fx_dates").select("pos", fn.partition_date("raw_date").alias("partition_date"))


@query("row_date", "select document_id, row_date from o_legacy")
def _(t):
    return t.legacy.select("document_id", fn.row_date(current_year=RUN_YEAR).alias("row_date"))


@query("source_prefix", "select source_kind, pos, prefix from o_docs")
def _(t):
    return t.docs.select("source_kind", "pos", fn.source_prefix().alias("prefix"))


@query("source_filename", "select source_kind, pos, filename from o_docs")
def _(t):
    return t.docs.select("source_kind", "pos", fn.source_filename().alias("filename"))


@query("source_extension", f"""select document_id, coalesce({o.suffix('source_gcs_uri')},
 case when document_type = 'pdf' then 'pdf' else 'html' end) as extension from fx_legacy_rows""")
def _(t):
    ext = fn.source_extension("source_gcs_uri", "document_type")
    return t.legacy.select("document_id", ext.alias("extension"))


@query("filing_source_key", f"""select pos, prefix || document_id || '.' || coalesce({o.suffix('url')},
 case when type = 'pdf' then 'pdf' else 'html' end) as source_key from o_docs where source_kind = 'edgar'""")
def _(t):
    return t.filings.select("pos", fn.filing_source_key("url").alias("source_key"))


@query("stage_key", "select source_kind, pos, stage_key from o_docs")
def _(t):
    key = fn.stage_key(fn.document_id())
    return t.docs.select("source_kind", "pos", key.alias("stage_key"))


@query("prod_key", """select pos, case when key like 'stage/knowledge/%' or key like 'stage/edgar/v1/%'
 then 'prod' || substr(key, 6) end as prod_key from (select pos,
 nullif(regexp_extract(stage_uri, '^gs://[^/]+/(.+)$', 1), '') as key from fx_outcomes)""")
def _(t):
    return t.view("fx_outcomes").select("pos", fn.prod_key(fn.uri_key("stage_uri")).alias("prod_key"))


@query("parse_uri", """select pos, nullif(regexp_extract(other_uri, '^gs://([^/]+)/(.+)$', 1), '') as bucket,
 nullif(regexp_extract(other_uri, '^gs://([^/]+)/(.+)$', 2), '') as key from fx_outcomes""")
def _(t):
    return t.view("fx_outcomes").select(
        "pos", fn.uri_bucket("other_uri").alias("bucket"), fn.uri_key("other_uri").alias("key")
    )


@query("mime_type", "select source_kind, pos, mime_type from o_docs")
def _(t):
    return t.docs.select("source_kind", "pos", fn.mime_type().alias("mime_type"))


@query("prod_filing_key", """select document_id, 'prod/edgar/v1/date=' || row_date || '/' || document_id
 || '.parquet' as prod_key from o_legacy""")
def _(t):
    key = fn.prod_filing_key(fn.row_date(current_year=RUN_YEAR))
    return t.legacy.select("document_id", key.alias("prod_key"))


@query("metadata_stage_key", """select row_key, 'stage/knowledge/company_metadata/provider=lseg/ticker=' ||
 company_ticker || '/year=2026/' || metadata_id || '.parquet' as stage_key from o_metadata_id""")
def _(t):
    asked = cm.require_provider(nz.normalize_company(t.view("fx_metadata"))).valid
    asked = asked.withColumn("year", F.lit(RUN_YEAR)).withColumn("metadata_id", fn.metadata_id())
    return asked.select("row_key", fn.metadata_stage_key().alias("stage_key"))


@query("ingestion_key", "select source_kind, pos, ingestion_key from o_docs")
def _(t):
    return t.docs.select("source_kind", "pos", fn.ingestion_key().alias("ingestion_key"))


@query("cik10", """select o_orderkey as pos, case when length(x) < 10 then lpad(x, 10, '0') else x end as cik
 from (select o_orderkey, o_custkey::varchar || repeat('7', (o_orderkey % 12)::int) as x from orders)""")
def _(t):
    tail = F.expr("repeat('7', cast(o_orderkey % 12 as int))")
    cik = F.concat(F.col("o_custkey").cast("string"), tail)
    return t.table("orders").select(F.col("o_orderkey").alias("pos"), fn.cik10(cik).alias("cik"))


@query("chunk_key", """select doc_id, page_no, 'p/x/' || doc_id || '/part-' || case when page_no < 100000
 then lpad(page_no::varchar, 5, '0') else page_no::varchar end || '.pdf' as chunk_key from fx_text_pages""")
def _(t):
    key = fn.chunk_key("/p/x/", "doc_id", "page_no")
    return t.text_pages.select("doc_id", "page_no", key.alias("chunk_key"))


@query("features_json", f"select k as doc_id, {o.to_json_features()} as standard_features from t_features")
def _(t):
    made = extract.extract_features(t.table("documents").select("doc_id", "text"))
    return made.select("doc_id", fn.features_json("features").alias("standard_features"))


@query("sorted_json", r"""select row_key, case when json_type(response) <> 'OBJECT'
 or json_type(response->'$.source_record') = 'NULL' then 'null'
 else '{"a": "caf\u00e9", "z": [1, 2]}' end as source_record,
 case when json_type(response) <> 'OBJECT' then 'null' else '{"region": '
 || json_extract_string(response, '$.metadata.region') || ', "sector": "'
 || json_extract_string(response, '$.metadata.sector') || '"}' end as metadata
 from o_metadata""")
def _(t):
    objects = t.view("fx_metadata")

    def part(name: str):
        text = F.coalesce(F.get_json_object("response", f"$.{name}"), F.lit("null"))
        return fn.sorted_json(text).alias(name)

    return objects.select("row_key", part("source_record"), part("metadata"))


@query("json_list_or_empty", """select document_id, case when gemini_chunk_uris is null then null
 when gemini_chunk_uris like '[%' then 'gs://b/p1|gs://b/p2' else '' end as chunk_uris from fx_legacy_rows""")
def _(t):
    parsed = fn.json_list_or_empty("gemini_chunk_uris")
    return t.legacy.select("document_id", F.array_join(parsed, "|").alias("chunk_uris"))


_FLAGS = o.error_flags("message")
for _name, _flag in (
    ("is_invalid_argument", "invalid"), ("is_file_size_error", "size"), ("is_transient", "transient"),
):
    def _register(name: str, flag: str) -> None:
        @query(name, f"select event_id, {_FLAGS[flag]} as {name} from fx_errors")
        def _(t):
            return t.view("fx_errors").select("event_id", getattr(fn, name)("message").alias(name))

    _register(_name, _flag)


@query("error_outcome", f"""select event_id, {o.outcome_sql('message', 'mime_type', "stage = 'direct'")} as outcome
 from fx_errors""")
def _(t):
    return extract.classify_errors(t.view("fx_errors")).select("event_id", "outcome")


@query("default_company_id", "select row_key, company_id from o_companies")
def _(t):
    rows = t.view("fx_companies")
    made = fn.default_company_id("company_id", fn.strip("company_ticker"))
    return rows.select("row_key", made.alias("company_id"))


@query("search_base_url", "select s_suppkey, 'https://www.google.com/search?q=' || s_name as base_url from supplier")
def _(t):
    return t.table("supplier").select("s_suppkey", fn.search_base_url("s_name").alias("base_url"))


# ----------------------------------------------------------------- extraction


@query("extract_features", f"select k as doc_id, {FEATURES} from t_features")
def _(t):
    made = extract.extract_features(t.table("documents").select("doc_id", "text"))
    return made.select("doc_id", *feature_texts())


@query("extract_chunked", f"select doc as doc_id, {FEATURES}, chunk_count from tp_merged")
def _(t):
    made = extract.extract_chunked(t.text_pages, PAGE_TARGET, doc="doc_id").valid
    return made.select("doc_id", *feature_texts(), "chunk_count")


@query("placeholder_features", f"""select event_id, case when
 {o.outcome_sql('message', 'mime_type', "stage = 'direct'")} = 'empty' then '{o.PLACEHOLDER}' end as summary
 from fx_errors""")
def _(t):
    made = extract.placeholder_for_errors(t.view("fx_errors"))
    return made.select("event_id", F.col("features.summary").alias("summary"))


# -------------------------------------------------------------------- records


@query("resolve_source_uri", """select d.pos, d.source_kind, coalesce(case when d.pos % 3 = 0 then 'gs://given/'
 || d.pos end, c.source_gcs_uri) as source_gcs_uri, d.pos % 3 <> 0 as needs_fetch
 from o_docs d left join fx_contents c on c.url = d.url""")
def _(t):
    given = F.col("pos") % 3 == 0
    docs = t.docs.withColumns(
        {
            "downloaded": given,
            "gcs_uri": F.when(given, F.concat(F.lit("gs://given/"), F.col("pos").cast("string"))),
        }
    )
    fetched = t.contents.select("url", F.col("source_gcs_uri").alias("fetched_uri"))
    made = rc.resolve_source_uri(docs, fetched)
    return made.select("pos", "source_kind", "source_gcs_uri", "needs_fetch")


@query("plan_relocation", f"""select d.pos, d.source_kind, c.source_gcs_uri, case when d.source_kind = 'edgar'
 then 'gs://b/' || d.prefix || d.document_id || '.' || coalesce({o.suffix('c.source_gcs_uri')},
  case when d.type = 'pdf' then 'pdf' else 'html' end) else c.source_gcs_uri end as target_gcs_uri,
 d.source_kind = 'edgar' as needs_move from o_docs d join fx_contents c on c.url = d.url""")
def _(t):
    located = t.docs.join(t.contents.select("url", "source_gcs_uri"), "url")
    made = rc.plan_relocation(located, "b")
    return made.select("pos", "source_kind", "source_gcs_uri", "target_gcs_uri", "needs_move")


def _run(t: Fixtures) -> ingest.RunResult:
    return ingest.ingest_companies(t.ingest_inputs(), SETTINGS)


@query("build_records", f"select {RECORD}, {FILING} from o_records_c")
def _(t):
    return comparable(_run(t).records, f"{RECORD}, {FILING}")


@query("records_run_time", """select document_id, source_kind, '2026-03-04 05:06:07.89' as ingestion_timestamp
 from o_records_c""")
def _(t):
    at = F.lit("2026-03-04 05:06:07.89").cast("timestamp")
    made = ingest.ingest_companies(t.ingest_inputs(), SETTINGS, at).records
    return made.select("document_id", "source_kind", F.col("ingestion_timestamp").cast("string"))


@query("ingest_documents", f"select {RECORD} from o_records_c where source_kind = 'articles'")
def _(t):
    return comparable(rc.family_records(_run(t).records, "articles"))


@query("ingest_filings", f"select {RECORD}, {FILING} from o_records_c where source_kind = 'edgar'")
def _(t):
    return comparable(rc.family_records(_run(t).records, "edgar"), f"{RECORD}, {FILING}")


@query("normalize_legacy_rows", """select document_id, target_uri as source_gcs_uri, 'edgar' as source_kind,
 row_date as date, case when gemini_chunk_uris is null then null when gemini_chunk_uris like '[%'
 then 'gs://b/p1|gs://b/p2' else '' end as gemini_chunk_uris from o_candidates""")
def _(t):
    rows = mg.with_target(mg.legacy_filing_candidates(t.legacy, "b"), "b", RUN_YEAR)
    made = mg.normalize_legacy_rows(rows, RUN_YEAR)
    return made.select(
        "document_id", "source_gcs_uri", "source_kind", F.col("date").cast("string").alias("date"),
        F.array_join("gemini_chunk_uris", "|").alias("gemini_chunk_uris"),
    )


# ---------------------------------------------------------------- whole plans

_SUMMARY = """select r.company_ticker as company, r.year, null::varchar as source,
 coalesce(c.discovered, 0) as discovered, case when coalesce(c.new, 0) = 0 then 0 end as ingested,
 case when c.new > 0 then c.processed end as processed, case when c.new > 0 then c.skipped end as skipped,
 case when c.new > 0 then c.processed end as promoted, null::varchar as source_errors,
 case when coalesce(c.discovered, 0) = 0 then 'No documents found.' when c.new = 0
 then 'All documents already ingested.' else 'Ingestion completed.' end as message
 from (select company_ticker, y as year from o_companies cross join (select unnest(range(2021, 2027))::int as y)) r
 left join o_counted c on c.company_ticker = r.company_ticker and c.year = r.year"""


@query("ingest_companies", _SUMMARY, own=True)
def _(t):
    return _run(t).summary


@query("ingest_rejected", f"""select 'articles' as source_kind, company_ticker, year, pos, reason as reject_reason
 from (select *, ({o.ARTICLE_REASON}) as reason from o_article_items) where reason is not null
 and year between 2021 and 2026 union all select 'edgar', company_ticker, year, pos, reason
 from (select *, ({o.FILING_REASON}) as reason from o_filing_items) where reason is not null
 and year between 2021 and 2026""")
def _(t):
    return _run(t).rejected


@query("ingest_company_metadata", r"""select metadata_id, m.company_ticker, m.company_name, m.company_id, m.base_url,
 2026 as year, 'lseg' as provider, 'company_ticker+base_url' as matched_on, 'gs://b/snap.json' as source_snapshot_uri,
 json_extract_string(m.response, '$.source_snapshot_date') as source_snapshot_date,
 '{"region": ' || json_extract_string(m.response, '$.metadata.region') || ', "sector": "'
 || json_extract_string(m.response, '$.metadata.sector') || '"}' as metadata_json,
 case when json_type(m.response->'$.source_record') = 'NULL' then '{}'
 else '{"a": "caf\u00e9", "z": [1, 2]}' end as source_record_json
 from o_metadata_ok m join o_metadata_id i on i.row_key = m.row_key""")
def _(t):
    return _metadata(t).rows.drop("ingestion_timestamp")


@query("company_metadata_summary", """select i.company_ticker as company, 'metadata' as source,
 case when k.row_key is not null then 'lseg' end as provider, (k.row_key is not null)::bigint as discovered,
 (k.row_key is not null)::bigint as processed, (k.row_key is not null)::bigint as promoted,
 case when k.row_key is not null then metadata_id end as metadata_id,
 case when k.row_key is not null then 'gs://b/prod/knowledge/company_metadata/provider=lseg/ticker=' ||
  i.company_ticker || '/year=2026/' || metadata_id || '.parquet' end as prod_gcs_uri,
 case when k.row_key is not null then 'Company metadata ingestion completed.'
 else 'No company metadata found.' end as message
 from o_metadata_id i left join o_metadata_ok k on k.row_key = i.row_key""")
def _(t):
    return _metadata(t).summary


def _metadata(t: Fixtures) -> metadata_plan.MetadataResult:
    rows = cm.require_provider(t.view("fx_metadata")).valid
    ticker = F.upper(fn.strip("company_ticker"))
    responses = rows.select(
        ticker.alias("company_ticker"), F.lit(RUN_YEAR).alias("year"), "provider",
        F.col("response").alias("body"), F.try_parse_json("response").alias("response"),
    )
    companies = rows.select("company_ticker", "company_name", "company_id", "base_url")
    return metadata_plan.ingest_company_metadata(companies, responses, RUN_YEAR)


@query("backfill_companies", "select company_ticker, company_name, company_id, base_url from o_backfill_companies")
def _(t):
    return backfill_plan.backfill_companies(t.view("fx_holdings"))


def _backfill(t: Fixtures) -> backfill_plan.BackfillResult:
    return backfill_plan.backfill(
        t.view("fx_holdings"), t.items("fx_filing_items"), t.names, t.known,
        t.contents, t.html_pages, SETTINGS,
    )


@query("backfill", """select company_ticker, year, count(*) as total, (count(*) filter (skipped)
 + count(*) filter (not skipped and done)) as successes from (
 select g.company_ticker, g.year, g.skipped, coalesce(m.summary is not null, false) as done
 from o_backfill_gated g left join o_made_b m on m.pos = g.pos) group by all""")
def _(t):
    return _backfill(t).counts


@query("backfill_records", f"select {RECORD}, {FILING} from o_records_b")
def _(t):
    return comparable(_backfill(t).records, f"{RECORD}, {FILING}")


def _migration(t: Fixtures, **options) -> migrate_plan.MigrationPlan:
    return migrate_plan.plan_migration(
        t.legacy, t.legacy_listing, "b", "b", allow_missing=True, current_year=RUN_YEAR, **options
    )


@query("migrate_filings", """select c.document_id, c.source_gcs_uri, c.target_uri, case when c.source_gcs_uri = c.target_uri
 then 'noop' when exists (select 1 from o_listing l where l.uri = c.source_gcs_uri) then 'move'
 when exists (select 1 from o_listing l where l.uri = c.target_uri) then 'moved' else 'missing' end as move
 from o_candidates c""")
def _(t):
    return _migration(t).moves.select("document_id", "source_gcs_uri", "target_uri", "move")


@query("migrate_filings_prod_uris", """select document_id, 'gs://b/prod/edgar/v1/date=' || row_date || '/'
 || document_id || '.parquet' as prod_uri from o_candidates""")
def _(t):
    return _migration(t).prod_uris

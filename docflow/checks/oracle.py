"""Independent SQL for the checking engine, assembled from shared CTEs."""

from __future__ import annotations

import re

from docflow.checks.fixtures import PAGE_TARGET, RUN_YEAR, SETTINGS, SQL, sql
from docflow.functions.text import WHITESPACE

_WS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def _iso(date: str, year: str) -> str:
    """Partition date text of a date text."""
    d = f"trim({date}, ' ')"
    compact = f"substr({d},1,4) || '-' || substr({d},5,2) || '-' || substr({d},7,2)"
    week_one = f"{d} || '-1'"
    dashed_week = f"substr({d},1,4) || '-W' || substr({d},6,2) || '-1'"

    def week(text: str) -> str:
        parsed = f"try_strptime({text}, '%G-W%V-%u')"
        return f"case when strftime({parsed}, '%G-W%V-%u') = {text} then {parsed}::date::varchar end"

    return f"""coalesce(case
 when regexp_full_match({d}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then try_cast({d} as date)::varchar
 when regexp_full_match({d}, '[0-9]{{8}}') then try_cast({compact} as date)::varchar
 when regexp_full_match({d}, '[0-9]{{4}}-W[0-9]{{2}}-[0-9]') then {week(d)}
 when regexp_full_match({d}, '[0-9]{{4}}-W[0-9]{{2}}') then {week(week_one)}
 when regexp_full_match({d}, '[0-9]{{4}}W[0-9]{{2}}') then {week(dashed_week)}
 end, {year}::varchar || '-12-31')"""


def _text(name: str) -> str:
    return f"json_extract_string(item, '$.{name}')"


def _bad(name: str, required: bool = False) -> str:
    ok = "('VARCHAR')" if required else "('VARCHAR', 'NULL', 'ABSENT')"
    return f"coalesce(json_type(item, '$.{name}'), 'ABSENT') not in {ok}"


_FORM_BAD = f"""(case when coalesce({_text('filing_type')}, '') <> '' then {_bad('filing_type', True)}
 else {_bad('form')} end)"""

_REASON = f"""case when {_bad('title', True)} then 'title' when {_bad('url', True)} then 'url'
 when {_bad('date')} then 'date' """
ARTICLE_REASON = _REASON + "end"
FILING_REASON = (
    _REASON + f"when {_FORM_BAD} then 'filing_type' "
    + " ".join(
        f"when {_bad(n)} then '{n}'"
        for n in ("filing_date", "report_date", "accession_number", "primary_document", "cik")
    )
    + " end"
)

_PATH = r"""regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '')"""


def _doc_columns(kind: str, optional: dict[str, str]) -> str:
    typed = f"""case when stated in ('pdf','html') then stated
  when is_pdf or lower({_PATH}) like '%.pdf' or lower(raw_path) like '%.pdf' then 'pdf' else 'html' end"""
    fields = ", ".join(f"{v} as {k}" for k, v in optional.items())
    return f"""select pos, title, company_name, company_id, company_ticker, base_url, year, date, url,
 doc_type as type, case when trim(raw_path) <> '' and not contains(raw_path, '://') then trim(raw_path)
  else 'data/' || company_id || '/' || year || '/' || md5(url) || '.' || doc_type end as filepath,
 false as downloaded, null::varchar as gcs_uri, '{kind}' as source_kind, {fields}
from (select *, {typed} as doc_type from (select *, {_text('title')} as title, {_text('url')} as url,
  case when json_type(item, '$.date') is null then year::varchar
   when json_type(item, '$.date') = 'NULL' then null else {_text('date')} end as date,
  lower(coalesce(nullif({_text('type')}, ''), nullif({_text('article_type')}, ''), '')) as stated,
  coalesce(json_type(item, '$.is_pdf') = 'BOOLEAN' and {_text('is_pdf')} = 'true', false) as is_pdf,
  coalesce({_text('filepath')}, '') as raw_path"""


_FILING = ("filing_type", "filing_date", "report_date", "accession_number", "primary_document", "cik")
_NO_FILING = {n: "null::varchar" for n in _FILING}
_FILING_SQL = {n: f"nullif(trim({_text(n)}), '')" for n in _FILING}
_FILING_SQL["filing_type"] = (
    f"upper(nullif(trim(coalesce(nullif({_text('filing_type')}, ''), {_text('form')})), ''))"
)
_CIK = _FILING_SQL["cik"]
_FILING_SQL["cik"] = (
    f"case when regexp_full_match({_CIK}, '[0-9]+') and length({_CIK}) < 10 "
    f"then lpad({_CIK}, 10, '0') else {_CIK} end"
)

_WORD = "[a-z]{5,}"


def features_ctes(prefix: str, source: str, key: str, text: str) -> dict[str, str]:
    """CTEs ending in ``{prefix}_features(key, summary, key_entities, topics)`` as lists."""
    p = prefix
    return {
        f"{p}_src": f"select {key} as k, {text} as text from {source} where {text} is not null",
        f"{p}_word": f"select k, unnest(regexp_extract_all(lower(text), '{_WORD}')) as w from {p}_src",
        f"{p}_top": f"""select k, w, n, row_number() over (partition by k order by n desc, w) as rn
 from (select k, w, count(*) as n from {p}_word group by k, w)""",
        f"{p}_topics": f"select k, list(w order by rn) as topics from {p}_top where rn <= 5 group by k",
        f"{p}_line": f"""select k, unnest(string_split(text, chr(10))) as line,
 generate_subscripts(string_split(text, chr(10)), 1) as i from {p}_src""",
        f"{p}_scored": f"""select l.k, l.i, trim(l.line, {_WS}) as line,
 len(list_filter(coalesce(t.topics, []), lambda w: contains(lower(trim(l.line, {_WS})), w))) as score
 from {p}_line l left join {p}_topics t on l.k = t.k""",
        f"{p}_best": f"""select k, i, line, row_number() over (partition by k order by score desc, i) as rn
 from {p}_scored where line <> ''""",
        f"{p}_summary": f"""select k, string_agg(line, ' ' order by i) as summary from {p}_best
 where rn <= 2 group by k""",
        f"{p}_features": f"""select s.k, coalesce(m.summary, '') as summary,
 list_sort(list_distinct(regexp_extract_all(s.text, '[A-Z][a-z]{{3,}}'))) as key_entities,
 coalesce(t.topics, []) as topics
 from {p}_src s left join {p}_topics t on s.k = t.k left join {p}_summary m on s.k = m.k""",
    }


def packing_ctes(prefix: str, pages: str, doc: str, target: int) -> dict[str, str]:
    """CTEs ending in ``{prefix}_packed(doc, page_no, n_bytes, page_text, chunk_no)``."""
    p = prefix
    return {
        f"{p}_bad": f"select distinct {doc} as doc from {pages} where n_bytes > {target}",
        f"{p}_ok": f"""select {doc} as doc, page_no, n_bytes, page_text from {pages}
 where {doc} not in (select doc from {p}_bad)""",
        f"{p}_fold": f"""select doc, page_no, n_bytes, page_text, 1::bigint as chunk_no, n_bytes as size
 from {p}_ok where page_no = 1 union all
 select o.doc, o.page_no, o.n_bytes, o.page_text,
  case when f.size + o.n_bytes <= {target} then f.chunk_no else f.chunk_no + 1 end,
  case when f.size + o.n_bytes <= {target} then f.size + o.n_bytes else o.n_bytes end
 from {p}_fold f join {p}_ok o on o.doc = f.doc and o.page_no = f.page_no + 1""",
        f"{p}_packed": f"select doc, page_no, n_bytes, page_text, chunk_no from {p}_fold",
        f"{p}_chunk": f"""select doc || '#' || chunk_no as ck, doc, chunk_no,
 string_agg(page_text, chr(10) order by page_no) as chunk_text from {p}_packed group by doc, chunk_no""",
        **features_ctes(f"{p}c", f"{p}_chunk", "ck", "chunk_text"),
        f"{p}_part": f"""select c.doc, c.chunk_no, f.summary, f.key_entities, f.topics
 from {p}_chunk c join {p}c_features f on f.k = c.ck""",
        f"{p}_ents": f"""select doc, list(e order by o1, o2) as key_entities from (
 select doc, e, min(chunk_no) as o1, arg_min(i, chunk_no) as o2 from (
  select doc, chunk_no, unnest(key_entities) as e, generate_subscripts(key_entities, 1) as i from {p}_part)
 group by doc, e) group by doc""",
        f"{p}_tops": f"""select doc, list(e order by o1, o2) as topics from (
 select doc, e, min(chunk_no) as o1, arg_min(i, chunk_no) as o2 from (
  select doc, chunk_no, unnest(topics) as e, generate_subscripts(topics, 1) as i from {p}_part)
 group by doc, e) group by doc""",
        f"{p}_merged": f"""select p.doc, p.summary, coalesce(e.key_entities, []) as key_entities,
 coalesce(t.topics, []) as topics, p.n as chunk_count
 from (select doc, string_agg(summary, ' ' order by chunk_no) as summary, count(*) as n
  from {p}_part group by doc) p
 left join {p}_ents e on e.doc = p.doc left join {p}_tops t on t.doc = p.doc""",
    }


_TRANSIENT = (
    "(regexp_matches(upper({m}), 'RESOURCE_EXHAUSTED|UNAVAILABLE|DEADLINE_EXCEEDED|INTERNAL|BAD GATEWAY|"
    "SERVICE UNAVAILABLE|GATEWAY TIMEOUT|TIMEOUT|TIMED OUT|(^|[^0-9])(429|500|502|503|504)([^0-9]|$)'))"
)


def error_flags(m: str) -> dict[str, str]:
    invalid = f"regexp_matches(upper({m}), 'INVALID_ARGUMENT|(^|[^0-9])400([^0-9]|$)')"
    size = (
        f"({invalid} and contains(upper({m}), 'APPLICATION/PDF') "
        f"and contains(upper({m}), 'EXCEEDS MAX ALLOWED FILE SIZE'))"
    )
    transient = f"(not {size} and {_TRANSIENT.format(m=m)})"
    return {"invalid": invalid, "size": size, "transient": transient}


def outcome_sql(m: str, mime: str, direct: str) -> str:
    f = error_flags(m)
    return (
        f"case when {direct} and {mime} = 'application/pdf' and {f['size']} then 'split' "
        f"when {f['transient']} then 'retry' when {direct} and {f['invalid']} then 'empty' else 'fail' end"
    )


_FILE = "split_part(regexp_replace(filepath, '/+$', ''), '/', -1)"
_MIME = "case when type = 'pdf' then 'application/pdf' else 'text/html' end"
_SUFFIX = "nullif(lower(regexp_extract(split_part({u}, '/', -1), '^.+\\.([^.]+)$', 1)), '')"


def suffix(uri: str) -> str:
    return _SUFFIX.format(u=uri)


def to_json_features(f: str = "") -> str:
    return (
        f"""'{{"summary":' || to_json({f}summary) || ',"key_entities":' || to_json({f}key_entities)"""
        f""" || ',"topics":' || to_json({f}topics) || '}}'"""
    )


PLACEHOLDER = "Document parsing failed or document is empty."
_ROW_DATE = f"coalesce(date::varchar, coalesce(year, {RUN_YEAR})::varchar || '-12-31')"
_URI_OK = "regexp_matches({u}, '(?s)^gs://[^/]+/.+')"

CTES: dict[str, str] = {
    **{name: sql(name, "check") for name in SQL},
    "fx_text_pages": """select doc_id, generate_subscripts(string_split(text, chr(10)), 1)::bigint as page_no,
 unnest(string_split(text, chr(10))) as page_text,
 octet_length(encode(unnest(string_split(text, chr(10)))))::bigint as n_bytes from documents""",
    "fx_html_pages": """select *, octet_length(encode(page_text))::bigint as n_bytes from (
 select case when page_id % 7 = 0 then url || '/doc.PDF?x=1' else url end as url,
  generate_subscripts(string_split(html, '</p>'), 1)::bigint as page_no,
  unnest(string_split(html, '</p>')) as page_text from pages)""",
    "o_companies": """select row_key, t as company_ticker, trim(company_name) as company_name,
 coalesce(nullif(trim(company_id), ''), 'com_' || lower(t)) as company_id, trim(base_url) as base_url
 from (select *, upper(trim(company_ticker)) as t from fx_companies)""",
    "o_article_items": """select i.pos, i.year, c.company_ticker, c.company_name, c.company_id, c.base_url,
 i.item::json as item from fx_article_items i join o_companies c on c.company_ticker = i.company_ticker""",
    "o_filing_items": """select i.pos, i.year, c.company_ticker, c.company_name, c.company_id, c.base_url,
 i.item::json as item from fx_filing_items i join o_companies c on c.company_ticker = i.company_ticker""",
    "o_articles": _doc_columns("articles", _NO_FILING)
    + f" from o_article_items where ({ARTICLE_REASON}) is null))",
    "o_filings": _doc_columns("edgar", _FILING_SQL)
    + f" from o_filing_items where ({FILING_REASON}) is null))",
    "o_union": "select * from o_articles union all select * from o_filings",
    "o_dated": f"""select *, {_iso('date', 'year')} as partition_date,
 company_id || '_' || year || '_' || substr(md5(case when source_kind = 'edgar' and accession_number is not null
  then accession_number || ':' || coalesce(primary_document, '') else title end), 1, 16) as document_id,
 'knowledge-ingestion-' || company_ticker || '-' || year || '-' || source_kind || '-'
  || split_part(filepath, '/', -1) as ingestion_key from o_union""",
    "o_docs": f"""select *, case when source_kind = 'edgar'
  then 'source/edgar/' || company_ticker || '/' || partition_date || '/'
  else 'source/knowledge/' || company_ticker || '/' || year || '/' end as prefix,
 case when source_kind = 'edgar' then document_id || '.' || type else {_FILE} end as filename,
 case when source_kind = 'edgar' then 'stage/edgar/v1/date=' || partition_date || '/' || document_id || '.parquet'
  else 'stage/knowledge/' || document_id || '.parquet' end as stage_key,
 {_MIME} as mime_type from o_dated""",
    "o_objects": """select distinct prefix, filename,
 prefix || case when type = 'pdf' then 'nested/' else '' end || filename as key from o_docs
 where coalesce(filing_type in ('8-K','DEF 14A'), false) or (source_kind = 'articles' and url like 'https%')
  or year = 2022""",
    "o_known": """select distinct source_kind, document_id from o_docs
 where (source_kind = 'edgar' and primary_document is null) or coalesce(date = '2024-03-05', false)""",
    "o_stored": """select *, exists (select 1 from o_objects o
  where starts_with(o.key, d.prefix) and split_part(o.key, '/', -1) = d.filename) as stored from o_docs d""",
    "o_flagged": """select d.*, o.key is not null as stored from o_docs d
 left join (select prefix, filename, min(key) as key from o_objects group by all) o
 on o.prefix = d.prefix and o.filename = d.filename""",
    "o_fresh": "select * exclude (stored) from o_flagged where not stored",
    "o_first": """select *, count(*) over (partition by ingestion_key) as n_same_key,
 row_number() over (partition by ingestion_key order by pos) as rn from o_fresh""",
    "o_gated": """select f.*, k.document_id is not null as skipped from o_first f left join o_known k
 on k.source_kind = f.source_kind and k.document_id = f.document_id where f.rn = 1""",
    "o_gated_s": """select * exclude (turn), false as skipped from (
 select *, row_number() over (partition by ingestion_key order by pos % 2, pos) as turn from o_fresh) where turn = 1""",
    "o_pages": f"""select p.* from fx_html_pages p join fx_contents c on c.url = p.url
 where c.n_bytes > {SETTINGS.direct_max_bytes} or coalesce({error_flags('c.error')['size']}, false)""",
    **features_ctes("w", "fx_contents", "url", "text"),
    **packing_ctes("h", "o_pages", "url", SETTINGS.chunk_target_bytes),
    **features_ctes("t", "documents", "doc_id", "text"),
    **packing_ctes("tp", "fx_text_pages", "doc_id", PAGE_TARGET),
    **{
        f"o_called_{n}": f"""select g.*, c.source_gcs_uri as fetched_uri, c.n_bytes, c.error, case when c.url is null
  then 'not_fetched' when g.type = 'pdf' and c.n_bytes > {SETTINGS.direct_max_bytes} then 'split'
  when c.error is not null then {outcome_sql('c.error', 'g.mime_type', 'true')} else 'ok' end as extraction
 from {src} g left join fx_contents c on c.url = g.url where not g.skipped"""
        for n, src in (("c", "o_gated"), ("b", "o_backfill_gated"), ("s", "o_gated_s"))
    },
    **{
        f"o_made_{n}": f"""select d.*, case d.extraction when 'ok' then w.summary when 'empty' then '{PLACEHOLDER}'
  when 'split' then h.summary end as summary,
 case d.extraction when 'ok' then w.key_entities when 'empty' then [] when 'split' then h.key_entities end as key_entities,
 case d.extraction when 'ok' then w.topics when 'empty' then [] when 'split' then h.topics end as topics,
 case when d.extraction = 'split' then h.chunk_count end as chunk_count,
 case when d.source_kind = 'edgar' then 'gs://b/' || d.prefix || d.document_id || '.'
  || coalesce({suffix('d.fetched_uri')}, case when d.type = 'pdf' then 'pdf' else 'html' end)
  else d.fetched_uri end as source_gcs_uri
 from o_called_{n} d left join w_features w on w.k = d.url left join h_merged h on h.doc = d.url"""
        for n in ("c", "b", "s")
    },
    **{
        f"o_records_{n}": f"""select document_id, company_id, company_ticker, year, title, url as source_url,
 source_gcs_uri, type as document_type, {to_json_features()} as standard_features, partition_date as date,
 source_gcs_uri as gemini_file_uri,
 coalesce(array_to_string(list_transform(generate_series(1, chunk_count),
  lambda i: 'gs://b/stage/knowledge/gemini_chunks/' || document_id || '/part-' || lpad(i::varchar, 5, '0') || '.pdf'), '|'), '')
  as gemini_chunk_uris, coalesce(chunk_count, 0) as gemini_chunk_count, source_kind, filing_type, filing_date,
 report_date, accession_number, primary_document, cik from o_made_{n} where summary is not null"""
        for n in ("c", "b")
    },
    "o_outcome": """select company_ticker, year, 'stored' as outcome, 1 as n from o_flagged where stored
 union all select company_ticker, year, case when skipped then 'skipped' end, 1 from o_gated where skipped
 union all select company_ticker, year, case when summary is null then 'failed' else 'processed' end, 1 from o_made_c
 union all select company_ticker, year, 'duplicate', 1 from o_first where rn > 1""",
    "o_counted": """select company_ticker, year, count(*) as discovered,
 count(*) filter (outcome <> 'stored') as new, count(*) filter (outcome = 'processed') as processed,
 count(*) filter (outcome = 'skipped') as skipped from o_outcome group by all""",
    "o_backfill_companies": """select ticker as company_ticker, name as company_name,
 'com_' || lower(ticker) as company_id, 'https://www.google.com/search?q=' || name as base_url
 from (select upper(trim(ticker)) as ticker, arg_min(name, (file_no, line_no)) as name from fx_holdings
  where ticker is not null and ticker not in ('', '-') group by all)""",
    "o_backfill_items": """select i.pos, i.year, c.company_ticker, c.company_name, c.company_id, c.base_url,
 i.item::json as item from fx_filing_items i join o_backfill_companies c on c.company_ticker = i.company_ticker
 where i.year between 2021 and 2026""",
    "o_backfill_docs": _doc_columns("edgar", _FILING_SQL)
    + f" from o_backfill_items where ({FILING_REASON}) is null))",
    "o_backfill_dated": f"""select *, {_iso('date', 'year')} as partition_date,
 company_id || '_' || year || '_' || substr(md5(case when accession_number is not null
  then accession_number || ':' || coalesce(primary_document, '') else title end), 1, 16) as document_id,
 {_MIME} as mime_type from o_backfill_docs""",
    "o_backfill_keyed": """select *, 'source/edgar/' || company_ticker || '/' || partition_date || '/' as prefix,
 document_id || '.' || type as filename from o_backfill_dated""",
    "o_backfill_gated": """select d.*, k.document_id is not null as skipped from o_backfill_keyed d
 left join o_known k on k.source_kind = 'edgar' and k.document_id = d.document_id
 where not exists (select 1 from o_objects o where o.prefix = d.prefix and o.filename = d.filename)""",
    "o_legacy": f"""select *, {_ROW_DATE} as row_date,
 'source/edgar/' || upper(company_ticker) || '/' || {_ROW_DATE} || '/' || document_id || '.'
  || coalesce({suffix('source_gcs_uri')}, case when document_type = 'pdf' then 'pdf' else 'html' end) as target_key
 from fx_legacy_rows""",
    "o_candidates": r"""select *, 'gs://b/' || target_key as target_uri from o_legacy
 where starts_with(source_gcs_uri, 'gs://b/source/knowledge/')
 and (regexp_matches(lower(coalesce(source_url, '')), 'sec\.gov/(archives/edgar|ixviewer)')
  or regexp_matches(lower(coalesce(title, '')), '(10-k|10-q|8-k|def 14a|20-f|40-f|s-1)')
  or regexp_matches(lower(coalesce(source_gcs_uri, '')), '(10-k|10-q|8-k|def 14a|20-f|40-f|s-1)'))""",
    "o_listing": """select source_gcs_uri as uri from o_legacy where document_type = 'html' and source_gcs_uri <> ''
 union select 'gs://b/' || target_key from o_legacy where document_type = 'pdf' and title = 'News'""",
    "o_metadata": """select row_key, upper(trim(company_ticker)) as company_ticker, trim(company_name) as company_name,
 company_id, base_url, lower(trim(provider)) as provider, response::json as response from fx_metadata""",
    "o_metadata_ok": """select * from o_metadata where provider = 'lseg' and json_type(response) = 'OBJECT'
 and json_exists(response, '$.company_id')""",
    "o_metadata_id": """select *, company_id || '_2026_lseg_' || substr(md5(company_id || '|' || company_ticker || '|'
 || base_url || '|2026|lseg'), 1, 16) as metadata_id from o_metadata where provider = 'lseg'""",
}


def needed(text: str) -> list[str]:
    """Names of the CTEs a text uses, dependencies first."""
    order: list[str] = []

    def visit(body: str, own: str = "") -> None:
        for name in re.findall(r"\b[a-z][a-z0-9_]*\b", body):
            if name in CTES and name != own and name not in order:
                visit(CTES[name], name)
                if name not in order:
                    order.append(name)

    visit(text)
    return order


def assemble(select: str) -> str:
    """A query with the CTEs it needs in front."""
    names = needed(select)
    if not names:
        return select
    body = ",\n".join(f"{name} as ({CTES[name]})" for name in names)
    return f"with recursive {body}\n{select}"

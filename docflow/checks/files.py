"""Queries of the readers, writers and whole jobs.

Each writes rows derived from the given tables below a fresh work folder, reads
them back through the operator under test and returns what it read.
"""

from __future__ import annotations

import os
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docflow import functions as fn
from docflow.checks.fixtures import PAGE_TARGET, RUN_YEAR, SETTINGS, Fixtures
from docflow.checks.registry import (
    FILING,
    RECORD,
    _SUMMARY,
    _metadata,
    _run,
    comparable,
    query,
)
from docflow.functions.items import field_text
from docflow.operators import company_metadata as cm
from docflow.operators import migration as mg
from docflow.operators import packing, records as rc
from docflow.operators.backfill import first_company_per_ticker, valid_holdings
from docflow.operators.normalize import union_sources
from docflow.plans import backfill as backfill_plan
from docflow.plans import company_metadata as metadata_plan
from docflow.plans import ingest, migrate
from docflow.session import work_dir
from docflow.sinks import journal, writers
from docflow.sources import readers
from docflow.streaming.ingest_stream import ingest_stream

STAGED = f"""(select * exclude (rn) from (select *, row_number() over (partition by source_kind, document_id
 order by source_url desc, source_gcs_uri desc, date desc) as rn from o_records_c) where rn = 1)"""
_MOVES = """select case when c.source_gcs_uri = c.target_uri
 then 'noop' when exists (select 1 from o_listing l where l.uri = c.source_gcs_uri) then 'move'
 when exists (select 1 from o_listing l where l.uri = c.target_uri) then 'moved' else 'missing' end as move
 from o_candidates c"""
NO_FILING = ", ".join(f"null::varchar as {c}" for c in FILING.split(", "))


def _land(t: Fixtures, view: str, label: str, ticker=None) -> str:
    """Item texts below company_ticker=/year= folders."""
    path = work_dir(t.spark, label)
    rows = t.view(view)
    if ticker is not None:
        rows = rows.withColumn("company_ticker", ticker)
    rows.select(F.col("item").alias("value"), "company_ticker", "year").repartition(
        "company_ticker"
    ).write.partitionBy("company_ticker", "year").text(path)
    return path


def _to_folders(rows: DataFrame, path: str, *columns: str, order: str | None = None) -> None:
    """Text files added below a folder for each value of the columns; a folder's rows lie in one
    file, in the order of a column, if there is one, which is not written.

    A folder costs the same however small its file: rows are dealt over tasks by folder, whatever
    their bytes, and tasks put their files in place themselves, not the driver one by one.
    """
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    dealt = rows.repartition(tasks, *columns)
    if order is not None:
        dealt = dealt.sortWithinPartitions(*columns, order).drop(order)
    writer = dealt.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.partitionBy(*columns).text(path)


def _to_raw_files(rows: DataFrame, path: str) -> None:
    """What :func:`_to_folders` makes of (value, key), for a folder a key: tasks write the files
    themselves, since Spark's writer takes many times as long to open one as to fill it. Stores
    that tasks cannot open as a folder are left to Spark."""
    key = rows.columns[1]
    if not path.startswith(("/", "file:/")):
        _to_folders(rows, path, key)
        return
    top = unquote(urlsplit(path).path) if path.startswith("file:") else path

    def write(batches):
        last = None
        for batch in batches:
            for value, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folder = f"{top}/{key}={'__HIVE_DEFAULT_PARTITION__' if own is None else own}"
                if folder != last:
                    os.makedirs(folder, exist_ok=True)
                # A task that is done again begins its files anew.
                with open(f"{folder}/part-00000.txt", "ab" if folder == last else "wb") as file:
                    file.write(f"{value or ''}\n".encode())
                last = folder
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    os.makedirs(top, exist_ok=True)
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    rows.repartition(tasks, key).sortWithinPartitions(key).mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _item_columns(items: DataFrame, *names: str) -> DataFrame:
    texts = [field_text("item", n).alias(n) for n in names]
    return items.select("company_ticker", "year", *texts)


@query("read_articles", """select company_ticker, year, json_extract_string(item, '$.url') as url,
 json_extract_string(item, '$.title') as title from fx_article_items""")
def _(t):
    landed = readers.read_articles(t.spark, _land(t, "fx_article_items", "articles"))
    return _item_columns(landed, "url", "title")


@query("read_filings", """select 'T' || pos % 25 as company_ticker, year, json_extract_string(item, '$.url') as url,
 json_extract_string(item, '$.accession_number') as accession_number from fx_filing_items""")
def _(t):
    ticker = F.concat(F.lit("T"), (F.col("pos") % 25).cast("string"))
    landed = readers.read_filings(t.spark, _land(t, "fx_filing_items", "filings", ticker))
    return _item_columns(landed, "url", "accession_number")


def _land_metadata(t: Fixtures) -> str:
    path = work_dir(t.spark, "metadata")
    rows = cm.require_provider(t.view("fx_metadata")).valid
    answers = rows.select(
        F.col("response").alias("value"),
        F.upper(fn.strip("company_ticker")).alias("company_ticker"),
        F.lit(RUN_YEAR).alias("year"),
        "provider",
    )
    # Companies are the lowest level, so each makes one folder, not three.
    _to_folders(answers, path, "year", "provider", "company_ticker")
    return path


@query("read_company_metadata", """select company_ticker, 2026 as year, provider,
 json_extract_string(response, '$.base_url') as base_url from o_metadata where provider = 'lseg'""")
def _(t):
    landed = readers.read_company_metadata(t.spark, _land_metadata(t))
    url = F.try_variant_get("response", "$.base_url", "string")
    return landed.select("company_ticker", "year", "provider", url.alias("base_url"))


def _land_holdings(t: Fixtures) -> list[str]:
    root = work_dir(t.spark, "holdings")
    lines = t.view("fx_holdings").withColumn("value", F.to_json(F.struct("ticker", "name")))
    for file_no in (0, 1):
        own = lines.where(F.col("file_no") == file_no).orderBy("line_no")
        own.select("value").write.text(f"{root}/{file_no}.ndjson")
    return [f"{root}/0.ndjson", f"{root}/1.ndjson"]


@query("read_holdings", """select upper(trim(ticker)) as ticker, arg_min(name, (file_no, line_no)) as name from fx_holdings
 where ticker is not null and ticker not in ('', '-') group by all""")
def _(t):
    holdings = readers.read_holdings(t.spark, _land_holdings(t))
    return first_company_per_ticker(valid_holdings(holdings))


@query("latest_snapshot", "select row_key, company_ticker from o_companies")
def _(t):
    root = work_dir(t.spark, "snapshots")
    rows = t.companies.select("row_key", "company_ticker")
    rows.limit(1).write.json(f"{root}/date=2026-05-11/companies.json")
    rows.write.json(f"{root}/date=2026-05-12/companies.json")
    found = readers.latest_snapshot(t.spark, root, multi_line=False)
    return found.select("row_key", "company_ticker")


@query("list_objects", """select 'label=' || label || '/source=' || source || '/one.txt' as key, n + 1 as size
 from (select item_id % 7 as label, item_id as source, octet_length(encode(text)) as n from benchmark)""")
def _(t):
    root = work_dir(t.spark, "listing")
    texts = t.table("benchmark").select(
        F.col("text").alias("value"), (F.col("item_id") % 7).alias("label"), F.col("item_id").alias("source")
    )
    texts.write.partitionBy("label", "source").text(root)
    # Spark names the files; all else of the key is known.
    listed = readers.list_objects(t.spark, root, "*.txt")
    return listed.select(F.regexp_replace("key", "[^/]+$", "one.txt").alias("key"), "size")


@query("read_raw_documents", """select page_id, octet_length(encode(html)) + 1 as n_bytes,
 md5(html || chr(10)) as content_md5 from pages""")
def _(t):
    path = work_dir(t.spark, "raw")
    _to_raw_files(t.table("pages").select(F.col("html").alias("value"), "page_id"), path)
    raw = readers.read_raw_documents(t.spark, path, "*.txt")
    return raw.select(
        F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("long").alias("page_id"),
        "n_bytes",
        F.md5("content").alias("content_md5"),
    )


def _stage(t: Fixtures, root: str) -> dict[str, str]:
    """Both families of records staged; records are written once, as in the job, since each
    family's stage would extract every text again."""
    records = ingest.kept(t.spark, _run(t).records, work_dir(t.spark, "records"))
    return writers.stage_documents(t.spark, records, root)


def _staged(t: Fixtures) -> tuple[str, dict[str, str]]:
    root = work_dir(t.spark, "job")
    return root, _stage(t, root)


@query("read_stage", f"select {RECORD} from {STAGED} where source_kind = 'articles'")
def _(t):
    _, paths = _staged(t)
    return comparable(readers.read_stage(t.spark, paths["articles"]))


@query("stage_documents", f"select {RECORD}, {FILING} from {STAGED} where source_kind = 'edgar'")
def _(t):
    _, paths = _staged(t)
    return comparable(readers.read_stage(t.spark, paths["edgar"]), f"{RECORD}, {FILING}")


@query("read_table", "select o_orderkey, o_custkey from orders where o_orderstatus = 'F' and o_orderkey >= 100")
def _(t):
    t.table("orders").createOrReplaceTempView("orders")
    rows = readers.read_table(
        t.spark, "orders", "o_orderstatus = :status AND o_orderkey >= :low", status="F", low=100
    )
    return rows.select("o_orderkey", "o_custkey")


@query("append_load", f"""select {RECORD}, {NO_FILING} from {STAGED} where source_kind = 'articles'
 union all select {RECORD}, {FILING} from {STAGED} where source_kind = 'edgar'""")
def _(t):
    root, paths = _staged(t)
    # The second load brings new columns.
    for family in ("articles", "edgar"):
        writers.append_load(t.spark, writers.read_staged(t.spark, paths[family], family), f"{root}/table")
    return comparable(writers.read_loaded(t.spark, f"{root}/table"), f"{RECORD}, {FILING}")


@query("append_load_log", f"""select 'edgar' as table_id, document_id, cik, date || 'T00:00:00.000' as date,
 1::bigint as row_count, 'gs://b/stage/edgar/v1/date=' || date || '/' || document_id || '.parquet' as source_uri
 from {STAGED} where source_kind = 'edgar'""")
def _(t):
    root, paths = _staged(t)
    rows = writers.read_staged(t.spark, paths["edgar"], "edgar")
    writers.append_load_log(rows, "edgar", f"{root}/log")
    line = F.from_json(
        "value",
        "row_count long, rows array<struct<cik string, date string, document_id string>>,"
        " source_uri string, table_id string",
    )
    lines = t.spark.read.text(f"{root}/log").select(line.alias("l"))
    return lines.select("l.table_id", "l.row_count", "l.source_uri", F.inline("l.rows")).select(
        "table_id", "document_id", "cik", "date", "row_count", "source_uri"
    )


@query("promote", f"select {RECORD} from {STAGED} where source_kind = 'articles'")
def _(t):
    root, paths = _staged(t)
    prod = writers.promote(t.spark, root, "articles")
    if readers.path_exists(t.spark, paths["articles"]):
        raise RuntimeError("stage was not removed")
    return comparable(readers.read_stage(t.spark, prod))


@query("create_filings_table", """select document_id, row_date as date, null::varchar as filing_type, null::varchar as cik
 from o_candidates""")
def _(t):
    table = work_dir(t.spark, "filings")
    rows = mg.with_target(mg.legacy_filing_candidates(t.legacy, "b"), "b", RUN_YEAR)
    shaped = mg.normalize_legacy_rows(mg.drop_index_column(rows), RUN_YEAR)
    writers.create_filings_table(t.spark, shaped, table)
    writers.create_filings_table(t.spark, shaped.select("document_id"), table)  # no effect
    writers.append_load(t.spark, rc.cast_stage_types(shaped), table)
    return writers.read_loaded(t.spark, table).select(
        "document_id", F.col("date").cast("string").alias("date"), "filing_type", "cik"
    )


_MIGRATED = """select document_id, target_uri as source_gcs_uri, 'edgar' as source_kind, row_date as date
 from o_candidates"""


@query("rewrite_prod", _MIGRATED)
def _(t):
    plan = migrate.plan_migration(
        t.legacy, t.legacy_listing, "b", "b", allow_missing=True, current_year=RUN_YEAR
    )
    prod = writers.rewrite_prod(t.spark, plan.rows, work_dir(t.spark, "prod"))
    return readers.read_stage(t.spark, prod).select(
        "document_id", "source_gcs_uri", "source_kind", F.col("date").cast("string").alias("date")
    )


@query("bulk_load", f"""select document_id, title from {STAGED}""")
def _(t):
    root, paths = _staged(t)
    writers.bulk_load(t.spark, [], f"{root}/table")
    writers.bulk_load(t.spark, list(paths.values()), f"{root}/table")
    return writers.read_loaded(t.spark, f"{root}/table").select("document_id", "title")


# What is migrated, and where: filings ingested before, of the same days, have to stay.
_BEFORE = f"select document_id, date from {STAGED} where source_kind = 'edgar'"


@query("execute_migration", f"""select document_id, 'prod' as place, count(*) as n from (
 select document_id from ({_BEFORE}) union select document_id from o_candidates) group by all
 union all select document_id, 'table', 1 from (
 select document_id from ({_BEFORE}) union select document_id from o_candidates)
 union all select move, 'move', count(*) from ({_MOVES}) group by all
 union all select 'planned', 'journal', count(*) from ({_MOVES}) where move = 'move' having count(*) > 0
 union all select row_date, 'date', count(*) from o_candidates group by all
 union all select 'rows', 'count', (select count(*) from (
  select document_id from ({_BEFORE}) union select document_id from o_candidates))""")
def _(t):
    root = work_dir(t.spark, "migration")
    staged = _stage(t, root)
    ingest.load_and_promote(t.spark, staged, root, f"{root}/ids")
    for _ in range(2):  # doing it again changes nothing
        report = migrate.execute_migration(
            t.spark, t.legacy, t.legacy_listing, root, "b", "b", allow_missing=True, current_year=RUN_YEAR
        )

    def ids(rows: DataFrame, place: str) -> DataFrame:
        return rows.groupBy("document_id").agg(F.count("*").alias("n")).select(
            "document_id", F.lit(place).alias("place"), "n"
        )

    def named(rows: DataFrame, key: str, n: str, place: str) -> DataFrame:
        return rows.select(F.col(key).alias("document_id"), F.lit(place).alias("place"), F.col(n).alias("n"))

    moves = report.moves.groupBy("move").agg(F.count("*").alias("n"))
    planned = journal.read(t.spark, root).groupBy("state").agg(F.count("*").alias("n"))
    counted = report.row_count.withColumn("rows", F.lit("rows"))
    parts = [
        ids(writers.read_prod(t.spark, root, "edgar"), "prod"),
        ids(writers.read_loaded(t.spark, writers.table_path(root, "edgar")), "table"),
        named(moves, "move", "n", "move"),
        named(planned, "state", "n", "journal"),
        named(report.by_date, "partition_date", "row_count", "date"),
        named(counted, "rows", "row_count", "count"),
    ]
    return union_sources(parts)


@query("execute_migration_skip_gcs", "select 0 as in_prod, 0 as in_table, count(*) as prod_uris from o_candidates")
def _(t):
    root = work_dir(t.spark, "migration")
    report = migrate.execute_migration(
        t.spark, t.legacy, t.legacy_listing, root, "b", "b", skip_gcs=True, current_year=RUN_YEAR
    )
    prod = writers.read_prod(t.spark, root, "edgar").count()
    return report.prod_uris.agg(F.count("*").alias("prod_uris")).select(
        F.lit(prod).alias("in_prod"), F.lit(report.row_count.head()["row_count"]).alias("in_table"), "prod_uris"
    )


@query("write_chunks", """select doc as doc_id, chunk_no, 'p/x/' || doc || '/part-' || lpad(chunk_no::varchar, 5, '0')
 || '.pdf' as key, md5(chunk_text) as content_md5 from tp_chunk""")
def _(t):
    packed = packing.pack_pages(t.text_pages, PAGE_TARGET, "doc_id").valid
    texts = packing.chunk_texts(t.text_pages, packed, "doc_id")
    path = writers.write_chunks(texts, work_dir(t.spark, "chunks"), "/p/x/", "doc_id")
    return t.spark.read.parquet(path).select(
        "doc_id", "chunk_no", "key", F.md5("content").alias("content_md5")
    )


@query("cast_stage_types", """select document_id, company_ticker, year::bigint as year, date::varchar as date,
 document_type from fx_legacy_rows""")
def _(t):
    loose = t.legacy.select(
        "document_id", "company_ticker", F.col("year").cast("string").alias("year"),
        F.col("date").cast("string").alias("date"), "document_type",
    )
    typed = rc.cast_stage_types(loose)
    if typed.schema["year"].dataType.typeName() != "long":
        raise TypeError("year was not cast")
    return typed.withColumn("date", F.col("date").cast("string"))


@query("stage_company_metadata", """select m.company_ticker, i.metadata_id, 'lseg' as provider, 2026 as year
 from o_metadata_ok m join o_metadata_id i on i.row_key = m.row_key""")
def _(t):
    path = writers.stage_company_metadata(t.spark, _metadata(t).rows, work_dir(t.spark, "stage"))
    rows = writers.read_company_metadata_rows(t.spark, path)
    return rows.select("company_ticker", "metadata_id", "provider", "year")


@query("run_company_metadata", """select m.company_ticker, i.metadata_id from o_metadata_ok m
 join o_metadata_id i on i.row_key = m.row_key""")
def _(t):
    root = work_dir(t.spark, "metadata-job")
    responses = readers.read_company_metadata(t.spark, _land_metadata(t))
    companies = cm.require_provider(t.view("fx_metadata")).valid
    metadata_plan.run_company_metadata(
        t.spark, companies.select("company_ticker", "company_name", "company_id", "base_url"),
        responses, RUN_YEAR, root,
    )
    loaded = writers.read_loaded(t.spark, writers.table_path(root, "metadata"))
    return loaded.select("company_ticker", "metadata_id")


@query("run_ingest", _SUMMARY)
def _(t):
    return ingest.run_ingest(
        t.spark, t.ingest_inputs(), SETTINGS, work_dir(t.spark, "ingest-job")
    )


@query("run_backfill", """select company_ticker, year, count(*) as total, (count(*) filter (skipped)
 + count(*) filter (not skipped and done)) as successes from (
 select g.company_ticker, g.year, g.skipped, coalesce(m.summary is not null, false) as done
 from o_backfill_gated g left join o_made_b m on m.pos = g.pos) group by all""")
def _(t):
    return backfill_plan.run_backfill(
        t.spark, t.view("fx_holdings"), t.items("fx_filing_items"), t.names, t.known,
        t.contents, t.html_pages, SETTINGS, work_dir(t.spark, "backfill-job"),
    )


@query("ingest_chunks", f"""select r.document_id, uri, true as written from {STAGED} r,
 unnest(string_split(r.gemini_chunk_uris, '|')) u(uri) where r.gemini_chunk_count > 0""")
def _(t):
    root = work_dir(t.spark, "chunks-job")
    ingest.run_ingest(t.spark, t.ingest_inputs(), SETTINGS, root)
    families = [writers.read_loaded(t.spark, writers.table_path(root, f)) for f in ("articles", "edgar")]
    uris = union_sources([f.select("document_id", F.explode("gemini_chunk_uris").alias("uri")) for f in families])
    parts = writers.read_chunks(t.spark, root, SETTINGS.chunk_prefix)
    keys = parts.select(F.concat(F.lit("gs://b/"), "key").alias("uri"), F.lit(True).alias("written"))
    return uris.join(keys, "uri", "left")


@query("ingest_stream", """select source_kind, document_id, 1::bigint as n_rows from o_made_s
 where summary is not null group by all""")
def _(t):
    spark, root = t.spark, work_dir(t.spark, "stream")
    items = union_sources(
        [
            t.view(view).select(
                F.col("item").alias("value"), F.lit(family).alias("source_kind"), "company_ticker", "year", "pos"
            )
            for view, family in (("fx_article_items", "articles"), ("fx_filing_items", "edgar"))
        ]
    )
    inputs = t.ingest_inputs()
    requests = ingest.build_requests(t.view("fx_companies"), 2021, 2026)

    def side_inputs() -> dict[str, DataFrame]:
        return {"names": inputs.names, "contents": inputs.contents, "pages": inputs.pages}

    # A half lands, then all of it: the second pass finds keys and documents of the first.
    folders = ("source_kind", "company_ticker", "year")
    for part in (items.where(F.col("pos") % 2 == 0), items):
        _to_folders(part, f"{root}/landing", *folders, order="pos")
        ingest_stream(
            spark, f"{root}/landing", root, f"{root}/checkpoint", requests, side_inputs, SETTINGS
        ).awaitTermination()
    loaded = [
        writers.read_loaded(spark, writers.table_path(root, family)).select(F.lit(family).alias("source_kind"), "document_id")
        for family in ("articles", "edgar")
    ]
    return union_sources(loaded).groupBy("source_kind", "document_id").agg(F.count("*").alias("n_rows"))

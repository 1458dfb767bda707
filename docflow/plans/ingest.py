"""Company and document ingestion as one set-based job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.config import ARTICLES, DEFAULT_SOURCES, FILINGS, METADATA, Settings
from docflow.functions.errors import error_outcome
from docflow.functions.identity import document_id
from docflow.functions.layout import mime_type, stage_key
from docflow.operators.extract import (
    Extractor,
    apply_outcome,
    chunk_parts,
    chunk_uris,
    extract_features,
    merge_chunk_features,
    route_by_size,
)
from docflow.operators.gates import (
    anti_join_stored,
    mark_known,
    one_per_ingestion_key,
    with_source_key,
)
from docflow.operators.normalize import (
    articles_to_documents,
    attach_company,
    company_years,
    expand_sources,
    filings_to_documents,
    normalize_company,
    one_company_per_ticker,
    requested_sources,
    split_invalid,
    take_fields,
    union_sources,
)
from docflow.operators.records import build_records, plan_relocation
from docflow.operators.split import Split
from docflow.operators.summaries import fail_if_all_sources_failed, run_summary
from docflow.plans.company_metadata import run_company_metadata
from docflow.session import work_dir
from docflow.sinks import id_index, writers


Known = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Inputs:
    """What a run reads.

    * ``requests``: :func:`build_requests`, one row per company, year and family;
    * ``articles``, ``filings``: items (``company_ticker, year, pos, item``);
    * ``names``: (prefix, filename) of the stored raw files;
    * ``known``: (source_kind, document_id) already loaded, or a function that gives those of
      the documents it is given (:func:`indexed`);
    * ``contents``: (url, source_gcs_uri, n_bytes, text, error), one row per URL;
      more URLs than the run needs do no harm, only gated documents are extracted;
    * ``pages``: (url, page_no, page_text, n_bytes) of files too large to be
      extracted whole;
    * ``errors``: (company_ticker, year, source_kind, pos, error) of discovery calls
      that failed, if any did.
    """

    requests: DataFrame
    articles: DataFrame
    filings: DataFrame
    names: DataFrame
    known: DataFrame | Known
    contents: DataFrame
    pages: DataFrame
    errors: DataFrame | None = None


@dataclass(frozen=True)
class RunResult:
    """``rejected``: items that cannot be used, with the field at fault."""

    records: DataFrame
    outcomes: DataFrame
    summary: DataFrame
    rejected: DataFrame


def build_requests(
    companies: DataFrame, first_year: int, last_year: int, source: str | None = None
) -> DataFrame:
    """Normalised companies for every year and requested source family.

    An unknown source is an error. Companies that share a normalised ticker count once.
    """
    requested_sources(source)
    asked = one_company_per_ticker(normalize_company(companies))
    asked = asked.withColumn("source", F.lit(source).cast("string"))
    return company_years(expand_sources(asked).valid, first_year, last_year)


def requested_items(requests: DataFrame, items: DataFrame, family: str) -> Split:
    """The fields of a family's landed items of the requested company-years, usable and rejected ones.

    Tickers are compared in their normalised form, however the folder spells them.
    """
    context = requests.where(F.col("source_kind") == family)
    slim = take_fields(items.select("company_ticker", "year", "pos", "item"), filing=family == FILINGS)
    return split_invalid(attach_company(slim, context, ("company_ticker", "year")))


def discover(requests: DataFrame, articles: DataFrame, filings: DataFrame) -> Split:
    """Normalised documents of both families for the requested company-years.

    ``rejected`` is (source_kind, company_ticker, year, pos, reject_reason).
    """
    found = {
        ARTICLES: requested_items(requests, articles, ARTICLES),
        FILINGS: requested_items(requests, filings, FILINGS),
    }
    docs = union_sources(
        [articles_to_documents(found[ARTICLES].valid), filings_to_documents(found[FILINGS].valid)]
    )
    columns = ("company_ticker", "year", "pos", "reject_reason")
    rejected = [
        split.rejected.select(F.lit(family).alias("source_kind"), *columns)
        for family, split in found.items()
    ]
    return Split(docs, union_sources(rejected))


def first_documents(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Documents past gate 1, one per ingestion key."""
    fresh = anti_join_stored(docs, names).drop("prefix", "filename")
    return one_per_ingestion_key(fresh).withColumn("document_id", document_id())


def gate_documents(docs: DataFrame, names: DataFrame, known: DataFrame) -> DataFrame:
    """Documents past gate 1, one per ingestion key, flagged by gate 2."""
    return mark_known(first_documents(docs, names), known)


def indexed(spark: SparkSession, root: str) -> Known:
    """Known documents by the id index of the tables below ``root``: what is read grows with the
    documents that are asked for, not with the tables."""

    def known(docs: DataFrame) -> DataFrame:
        found = []
        for family in DEFAULT_SOURCES:
            own = docs.where((F.col("source_kind") == FILINGS) == F.lit(family == FILINGS))
            id_index.cover(spark, root, family, writers.table_path(root, family))
            ids = id_index.lookup(spark, root, family, own.select("document_id"))
            found.append(ids.select(F.lit(family).alias("source_kind"), "document_id"))
        return union_sources(found)

    return known


def route_documents(docs: DataFrame, contents: DataFrame, settings: Settings) -> DataFrame:
    """Documents with source URI and ``extraction``: how their features come about.

    ``not_fetched``, ``split`` (a PDF too large, or refused for its size), ``ok`` or an
    error's outcome. Texts are not read here.
    """
    facts = contents.select("url", "source_gcs_uri", "n_bytes", "error")
    given = F.when(F.col("downloaded") & (F.col("gcs_uri") != ""), F.col("gcs_uri"))
    fetched = docs.join(facts, "url", "left").withColumn(
        "source_gcs_uri", F.coalesce(given, F.nullif("source_gcs_uri", F.lit("")))
    )
    routed = route_by_size(fetched, settings.direct_max_bytes)
    failure = error_outcome("error", mime_type(), F.lit("direct"))
    called = (
        F.when(F.col("source_gcs_uri").isNull(), "not_fetched")
        .when(F.col("route") == "chunk", "split")
        .when(F.col("error").isNotNull(), failure)
        .otherwise("ok")
    )
    relocated = plan_relocation(
        routed.withColumn("extraction", called), settings.source_bucket
    )
    return relocated.withColumn("source_gcs_uri", F.col("target_gcs_uri")).drop(
        "target_gcs_uri", "error", "n_bytes", "route"
    )


def document_chunks(routed: DataFrame, pages: DataFrame, settings: Settings) -> DataFrame:
    """(document_id, chunk_no, chunk_text) of the documents on the chunk route.

    Only their pages are read past the scan. Documents that cannot be packed have none.
    """
    split = routed.where(F.col("extraction") == "split").select("document_id", "url").distinct()
    own = pages.join(split, "url").drop("url")
    return chunk_parts(own, settings.chunk_target_bytes).valid


def extract_documents(
    routed: DataFrame,
    contents: DataFrame,
    chunks: DataFrame,
    settings: Settings,
    extractor: Extractor | None = None,
) -> DataFrame:
    """Routed documents with their features and chunk list.

    The extractor sees each text that a direct document needs once, and each chunk once;
    texts nobody asked for are dropped before it.
    """
    direct = routed.where(F.col("extraction") == "ok").select("url").distinct()
    texts = contents.select("url", "text").where(F.col("text").isNotNull())
    whole = extract_features(texts.join(direct, "url", "left_semi"), extractor).drop("text")
    parts = extract_features(chunks, extractor, "chunk_text").drop("chunk_text")
    merged = merge_chunk_features(parts).withColumnRenamed("features", "chunk_features")
    made = routed.join(whole, "url", "left").join(merged, "document_id", "left")
    split = F.col("extraction") == "split"
    features = F.when(split, F.col("chunk_features")).otherwise(
        apply_outcome(F.col("features"), F.col("extraction"))
    )
    return made.withColumns(
        {
            "features": features,
            "gemini_chunk_uris": F.when(split, chunk_uris(settings.chunk_root)),
        }
    ).drop("chunk_features", "chunk_count")


def ingest_documents(
    docs: DataFrame,
    known: DataFrame | None,
    contents: DataFrame,
    pages: DataFrame,
    settings: Settings,
    run_ts: Column | None = None,
    extractor: Extractor | None = None,
    routed: DataFrame | None = None,
    chunks: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records, results) of documents: gate 2, source URI, extraction, stage rows.

    ``results`` has one row per document with success, skipped and stage key. ``known`` is not
    needed for documents that gate 2 has flagged. ``routed``
    and ``chunks`` are :func:`route_documents` and :func:`document_chunks` of the
    documents not skipped, where a job has them written already.
    """
    if "document_id" not in docs.columns:
        docs = docs.withColumn("document_id", document_id())
    if "skipped" not in docs.columns:
        docs = mark_known(docs, known)
    if routed is None:
        routed = route_documents(docs.where(~F.col("skipped")), contents, settings)
    if chunks is None:
        chunks = document_chunks(routed, pages, settings)
    made = extract_documents(routed, contents, chunks, settings, extractor).withColumn(
        "success", F.col("features").isNotNull()
    )
    records = build_records(made.where("success"), run_ts)
    stage_uri = F.concat(F.lit(f"gs://{settings.prod_bucket}/"), stage_key())
    done = made.withColumn("stage_uri", F.when(F.col("success"), stage_uri))
    old = docs.where("skipped").withColumns(
        {"success": F.lit(True), "stage_uri": F.lit(None).cast("string")}
    )
    results = done.drop("features").unionByName(old, allowMissingColumns=True)
    return records, results


def document_outcomes(results: DataFrame) -> DataFrame:
    """(company_ticker, year, source_kind, outcome, promoted) per discovered document.

    Later documents of an ingestion key are counted as ``duplicate``.
    """
    outcome = F.when(F.col("skipped"), "skipped").when(F.col("success"), "processed")
    own = F.struct(
        F.coalesce(outcome, F.lit("failed")).alias("outcome"),
        F.lit(1).cast("long").alias("n"),
    )
    later = F.struct(
        F.lit("duplicate").alias("outcome"), (F.col("n_same_key") - 1).alias("n")
    )
    return (
        results.select("company_ticker", "year", "source_kind", F.inline(F.array(own, later)))
        .where(F.col("n") > 0)
        .withColumn("promoted", F.col("outcome") == "processed")
    )


def stored_outcomes(docs: DataFrame, names: DataFrame) -> DataFrame:
    """Outcome rows of the documents gate 1 found."""
    return (
        with_source_key(docs)
        .join(names, ["prefix", "filename"], "left_semi")
        .select("company_ticker", "year", "source_kind", F.lit("stored").alias("outcome"))
        .withColumns({"n": F.lit(1).cast("long"), "promoted": F.lit(False)})
    )


def ingest_companies(
    inputs: Inputs,
    settings: Settings,
    run_ts: Column | None = None,
    extractor: Extractor | None = None,
) -> RunResult:
    """Discovery to records and per-company summaries, without any sink.

    Discovered, gated and routed documents are written once to the work folder, since
    records, outcomes and summary all start from them.
    """
    spark = inputs.requests.sparkSession
    work = work_dir(spark, "ingest")
    docs, rejected = discover(inputs.requests, inputs.articles, inputs.filings)
    docs = kept(spark, docs, f"{work}/discovered")
    gated = kept(spark, gate_documents(docs, inputs.names, inputs.known), f"{work}/gated")
    routed = route_documents(gated.where(~F.col("skipped")), inputs.contents, settings)
    routed = kept(spark, routed, f"{work}/routed")
    records, results = ingest_documents(
        gated, inputs.known, inputs.contents, inputs.pages, settings, run_ts, extractor, routed
    )
    outcomes = stored_outcomes(docs, inputs.names).unionByName(document_outcomes(results))
    summary = run_summary(request_keys(inputs.requests), outcomes, inputs.errors)
    return RunResult(records, outcomes, summary, rejected)


def request_keys(requests: DataFrame) -> DataFrame:
    return requests.select("company_ticker", "year", "source").distinct()


def kept(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Rows written once and read back."""
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def check_discovery(requests: DataFrame, docs: DataFrame, errors: DataFrame) -> None:
    """Raise if a requested company-year has errors and no document at all."""
    asked = errors.select("company_ticker", "year", "source_kind", "pos", "error")
    asked = asked.join(requests.select("company_ticker", "year").distinct(), ["company_ticker", "year"], "left_semi")
    found = docs.groupBy("company_ticker", "year").agg(F.count("*").cast("int").alias("n_docs"))
    none = F.lit(None)
    fail_if_all_sources_failed(
        asked.withColumn("n_docs", F.lit(0)).unionByName(
            found.select(
                "company_ticker", "year", none.cast("string").alias("source_kind"),
                none.cast(asked.schema["pos"].dataType).alias("pos"), none.cast("string").alias("error"), "n_docs",
            )
        )
    )


def write_gated(
    spark: SparkSession,
    gated: DataFrame,
    contents: DataFrame,
    pages: DataFrame,
    settings: Settings,
    root: str,
    work: str,
    extractor: Extractor | None = None,
) -> DataFrame:
    """Extract, stage, load, log and promote gated documents; (source_kind, document_id) done.

    Chunk parts are written below the chunk prefix before their features are made of
    them; records are written once, so each text and chunk is extracted once.
    """
    routed = kept(spark, route_documents(gated.where(~F.col("skipped")), contents, settings), f"{work}/routed")
    parts = writers.append_chunks(spark, document_chunks(routed, pages, settings), root, settings.chunk_prefix, f"{work}/chunks")
    records, _ = ingest_documents(
        gated, None, contents, pages, settings, extractor=extractor, routed=routed, chunks=parts
    )
    records = kept(spark, records, f"{work}/records")
    staged = writers.stage_documents(spark, records, root)
    return load_and_promote(spark, staged, root, f"{work}/loaded")


def with_success(gated: DataFrame, done: DataFrame) -> DataFrame:
    """Gated documents with ``success``: loaded by this run or skipped."""
    new, on = gated.where(~F.col("skipped")), ["source_kind", "document_id"]
    return (
        new.join(done, on, "left_semi").withColumn("success", F.lit(True))
        .unionByName(new.join(done, on, "left_anti").withColumn("success", F.lit(False)))
        .unionByName(gated.where("skipped").withColumn("success", F.lit(True)))
    )


def run_ingest(
    spark: SparkSession,
    inputs: Inputs,
    settings: Settings,
    root: str,
    extractor: Extractor | None = None,
) -> DataFrame:
    """The whole job with its sinks; returns the run summary.

    The gated documents are written once to the shared work folder, so no later
    step repeats discovery, and a lost executor only repeats its own tasks.
    Order: chunk parts, stage, load, log, promote. A load that fails leaves its rows in
    stage. Rejected items and the summary are kept below ``runs/``; the work folder is
    removed at the end. A company-year whose discovery failed without any document
    stops the job before it writes.
    """
    work = work_dir(spark, "ingest")
    docs, rejected = discover(inputs.requests, inputs.articles, inputs.filings)
    docs = kept(spark, docs, f"{work}/discovered")
    if inputs.errors is not None:
        check_discovery(inputs.requests, docs, inputs.errors)
    firsts = kept(spark, first_documents(docs, inputs.names), f"{work}/firsts")
    stored = stored_outcomes(docs, inputs.names)
    return finish_run(spark, firsts, stored, rejected, inputs, settings, root, work, extractor)


def finish_run(
    spark: SparkSession,
    firsts: DataFrame,
    stored: DataFrame,
    rejected: DataFrame,
    inputs: Inputs,
    settings: Settings,
    root: str,
    work: str,
    extractor: Extractor | None = None,
) -> DataFrame:
    """Gate 2, extraction and sinks of written first documents; the summary, kept below ``runs/``.

    ``stored`` are outcome rows of what gate 1 found. The work folder is removed at the end.
    """
    known = inputs.known(firsts) if callable(inputs.known) else inputs.known
    gated = kept(spark, mark_known(firsts, known), f"{work}/gated")
    done = write_gated(spark, gated, inputs.contents, inputs.pages, settings, root, work, extractor)
    outcomes = stored.unionByName(document_outcomes(with_success(gated, done)))
    summary = run_summary(request_keys(inputs.requests), outcomes, inputs.errors)
    run = f"{root}/runs/{work.rsplit('/', 1)[-1]}"
    kept(spark, rejected, f"{run}/rejected")
    summary = kept(spark, summary, f"{run}/summary")
    writers.delete_path(spark, work)
    return summary


def run_companies(
    spark: SparkSession,
    companies: DataFrame,
    first_year: int,
    last_year: int,
    source: str | None,
    inputs: Callable[[DataFrame], Inputs],
    responses: DataFrame,
    settings: Settings,
    root: str,
    extractor: Extractor | None = None,
) -> DataFrame:
    """Company ingestion by source: ``metadata`` leads to the metadata job, everything
    else to documents. ``inputs`` gives the inputs for the requests built here. Returns
    the summary of the job that ran."""
    if requested_sources(source) == (METADATA,):
        years = [
            run_company_metadata(spark, companies, responses, year, root, prod_bucket=settings.prod_bucket)
            for year in range(first_year, last_year + 1)
        ]
        return union_sources(years)
    requests = build_requests(companies, first_year, last_year, source)
    return run_ingest(spark, inputs(requests), settings, root, extractor)


def load_and_promote(
    spark: SparkSession, staged: dict[str, str], root: str, ids_path: str
) -> DataFrame:
    """Load each family's staged rows into its table, log them, move them to prod.

    Rows an interrupted run has loaded already are not loaded twice: the id index is brought
    up to the table's version first. Returns the (source_kind, document_id) that made it,
    kept in ``ids_path``.
    """
    for family in DEFAULT_SOURCES:
        rows = writers.read_staged(spark, staged[family], family)
        table = writers.table_path(root, family)
        id_index.cover(spark, root, family, table)
        known = id_index.lookup(spark, root, family, rows.select("document_id"))
        writers.append_load(spark, rows.join(known, "document_id", "left_anti").select(*rows.columns), table)
        id_index.cover(spark, root, family, table)
        writers.append_load_log(rows, family, f"{root}/load_log")
        rows.select(F.lit(family).alias("source_kind"), "document_id").write.mode(
            "append"
        ).parquet(ids_path)
        writers.promote(spark, root, family)
    return spark.read.parquet(ids_path)

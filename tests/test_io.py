import datetime as dt
import json
import random
from dataclasses import replace

import pandas as pd
import pytest
from pyarrow.fs import LocalFileSystem
from pyspark.sql import functions as F

from docflow.config import Settings
from docflow.plans import ingest
from docflow.schemas import ARTICLE_RECORD, METADATA_ROW
from docflow.sinks import versions, writers
from docflow.sources import listing, readers
from docflow.streaming import ingest_stream as stream
from docflow.streaming.ingest_stream import ingest_stream

TS = dt.datetime(2026, 1, 1)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def records(spark, *rows):
    """Article records from (document_id, date, title, run time)."""
    full = [
        (i, "com_aa", "AA", 2026, title, "u", "gs://b/k", "html", "{}", ts, dt.date.fromisoformat(d), "gs://b/k", [], 0)
        for i, d, title, ts in rows
    ]
    return spark.createDataFrame(full, ARTICLE_RECORD).select(
        "*", F.lit("articles").alias("source_kind"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("filing_type", "filing_date", "report_date", "accession_number", "primary_document", "cik")],
    )


def titles(df):
    return {r["document_id"]: r["title"] for r in df.collect()}


def test_landed_responses_keep_order_context_and_bad_texts(spark, tmp_path):
    root = tmp_path / "land"
    put(root / "company_ticker=01" / "year=2024" / "a.json", json.dumps([{"title": "a"}, {"title": "b"}], indent=2))
    put(root / "company_ticker=B%3A" / "year=2023" / "a.json", '{"title":"c"}')
    put(root / "company_ticker=Z" / "year=2023" / "a.json", "not json")
    put(root / "company_ticker=Y" / "year=2023" / "a.json", "[]")
    got = readers.read_articles(spark, str(root)).orderBy("company_ticker", "pos").select(
        "company_ticker", "year", F.try_variant_get("item.title", "$", "string")
    )
    assert [tuple(r) for r in got.collect()] == [("01", 2024, "a"), ("01", 2024, "b"), ("B:", 2023, "c"), ("Z", 2023, None)]
    assert readers.read_filings(spark, str(tmp_path / "nothing")).count() == 0


def test_lines_keep_their_order_over_many_splits(spark, tmp_path):
    put(tmp_path / "h" / "one.ndjson", "\n".join(json.dumps({"ticker": "X", "name": str(i)}) for i in range(3000)) + "\n\n")
    put(tmp_path / "h" / "two.ndjson", '{"ticker":"X"}\n\n{"ticker":"Y","name":"y"}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    try:
        paths = [str(tmp_path / "h" / n) for n in ("two.ndjson", "one.ndjson")]
        rows = readers.read_holdings(spark, paths).orderBy("file_no", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["name"] for r in rows] == [None, "y"] + [str(i) for i in range(3000)]


def test_holdings_files_are_told_apart_by_their_whole_path(spark, tmp_path):
    names = ["h/a", "h/a2", "h/x", "z/h/x", "h a%/y"]
    paths = []
    for k, name in enumerate(names):
        put(tmp_path / name, json.dumps({"ticker": f"T{k}", "name": name}) + "\n")
        paths.append(str(tmp_path / name))
    put(tmp_path / "folder" / "part-0", '{"ticker":"F","name":"in a folder"}')
    for order in (paths, paths[::-1]):
        listed = [*order, str(tmp_path / "folder")]
        got = {r["name"]: r["file_no"] for r in readers.read_holdings(spark, listed).collect()}
        assert got == {n: [*(p[len(str(tmp_path)) + 1 :] for p in order), "in a folder"].index(n) for n in [*names, "in a folder"]}


def test_listing_opens_folders_in_tasks(spark, tmp_path):
    root = tmp_path / "my store"
    keys = ["top.txt", "a/x.txt", "a/b/c/d/deep.txt", "a/b/y=1/z%20.txt", "a-b/x.txt", "date=1/n.json", "e/.hidden/x.txt", "e/_skip/x.txt", "e/_SUCCESS"]
    for n, key in enumerate(keys):
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_bytes(b"." * n)
    (root / "empty").mkdir()
    seen = {k: n for n, k in enumerate(keys) if not k.startswith("e/")}

    def got(**options):
        return {r["key"]: r["size"] for r in listing.list_in_tasks(spark, LocalFileSystem, str(root), tasks=3, **options).collect()}

    for levels in (0, 1, 2, 6):
        assert got(levels=levels) == seen
    assert got(pattern="*.txt", prefix="a/") == {k: n for k, n in seen.items() if k.startswith("a/")}
    assert got(prefix="a/b/c/d/deep") == {"a/b/c/d/deep.txt": 2} and got(prefix="zz") == {}
    for address in (str(root), f"file://{root}/"):
        listed = readers.list_objects(spark, address)
        assert {r["key"]: r["size"] for r in listed.collect()} == seen
        assert "FileScan" not in listed._jdf.queryExecution().executedPlan().toString()
    other = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(root))
    assert {r["path"].split("/my store/")[1] for r in other.select("path").collect()} == {k for k, n in seen.items() if n}


def test_latest_snapshot(spark, tmp_path):
    for day in ("2026-05-11", "2026-05-12"):
        put(tmp_path / "m" / f"date={day}" / "companies.json", json.dumps([{"day": day}, {"day": "x"}]))
    put(tmp_path / "m" / "date=2026-05-13" / "other.json", "[]")
    got = readers.latest_snapshot(spark, str(tmp_path / "m"))
    assert sorted(r["day"] for r in got.collect()) == ["2026-05-12", "x"]
    for missing in ("nothing", "m/date=2026-05-13"):
        with pytest.raises(FileNotFoundError):
            readers.latest_snapshot(spark, str(tmp_path / missing))


def test_raw_files_and_listing(spark, tmp_path):
    put(tmp_path / "r" / "source" / "x.html", "hé")
    listed = readers.list_objects(spark, str(tmp_path / "r"))
    assert [tuple(r) for r in listed.collect()] == [("source/x.html", 3)]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    row = readers.raw_texts(readers.read_raw_documents(spark, str(tmp_path / "r"))).head()
    assert (row["n_bytes"], row["text"]) == (3, "hé")


def test_stage_replaces_and_promote_moves(spark, tmp_path):
    root = str(tmp_path)
    late = TS + dt.timedelta(days=1)
    writers.stage_documents(spark, records(spark, ("a", "2026-01-01", "old", TS), ("a", "2026-01-01", "new", late), ("b", "2026-01-02", "b", TS)), root)
    paths = writers.stage_documents(spark, records(spark, ("b", "2026-01-02", "b2", late)), root)
    assert titles(readers.read_stage(spark, paths["articles"])) == {"a": "new", "b": "b2"}
    prod = writers.promote(spark, root, "articles")
    assert not readers.path_exists(spark, paths["articles"])
    writers.stage_documents(spark, records(spark, ("c", "2026-01-02", "c", late), ("a", "2026-01-03", "a3", late)), root)
    writers.promote(spark, root, "articles")
    # The article with a new date leaves its old one.
    assert sorted((r["document_id"], r["title"], str(r["date"])) for r in readers.read_stage(spark, prod).collect()) == [
        ("a", "a3", "2026-01-03"), ("b", "b2", "2026-01-02"), ("c", "c", "2026-01-02")
    ]
    twice = records(spark, ("d", "2026-01-05", "one", TS), ("d", "2026-01-06", "two", TS), ("e", "2026-01-02", "e", TS))
    before = set(versions.current(spark, prod).files)
    writers.stage_documents(spark, twice, root)
    writers.promote(spark, root, "articles")
    assert titles(readers.read_stage(spark, prod)) == {"a": "a3", "b": "b2", "c": "c", "d": "two", "e": "e"}
    # New documents are added without writing others again.
    assert before < set(versions.current(spark, prod).files)
    assert prod.endswith("prod/knowledge/documents")
    with pytest.raises(ValueError):
        writers.promote(spark, root, "other")


def test_promotion_that_ends_half_way_is_done_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    paths = writers.stage_documents(spark, records(spark, ("a", "2026-01-01", "a", TS)), root)
    monkeypatch.setattr(versions, "clear", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        writers.promote(spark, root, "articles")
    monkeypatch.undo()
    assert titles(readers.read_stage(spark, paths["articles"])) == {"a": "a"}
    prod = writers.promote(spark, root, "articles")
    assert titles(readers.read_stage(spark, prod)) == {"a": "a"} and not readers.path_exists(spark, paths["articles"])


def test_append_adds_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.lit("2026-01-01").cast("date")
    writers.append_load(spark, spark.range(2).withColumn("date", day), path)
    writers.append_load(spark, spark.range(1).withColumn("date", day).withColumn("cik", F.lit("1")), path)
    assert sorted(str(r["cik"]) for r in writers.read_loaded(spark, path).collect()) == ["1", "None", "None"]


def test_bulk_load_is_one_scan_of_all_paths(spark, tmp_path):
    table = str(tmp_path / "t")
    assert not writers.bulk_load(spark, [], table)
    paths = [str(tmp_path / f"s{k}") for k in range(6)]
    for k, path in enumerate(paths[:4]):
        rows = spark.createDataFrame([(f"d{k}", k)], "document_id string, n long")
        writers.append_load(spark, rows if k % 2 else rows.withColumnRenamed("n", "m"), path)
    spark.createDataFrame([("p4", "x")], "document_id string, cik string").write.parquet(paths[4])
    spark.createDataFrame([("p5",)], "document_id string").write.parquet(paths[5])
    assert writers.bulk_load(spark, paths[:5], table) and writers.bulk_load(spark, paths, table)
    got = {r["document_id"]: (r["m"], r["n"], r["cik"]) for r in writers.read_loaded(spark, table).collect()}
    assert got == {"d0": (0, None, None), "d1": (None, 1, None), "d2": (2, None, None), "d3": (None, 3, None), "p4": (None, None, "x"), "p5": (None, None, None)}
    assert writers.read_loaded(spark, table).count() == 6
    other = str(tmp_path / "o")
    writers.bulk_load(spark, paths, other, among=spark.createDataFrame([("d2",), ("p4",)], "document_id string"))
    assert sorted(r["document_id"] for r in writers.read_loaded(spark, other).collect()) == ["d2", "p4"]


def test_a_load_is_one_log_line(spark, tmp_path):
    rows = spark.range(3).select(
        F.concat(F.lit("d"), "id").alias("document_id"), F.lit(TS).alias("at"), F.lit(dt.date(2024, 12, 31)).alias("date"), F.lit(None).cast("string").alias("n")
    )
    for family, folder in (("articles", "stage/knowledge"), ("edgar", "stage/edgar/v1/date=2024-12-31")):
        writers.append_load_log(rows, family, str(tmp_path / family), "bucket")
        lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / family)).collect()]
        assert sorted(line["source_uri"] for line in lines) == [f"gs://bucket/{folder}/d{k}.parquet" for k in range(3)]
        assert {line["table_id"] for line in lines} == {writers.TABLES[family]} and {line["row_count"] for line in lines} == {1}
        assert list(lines[0]) == sorted(lines[0]) and list(lines[0]["rows"][0]) == ["at", "date", "document_id", "n"]
        assert lines[0]["rows"][0]["at"] == "2026-01-01T00:00:00.000Z" and lines[0]["rows"][0]["n"] is None


def test_filings_table_is_created_once(spark, tmp_path):
    table = str(tmp_path / "w")
    source = records(spark, ("a", "2026-01-01", "t", TS)).drop("cik").withColumn("__index_level_0__", F.lit(1))
    writers.create_filings_table(spark, source, table)
    before = writers.read_loaded(spark, table)
    assert "cik" in before.columns and "__index_level_0__" not in before.columns and before.count() == 0
    writers.create_filings_table(spark, spark.range(1), table)
    assert writers.read_loaded(spark, table).columns == before.columns
    writers.append_load(spark, source.drop("__index_level_0__").withColumn("extra", F.lit("e")), table)
    assert writers.read_loaded(spark, table).head()["extra"] == "e"


def test_metadata_rows_keep_types_and_ids(spark, tmp_path):
    row = ("id1", "007", "n", "c", "u", 2026, "lseg", "m", "s", None, "{}", "{}", "t")
    rows = spark.createDataFrame([row, ("id2", *row[1:])], METADATA_ROW)
    path = writers.stage_company_metadata(spark, rows, str(tmp_path))
    writers.stage_company_metadata(spark, rows.where("metadata_id = 'id1'"), str(tmp_path))
    back = writers.read_company_metadata_rows(spark, path)
    assert back.schema == METADATA_ROW
    assert sorted((r["metadata_id"], r["company_ticker"]) for r in back.collect()) == [("id1", "007"), ("id2", "007")]
    prod = writers.promote_metadata(spark, str(tmp_path))
    assert prod.endswith("prod/knowledge/company_metadata")
    assert writers.read_company_metadata_rows(spark, prod).count() == 2
    assert not readers.path_exists(spark, path)


SETTINGS = Settings(source_bucket="b", prod_bucket="b", direct_max_bytes=50, chunk_target_bytes=30)


def job_inputs(spark, root):
    companies = spark.createDataFrame([("aa", "Bramley", None, "b"), ("bb", "B", None, "b")], "company_ticker string, company_name string, company_id string, base_url string")
    art = [{"title": f"t{i}", "url": f"u{i}", "filepath": f"d/f{i}.html"} for i in range(4)]
    art += [{"title": "dup", "url": "u9", "filepath": "e/f0.html"}, {"title": 3, "url": "x"}, {"title": "big", "url": "big.pdf", "filepath": "d/big.pdf"}]
    put(root / "articles" / "company_ticker=aa " / "year=2024" / "r.json", json.dumps(art))
    put(root / "filings" / "company_ticker=BB" / "year=2024" / "r.json", json.dumps([{"title": "10-K", "url": "s.htm", "date": "2024-03-01", "accession_number": "0-1", "form": "10-k"}]))
    contents = [(f"u{i}", f"gs://raw/{i}", 9, f"Text{i} words words", None) for i in range(3)]
    contents += [("s.htm", "gs://raw/s.HTM", 9, "Annual report", None), ("u3", "gs://raw/3", 9, None, "http 503"), ("big.pdf", "gs://raw/big", 99, None, None)]
    pages = [("big.pdf", i, "Page words again", 16) for i in range(1, 4)]
    return ingest.Inputs(
        requests=ingest.build_requests(companies, 2024, 2024),
        articles=readers.read_articles(spark, str(root / "articles")),
        filings=readers.read_filings(spark, str(root / "filings")),
        names=spark.createDataFrame([("source/knowledge/AA/2024/", "f1.html")], "prefix string, filename string"),
        known=spark.createDataFrame([], "source_kind string, document_id string"),
        contents=spark.createDataFrame(contents, "url string, source_gcs_uri string, n_bytes long, text string, error string"),
        pages=spark.createDataFrame(pages, "url string, page_no long, page_text string, n_bytes long"),
    )


def test_whole_ingest_job(spark, tmp_path):
    inputs = job_inputs(spark, tmp_path / "land")
    root = str(tmp_path / "job")
    summary = {r["company"]: r.asDict() for r in ingest.run_ingest(spark, inputs, SETTINGS, root).collect()}
    a, b = summary["AA"], summary["BB"]
    # f1 is stored, f0 comes twice, u3 fails; u0, u2 and the oversized PDF go through.
    assert (a["discovered"], a["processed"], a["skipped"], a["promoted"]) == (6, 3, 0, 3)
    assert (b["discovered"], b["processed"]) == (1, 1)
    made = ingest.ingest_companies(inputs, SETTINGS)
    assert {r["company"]: r.asDict() for r in made.summary.collect()} == summary
    assert [(r["source_kind"], r["reject_reason"]) for r in made.rejected.collect()] == [("articles", "title")]
    loaded = writers.read_loaded(spark, writers.table_path(root, "articles"))
    big = loaded.where("title = 'big'").head()
    # Three 16-byte pages against a 30-byte target.
    assert big["gemini_chunk_count"] == 3 and big["gemini_chunk_uris"][0].startswith("gs://b/stage/knowledge/gemini_chunks/")
    parts = {r["key"]: r["content"] for r in writers.read_chunks(spark, root, SETTINGS.chunk_prefix).collect()}
    assert set(big["gemini_chunk_uris"]) == {f"gs://b/{key}" for key in parts} and set(parts.values()) == {"Page words again"}
    assert spark.read.parquet(f"{root}/runs/*/rejected").count() == 1
    filing = writers.read_loaded(spark, writers.table_path(root, "edgar")).head()
    assert filing["source_gcs_uri"].startswith("gs://b/source/edgar/BB/2024-03-01/com_bb_2024_") and filing["source_gcs_uri"].endswith(".htm")
    assert filing["filing_type"] == "10-K" and str(filing["date"]) == "2024-03-01"
    assert not readers.path_exists(spark, f"{root}/stage/edgar/v1")
    assert writers.read_prod(spark, root, "edgar").count() == 1


def test_extraction_comes_after_the_gates_and_once(spark, tmp_path):
    inputs = job_inputs(spark, tmp_path / "land")
    calls = spark.sparkContext.accumulator(0)

    def extractor(texts):
        calls.add(len(texts))
        return pd.DataFrame({"summary": texts, "key_entities": [[]] * len(texts), "topics": [[]] * len(texts)})

    ingest.run_ingest(spark, inputs, SETTINGS, str(tmp_path / "job"), extractor)
    # u0, u2 and the filing once each, the three chunks of the large file; f1 is stored, u3 failed.
    assert calls.value == 6


def test_sources_and_discovery_errors(spark, tmp_path):
    inputs = job_inputs(spark, tmp_path / "land")
    companies = spark.createDataFrame([("aa", "A", None, "b"), ("AA ", "B", None, "b")], "company_ticker string, company_name string, company_id string, base_url string")
    with pytest.raises(ValueError, match="newsletter"):
        ingest.build_requests(companies, 2024, 2024, "newsletter")
    assert ingest.build_requests(companies, 2024, 2024, "Articles").count() == 1
    errors = "company_ticker string, year int, source_kind string, pos long, error string"
    part = spark.createDataFrame([("AA", 2024, "edgar", 1, "boom"), ("ZZ", 2024, "edgar", 1, "not asked")], errors)
    summary = ingest.run_ingest(spark, replace(inputs, errors=part), SETTINGS, str(tmp_path / "job"))
    assert {r["company"]: r["source_errors"] for r in summary.collect()} == {"AA": "edgar: boom", "BB": None}
    none = replace(inputs, errors=part, articles=inputs.articles.limit(0), filings=inputs.filings.limit(0))
    with pytest.raises(RuntimeError, match="failed for AA: edgar: boom"):
        ingest.run_ingest(spark, none, SETTINGS, str(tmp_path / "other"))


def test_an_interrupted_load_is_not_loaded_twice(spark, tmp_path):
    root = str(tmp_path)
    rows = records(spark, ("a", "2026-01-01", "t", TS))
    staged = writers.stage_documents(spark, rows, root)
    # Loaded, then lost before promotion: the rows are still in stage.
    writers.append_load(spark, writers.read_staged(spark, staged["articles"], "articles"), writers.table_path(root, "articles"))
    done = ingest.load_and_promote(spark, staged, root, f"{root}/ids")
    assert [r["document_id"] for r in done.collect()] == ["a"]
    assert writers.read_loaded(spark, writers.table_path(root, "articles")).count() == 1
    assert writers.read_prod(spark, root, "articles").count() == 1


def landed_stream(spark, tmp_path, inputs):
    """(land a response, start the stream and wait): titles in the table after each start."""
    landing, root = tmp_path / "in", str(tmp_path / "job")

    def land(name, *items):
        put(landing / "source_kind=articles" / "company_ticker=AA" / "year=2024" / name, json.dumps(items))

    def run():
        side = lambda: {"names": inputs.names, "contents": inputs.contents, "pages": inputs.pages}
        ingest_stream(spark, str(landing), root, str(tmp_path / "ckpt"), inputs.requests, side, SETTINGS).awaitTermination()
        return sorted(r["title"] for r in writers.read_loaded(spark, writers.table_path(root, "articles")).collect())

    return land, run, root


def item(i, title=None, folder="d"):
    return {"title": title or f"t{i}", "url": f"u{i}", "filepath": f"{folder}/f{i}.html"}


def test_stream_takes_each_document_once(spark, tmp_path):
    land, run, root = landed_stream(spark, tmp_path, job_inputs(spark, tmp_path / "land"))
    land("r1.json", *[item(i) for i in range(4)], {"title": 3, "url": "x"})
    assert run() == ["t0", "t2"]  # f1 is stored already, u3 failed
    assert spark.read.parquet(f"{root}/runs/*/rejected").count() == 1
    summary = spark.read.parquet(f"{root}/runs/*/summary").where("company = 'AA'").head()
    assert (summary["discovered"], summary["processed"]) == (4, 2)
    land("r2.json", *[item(i) for i in range(4)])
    assert run() == ["t0", "t2"]


def test_the_first_of_a_key_holds_across_restarts(spark, tmp_path):
    land, run, _ = landed_stream(spark, tmp_path, job_inputs(spark, tmp_path / "land"))
    land("r1.json", item(0, "first"), item(0, "second in the file", "e"))
    assert run() == ["first"]
    land("r2.json", item(0, "another of the key"), item(2))  # another document, the same key: no row
    assert run() == ["first", "t2"]
    land("r3.json", item(3, "failing"))
    assert run() == ["first", "t2"]
    land("r4.json", item(3, "other of its key"), item(3, "failing"))  # the first one may be tried again
    assert run() == ["first", "t2"]


def test_rows_without_state_share_groups(spark, tmp_path):
    inputs = job_inputs(spark, tmp_path / "land")
    value = F.concat(F.lit('{"title": 3, "url": "u'), "id", F.lit('"}'))  # a title that is no text is rejected
    columns = [readers.item_fields(F.parse_json(value)).alias("item"), F.lit("AA").alias("company_ticker"), F.lit(2024).alias("year"), F.lit("articles").alias("source_kind")]
    items = spark.range(3 * stream.SPREAD).select(*columns, F.struct(F.lit("f").alias("file"), F.col("id").alias("at")).alias("pos"))
    rows = stream.stream_rows(inputs.requests, items, inputs.names)
    found = rows.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("group").alias("groups")).collect()
    assert [(r["kind"], r["n"]) for r in found] == [(stream.REJECTED, 3 * stream.SPREAD)]
    assert 100 < found[0]["groups"] <= stream.SPREAD


class _State:
    def __init__(self, winner):
        self.exists, self.get = winner is not None, (winner,)

    def update(self, value):
        self.exists, self.get = True, value


@pytest.mark.parametrize("winner", [None, "a", "b", ""])
def test_single_rows_are_judged_as_others_are(winner):
    row = {name: None for name in stream.ROW.names} | {"group": "k", "file": "f", "at": 1}

    def result(*frames):
        state = _State(winner)
        out = list(stream._first_of_key(("k",), iter(frames), state))
        return [(r["kind"], r["document_id"], r["n_same_key"]) for f in out for r in f.to_dict("records")], state.get

    for kind, doc, n in ((stream.NEW, "a", 1), (stream.NEW, None, 1), (stream.NEW, "a", 3), (stream.REJECTED, None, 1)):
        one = pd.DataFrame([row | {"kind": kind, "document_id": doc, "n_same_key": n}], columns=stream.ROW.names)
        other = pd.DataFrame([row | {"kind": stream.STORED, "n_same_key": 1}], columns=stream.ROW.names)
        alone, state = result(one)
        beside, same = result(pd.concat([one, other]))
        assert state == same and sorted(map(str, alone)) == sorted(str(r) for r in beside if r[0] != stream.STORED)
    more = pd.DataFrame([row | {"kind": stream.NEW, "document_id": "b", "n_same_key": 2, "at": 0}], columns=stream.ROW.names)
    first = pd.DataFrame([row | {"kind": stream.NEW, "document_id": "a", "n_same_key": 1}], columns=stream.ROW.names)
    expected = {None: [("new", "b", 3)], "a": [("new", "a", 3)], "b": [("new", "b", 3)], "": []}[winner]
    assert result(first, more)[0] == expected == result(pd.concat([first, more]))[0]


def test_firsts_over_time_follow_the_rule_of_one_key(spark, tmp_path):
    rng, model = random.Random(5), {}
    schema = "kind string, ingestion_key string, document_id string, n_same_key long, file string, at long, url string"
    for number in range(3):
        rows = [
            (rng.choice([stream.NEW] * 5 + [stream.STORED]), rng.choice([None, *"klmnop"][: 5 + number]), rng.choice([None, "a", "b", "c"]), rng.randint(1, 2), f"f{rng.randint(0, 1)}", at, "u")
            for at in range(30)
        ]
        expected = []
        for key in {r[1] for r in rows}:
            own = [dict(zip(schema.replace(",", "").split()[::2], r, strict=True)) for r in rows if r[1] == key and r[0] == stream.NEW]
            state = model.setdefault(key, _State(None))
            best = [r for f in stream._first_of_key((key,), iter([pd.DataFrame(own)] if own else []), state) for r in f.to_dict("records")]
            expected += [(r["ingestion_key"], r["document_id"], r["n_same_key"], r["file"], r["at"], r["url"]) for r in best]
        batch = spark.createDataFrame(rows, schema).withColumns({"group": F.lit("g"), "reject_reason": F.lit(None).cast("string")})
        for attempt in range(2):  # the batch is done again, as after a failure
            found = stream.firsts_over_time(spark, batch, str(tmp_path / "state"), str(tmp_path / f"out{number}-{attempt}"))
            got = found.select("ingestion_key", "document_id", "n_same_key", "file", "at", "url").collect()
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_raw_documents_are_read_in_tasks_as_by_spark(spark, tmp_path, monkeypatch):
    root = tmp_path / "a b%20c"
    for k in range(40):
        put(root / f"k={k}" / "x.txt", f"text é {k}\n" * (k % 4))  # a fourth of the files is empty
    put(root / "k=1" / "deep" / "er" / "y.txt", "deep")
    put(root / "k=1" / "z.html", "other")
    put(root / "k=1" / "_hidden.txt", "hidden")
    put(root / "top.txt", "top")
    monkeypatch.setattr(listing, "CONTENT_BYTES", 50)

    def rows(frame):
        return sorted((r["path"], r["n_bytes"], bytes(r["content"])) for r in frame.collect())

    for pattern in ("*.txt", None):
        in_tasks = readers.read_raw_documents(spark, str(root), pattern)
        assert "binaryFile" not in in_tasks._jdf.queryExecution().toString()
        by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern or "*").load(str(root))
        want = rows(by_spark.selectExpr("path", "length as n_bytes", "content"))
        assert rows(in_tasks) == want and len(want) == (32 if pattern else 33)
    # Contents that nobody asks for are not read; globs and single files are as before.
    assert "ArrowEvalPython" not in in_tasks.select("path", "n_bytes")._jdf.queryExecution().executedPlan().toString()
    assert rows(readers.read_raw_documents(spark, str(tmp_path / "*" / "k=3"))) == [r for r in want if "/k=3/" in r[0]]
    assert [r[2] for r in rows(readers.read_raw_documents(spark, str(root / "top.txt")))] == [b"top"]

import datetime as dt

import pytest

from docflow.operators import migration as mg
from docflow.plans import migrate
from docflow.sinks import journal, versions, writers
from docflow.sources import readers

ROW = (
    "document_id string, company_ticker string, date date, year int, source_url string, title string,"
    " source_gcs_uri string, document_type string, gemini_chunk_uris string, __index_level_0__ long"
)
OLD = "gs://b/source/knowledge/"
DAY = dt.date(2024, 12, 31)


def rows(spark, *changes):
    base = dict(zip("document_id company_ticker date year source_url title source_gcs_uri document_type gemini_chunk_uris i".split(),
                    ("d", "aa", DAY, 2024, None, "10-K", OLD + "d.htm", "html", None, 0)))
    return spark.createDataFrame([tuple({**base, "document_id": f"d{i}", **c}.values()) for i, c in enumerate(changes)], ROW)


def listing(spark, *uris):
    return spark.createDataFrame([(u,) for u in uris], "uri string")


def ids(df):
    return sorted(r["document_id"] for r in df.collect())


def test_candidates(spark):
    df = rows(
        spark, {}, {"title": "News"}, {"title": None, "source_url": "https://www.SEC.gov/Archives/edgar/x"},
        {"title": None, "source_url": None, "source_gcs_uri": OLD + "a-DEF 14A.pdf"}, {"source_gcs_uri": "gs://c/source/knowledge/x"},
        {"source_gcs_uri": None}, {"title": "s-1", "company_ticker": "bb", "date": None},
    )
    found = mg.legacy_filing_candidates(df, "b")
    assert ids(found) == ["d0", "d2", "d3", "d6"]
    assert ids(mg.optional_filters(found, ticker="bb")) == ["d6"]
    assert ids(mg.optional_filters(found, date="2024-12-31")) == ["d0", "d2", "d3"]
    assert [r["document_id"] for r in mg.limit_candidates(found, 2).collect()] == ["d0", "d2"]
    assert [r["document_id"] for r in mg.order_candidates(found).collect()] == ["d0", "d2", "d3", "d6"]


def test_prefix_and_date_reach_the_scan(spark, tmp_path):
    rows(spark, {}).write.partitionBy("date").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = mg.optional_filters(mg.legacy_filing_candidates(stored, "b"), date="2024-12-31")
    plan = found.select("document_id")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(source_gcs_uri" in plan and "PartitionFilters: [isnotnull(date" in plan
    assert "gemini_chunk_uris" not in plan


def moves(spark, df, objects, **options):
    located = mg.exists_in_listing(mg.with_target(df, "b", 2026), objects)
    return {r["document_id"]: r["move"] for r in mg.classify_moves(located, **options).collect()}


def test_move_decisions(spark):
    target = "gs://b/source/edgar/AA/2024-12-31/"
    df = rows(
        spark, {}, {"source_gcs_uri": ""}, {"source_gcs_uri": "x"}, {"source_gcs_uri": target + "d3.htm"},
        {"source_gcs_uri": OLD + "gone.htm"}, {"source_gcs_uri": OLD + "lost.pdf"}, {"source_gcs_uri": None},
    )
    objects = listing(spark, OLD + "d.htm", target + "d4.htm")
    strict = moves(spark, df, objects)
    assert strict == {"d0": "move", "d1": "error", "d2": "error", "d3": "noop", "d4": "moved", "d5": "error", "d6": "error"}
    lenient = moves(spark, df, objects, allow_missing=True)
    assert [lenient[k] for k in ("d1", "d2", "d5", "d6")] == ["missing", "error", "missing", "missing"]
    dry = moves(spark, df, objects, allow_missing=True, dry_run=True)
    assert [dry[k] for k in ("d0", "d1", "d2", "d3", "d5")] == ["planned", "missing", "error", "noop", "planned"]


def test_execute(spark, tmp_path):
    df = rows(spark, {"gemini_chunk_uris": '["gs://b/p1"]'}, {"date": None, "year": 2021, "gemini_chunk_uris": "{bad"}, {"title": "News"})
    objects = listing(spark, OLD + "d.htm")
    options = dict(current_year=2026)
    root = str(tmp_path / "a")
    report = migrate.execute_migration(spark, df, objects, root, "b", "b", **options)
    assert report.row_count.head()["row_count"] == 2 and tuple(report.counts.head()) == (2, 0)
    assert sorted(r["move"] for r in report.moves.collect()) == ["move", "move"] and report.by_date.count() == 2
    table = {r["document_id"]: r for r in writers.read_loaded(spark, f"{root}/tables/edgar").collect()}
    assert table["d0"]["gemini_chunk_uris"] == ["gs://b/p1"] and table["d1"]["gemini_chunk_uris"] == []
    assert table["d1"]["source_gcs_uri"] == "gs://b/source/edgar/AA/2021-12-31/d1.htm"
    assert str(table["d1"]["date"]) == "2021-12-31" and table["d0"]["source_kind"] == "edgar"
    assert "__index_level_0__" not in writers.read_prod(spark, root, "edgar").columns
    skipped = migrate.execute_migration(spark, df, objects, str(tmp_path / "b"), "b", "b", skip_load=True, **options)
    assert skipped.row_count.head()["row_count"] == 2 and not readers.path_exists(spark, str(tmp_path / "b" / "tables"))
    with pytest.raises(FileNotFoundError):
        migrate.execute_migration(spark, df, listing(spark), str(tmp_path / "c"), "b", "b", **options)
    assert not readers.path_exists(spark, str(tmp_path / "c"))


def test_migration_keeps_other_rows_and_loads_once(spark, tmp_path):
    root = str(tmp_path)
    name = writers.PROD_FOLDERS["edgar"]
    old = [(i, "AA", DAY) for i in ("old1", "old2")] + [("keep", "AA", dt.date(2023, 1, 1))]
    rows_before = spark.createDataFrame(old, "document_id string, company_ticker string, date date")
    writers.append_load(spark, rows_before, f"{root}/{name}")
    writers.append_load(spark, rows_before.where("document_id <> 'old2'"), writers.table_path(root, "edgar"))
    df, objects = rows(spark, {"document_id": "mig"}), listing(spark, OLD + "d.htm")
    for _ in range(2):
        report = migrate.execute_migration(spark, df, objects, root, "b", "b", current_year=2026)
        assert ids(writers.read_prod(spark, root, "edgar")) == ["keep", "mig", "old1", "old2"]
        assert ids(writers.read_loaded(spark, writers.table_path(root, "edgar"))) == ["keep", "mig", "old1"]
        assert report.row_count.head()["row_count"] == 3
    skipped = migrate.execute_migration(spark, rows(spark, {"document_id": "more"}), objects, root, "b", "b", skip_gcs=True, current_year=2026)
    assert skipped.row_count.head()["row_count"] == 3 and skipped.prod_uris.count() == 1
    assert ids(writers.read_prod(spark, root, "edgar")) == ["keep", "mig", "old1", "old2"]


def states(spark, root):
    return {r["document_id"]: r["state"] for r in journal.read(spark, root).collect()}


def test_moves_are_resumed_from_any_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    df = rows(spark, {}, {"source_gcs_uri": OLD + "e.htm"}, {"source_gcs_uri": OLD + "gone.htm"})
    objects = listing(spark, OLD + "d.htm", OLD + "e.htm")

    def run():
        migrate.execute_migration(spark, df, objects, root, "b", "b", allow_missing=True, current_year=2026)

    def ids_of(*names):
        return spark.createDataFrame([(n,) for n in names], "document_id string")

    run()
    assert states(spark, root) == {"d0": "planned", "d1": "planned"}
    journal.advance(spark, root, ids_of("d0", "unknown"), "verified")  # not copied yet
    for state, before in zip(journal.STATES[1:], journal.STATES, strict=False):
        # A step that dies before its commit leaves the state; it is done again.
        monkeypatch.setattr(versions, "_rename", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            journal.advance(spark, root, ids_of("d0"), state)
        monkeypatch.undo()
        assert states(spark, root) == {"d0": before, "d1": "planned"}
        assert [r["source_uri"] for r in journal.pending(spark, root, before).where("document_id = 'd0'").collect()] == [OLD + "d.htm"]
        journal.advance(spark, root, ids_of("d0"), state)
        run()  # planning again leaves moves that are under way, or done, alone
        assert states(spark, root) == {"d0": state, "d1": "planned"}
    for wrong in ("planned", "lost"):
        with pytest.raises(ValueError):
            journal.advance(spark, root, ids_of("d1"), wrong)


def test_a_listing_may_repeat_itself(spark):
    df = rows(spark, {}, {"source_gcs_uri": OLD + "lost.htm"})
    once = mg.with_target(df, "b", 2026)
    got = mg.exists_in_listing(once, listing(spark, OLD + "d.htm", OLD + "d.htm"))
    assert sorted((r["document_id"], r["source_exists"], r["target_exists"]) for r in got.collect()) == [("d0", True, False), ("d1", False, False)]


def test_dry_run_plan(spark):
    df = rows(spark, {}, {"date": None, "year": 2021}, {"date": None, "year": None})
    plan = migrate.plan_migration(df, None, "b", "p", current_year=2026)
    assert [tuple(r) for r in plan.by_date.collect()] == [("2021-12-31", 1), ("2024-12-31", 1), ("2026-12-31", 1)]
    assert tuple(plan.counts.head()) == (3, 0)
    assert "gs://p/prod/edgar/v1/date=2021-12-31/d1.parquet" in {r["prod_uri"] for r in plan.prod_uris.collect()}

import random

from pyspark.sql import functions as F

from docflow.operators import gates

BASE = dict(
    title="t", company_name="Bramley", company_id="com_aa", company_ticker="AA", base_url="b", year=2026, date=None,
    url="u", type="html", filepath="data/x.html", downloaded=False, gcs_uri=None, source_kind="articles",
    filing_type=None, filing_date=None, report_date=None, accession_number=None, primary_document=None, cik=None,
)
SCHEMA = (
    "pos long, title string, company_name string, company_id string, company_ticker string, base_url string, year int,"
    " date string, url string, type string, filepath string, downloaded boolean, gcs_uri string, source_kind string,"
    " filing_type string, filing_date string, report_date string, accession_number string, primary_document string, cik string"
)


def documents(spark, *changes):
    rows = [(i, *{**BASE, **c}.values()) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, SCHEMA)


def listing(spark, *keys):
    return gates.object_names(spark.createDataFrame([(k,) for k in keys], "key string"))


def positions(df):
    return sorted(r["pos"] for r in df.select("pos").collect())


def test_stored_article_is_dropped_and_repeats_stay(spark):
    docs = documents(spark, {"filepath": "data/existing.html"}, {"filepath": "data/new.html"}, {"filepath": "data/new.html"})
    names = listing(spark, "source/knowledge/AA/2026/existing.html", "source/knowledge/AA/2025/new.html")
    assert positions(gates.anti_join_stored(docs, names)) == [1, 2]


def test_filing_is_matched_by_id_and_extension_of_its_type(spark):
    filing = dict(source_kind="edgar", date="2024-12-31", accession_number="0-1", primary_document="aa-10k.htm")
    docs = documents(spark, filing, {**filing, "accession_number": "0-2"})
    keyed = gates.with_source_key(docs).orderBy("pos").collect()
    assert {k["prefix"] for k in keyed} == {"source/edgar/AA/2024-12-31/"}
    stored = keyed[0]["prefix"] + keyed[0]["filename"]
    assert stored.endswith(".html")
    assert positions(gates.anti_join_stored(docs, listing(spark, stored))) == [1]
    # An .htm copy is another name: this gate lets the document through.
    assert positions(gates.anti_join_stored(docs, listing(spark, stored[:-1]))) == [0, 1]


def test_listing_answers_for_every_folder_above(spark):
    docs = documents(spark, {"filepath": "x.html"}, {"filepath": "x.html", "company_ticker": "BRK/B"})
    assert positions(gates.anti_join_stored(docs, listing(spark, "source/knowledge/AA/2026/deep/er/x.html"))) == [1]
    assert positions(gates.anti_join_stored(docs, listing(spark, "source/knowledge/BRK/B/2026/x.html"))) == [0]


def test_random_gate_equals_a_plain_model(spark):
    rng = random.Random(11)
    files = [f"f{i}.html" for i in range(6)]
    changes = [
        {"company_ticker": rng.choice("ab"), "year": rng.choice([2024, 2025]), "filepath": f"d/{rng.choice(files)}"}
        for _ in range(200)
    ]
    # One key holds a third of all rows.
    changes += [{"company_ticker": "hot", "filepath": "d/hot.html"}] * 100
    keys = {
        f"source/knowledge/{rng.choice('AB')}/{rng.choice([2024, 2025])}/{rng.choice(['', 'n/'])}{rng.choice(files)}"
        for _ in range(12)
    } | {"other/knowledge/A/2024/f0.html"}
    want = [
        i for i, c in enumerate(changes)
        if not any(
            k.startswith(f"source/knowledge/{c['company_ticker'].upper()}/{c.get('year', 2026)}/")
            and k.split("/")[-1] == c["filepath"].split("/")[-1]
            for k in keys
        )
    ]
    assert positions(gates.anti_join_stored(documents(spark, *changes), listing(spark, *keys))) == want


def test_each_family_is_looked_up_in_its_own_table(spark):
    docs = documents(spark, {}, {"source_kind": "edgar"}, {"title": "other"})
    first = gates._own_table_key(docs).orderBy("pos").head()["document_id"]
    table = spark.createDataFrame([(first,), (first,)], "document_id string")
    empty = table.limit(0)
    fresh, old = gates.split_known(docs, gates.known_documents(table, empty))
    assert (positions(fresh), positions(old)) == ([1, 2], [0])
    fresh, old = gates.split_known(docs, gates.known_documents(empty, table))
    assert (positions(fresh), positions(old)) == ([0, 2], [1])
    marked = gates.mark_known(docs, gates.known_documents(table, empty))
    assert {r["pos"]: r["skipped"] for r in marked.collect()} == {0: True, 1: False, 2: False}
    assert gates.exists_probe(table, first) and not gates.exists_probe(table, "x")


def test_first_of_an_ingestion_key_wins(spark):
    docs = documents(spark, {"filepath": "a/x"}, {"filepath": "b/x"}, {"filepath": "a/y"}, {"source_kind": "edgar", "filepath": "c/x"})
    firsts = gates.one_per_ingestion_key(docs.repartition(3))
    assert {r["pos"]: r["n_same_key"] for r in firsts.collect()} == {0: 2, 2: 1, 3: 1}
    marked = gates.mark_duplicates(docs)
    assert {r["pos"]: r["duplicate"] for r in marked.collect()} == {0: False, 1: True, 2: False, 3: False}


def test_hot_ingestion_key_is_combined_before_the_shuffle(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("pos"), *[F.lit(v).cast(t).alias(n) for n, t, v in _columns()]
    )
    firsts = gates.one_per_ingestion_key(docs)
    assert [(r["pos"], r["n_same_key"]) for r in firsts.collect()] == [(0, 3000)]
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_min_by" in plan


def _columns():
    types = dict(f.split(" ") for f in SCHEMA.replace(", ", ",").split(","))
    return [(n, types[n], v) for n, v in BASE.items()]

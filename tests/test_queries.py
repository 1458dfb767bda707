"""Every registered query against its SQL, on the smallest tables.

Those that write files and run whole jobs are compared here as well.
"""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry
from docflow.checks import files, registry  # noqa: F401  (files registers its queries)
from docflow.checks.fixtures import TABLES, Fixtures

SF = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    return connection


def counted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_is_offered():
    assert set(entry.queries()) >= set(registry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, db, name):
    frame = registry.QUERIES[name](Fixtures(spark, SF))
    got = counted(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert got == counted(names, result.fetchall())


def test_filings_of_every_customer_are_counted(spark):
    rows = registry.QUERIES["ingest_companies"](Fixtures(spark, SF)).where("discovered > 0").collect()
    assert any(int(r["company"][1:]) > 100 for r in rows)
    assert "% 100" not in registry.ORACLES["ingest_companies"]


def test_folders_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(40).selectExpr("cast(id as string) as value", "id % 20 as k").coalesce(1)
    files._to_folders(rows, str(tmp_path / "out"), "k")
    found = spark.read.text(str(tmp_path / "out"))
    assert sorted((r["k"], r["value"]) for r in found.collect()) == sorted((i % 20, str(i)) for i in range(40))
    parts = {p.name.split("-")[1] for p in (tmp_path / "out").glob("k=*/part-*")}
    assert len(parts) > 1


def test_a_folder_has_one_file_in_the_order_of_a_column(spark, tmp_path):
    rows = spark.range(60).selectExpr("cast(59 - id as string) as value", "id % 20 as k", "59 - id as pos").repartition(7)
    for _ in range(2):
        files._to_folders(rows, str(tmp_path / "out"), "k", order="pos")
    texts = [p.read_text().split() for p in (tmp_path / "out").glob("k=*/part-*")]
    assert len(texts) == 40 and all(t == sorted(t, key=int) and len(t) == 3 for t in texts)
    assert len({p.name.split("-")[1] for p in (tmp_path / "out").glob("k=*/part-*")}) > 1


def test_raw_files_are_those_of_spark(spark, tmp_path):
    rows = spark.createDataFrame([("é\nb", 1), (None, 2), ("", 3), ("x", None), ("same", 5), ("same", 5)], "value string, k long")
    found = []
    for name, write in (("own", files._to_raw_files), ("spark", lambda rows, path: files._to_folders(rows, path, "k"))):
        for path in (f"{tmp_path}/{name}", f"file://{tmp_path}/{name}-uri"):
            write(rows, path)
            found.append({p.parent.name: p.read_bytes() for p in (tmp_path / path.rsplit("/", 1)[1]).glob("k=*/part-*.txt")})
    assert len(found[0]) == 5 and all(f == found[0] for f in found)

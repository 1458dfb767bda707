import datetime as dt
import hashlib
import json
import random
from pathlib import PurePosixPath
from urllib.parse import urlparse

from pyspark.sql import functions as F

from docflow import functions as fn
from docflow.functions.items import item_fields, url_path
from docflow.functions.layout import suffix
from docflow.functions.text import WHITESPACE


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, texts, column):
    return [r[0] for r in values(spark, [(t,) for t in texts], "x string", column)]


def test_strip_removes_all_unicode_white_space(spark):
    texts = ["a", " a ", f"{WHITESPACE}a b{WHITESPACE}", "", " 　", "a​"]
    assert one(spark, texts, fn.strip("x")) == [t.strip() for t in texts]


def test_blank_to_null(spark):
    assert one(spark, [None, "", " \t", " x "], fn.blank_to_null("x")) == [None, None, None, "x"]


def test_cik_is_filled_but_never_cut(spark):
    texts = ["1", "0000000001", "12345678901", "12a", None]
    assert one(spark, texts, fn.cik10("x")) == ["0000000001", "0000000001", "12345678901", "12a", None]


def python_date(text, year):
    try:
        return dt.date.fromisoformat(text.strip()).isoformat()
    except ValueError:
        return f"{year}-12-31"


def date_texts():
    rng = random.Random(7)
    fixed = [
        "2024", "2024-03", "2024-3-5", "2024-03-05", "20240305", "2024-03-05T10:00", " 2024-03-05 ",
        "2024-W10", "2024W10", "2024-W10-3", "2024W103", "2024-W103", "2024W10-3", "2020-W53-7",
        "2021-W53", "2024-W00", "2024-W10-0", "2024-W10-8", "0000-01-01", "2023-02-29", "", "x",
        "2024-0305", "202403-05", "2024-03-05\n", "2024-366", "9999-12-31", "0001-01-01",
    ]
    for _ in range(400):
        y, m, d = rng.randint(1990, 2030), rng.randint(0, 13), rng.randint(0, 32)
        w, k = rng.randint(0, 54), rng.randint(0, 8)
        fixed += [f"{y}-{m:02d}-{d:02d}", f"{y}{m:02d}{d:02d}", f"{y}-W{w:02d}-{k}", f"{y}W{w:02d}{k}", f"{y}W{w:02d}"]
    return fixed


def test_partition_date_accepts_what_the_iso_parser_accepts(spark):
    texts = date_texts()
    got = one(spark, texts, fn.partition_date("x", F.lit(2019)))
    assert got == [python_date(t, 2019) for t in texts]
    assert one(spark, [None], fn.partition_date("x", F.lit(2019))) == ["2019-12-31"]


def test_row_date_falls_back_to_the_year(spark):
    rows = [("2024-05-01", 2020), (None, 2020), ("", 2021), (None, None)]
    got = values(spark, rows, "date string, year int", fn.row_date(current_year=2026))
    assert [g[0] for g in got] == ["2024-05-01", "2020-12-31", "2021-12-31", "2026-12-31"]


DOC = "title string, company_id string, year int, source_kind string, accession_number string, primary_document string"


def test_document_id_hashes_title_or_accession(spark):
    rows = [
        ("T", "com_aa", 2024, "articles", "0-1", "d.htm"),
        ("T", "com_aa", 2024, "edgar", "0-1", "d.htm"),
        ("T", "com_aa", 2024, "edgar", "0-1", None),
        ("T", "com_aa", 2024, "edgar", None, "d.htm"),
    ]
    hashed = ["T", "0-1:d.htm", "0-1:", "T"]
    want = [f"com_aa_2024_{hashlib.md5(h.encode()).hexdigest()[:16]}" for h in hashed]
    assert [g[0] for g in values(spark, rows, DOC, fn.document_id())] == want


PATHS = ["a/b.HTM", "a/b", "a.d/b", "a/.hidden", "a/x.", "a/b.tar.gz", "b.pdf/", "a/./", "/", "", ".", "a/..", "..x", "a//b.x"]


def test_basename_and_suffix_follow_path_rules(spark):
    assert one(spark, PATHS, fn.basename("x")) == [PurePosixPath(p).name for p in PATHS]
    want = [PurePosixPath(p).suffix.lstrip(".").lower() or None for p in PATHS]
    assert one(spark, PATHS, suffix("x")) == want


def test_url_path_follows_url_rules(spark):
    urls = [
        "https://e.com/a/minutes.pdf?page=4", "https://e.com/a;b/c.pdf;v=1", "e.com/a.pdf#x",
        "//h/p.pdf", "mailto:a;b", "https://e.com", "x", "", "a b/{c}.PDF", "ftp://h/a;t=i",
    ]
    assert one(spark, urls, url_path("x")) == [urlparse(u).path for u in urls]


def item_values(spark, items, *columns):
    df = spark.createDataFrame([(json.dumps(i), "com_aa", 2026) for i in items], "j string, company_id string, year int")
    return [tuple(r) for r in df.coalesce(1).withColumn("item", item_fields(F.parse_json("j"))).select(*columns).collect()]


def test_document_type_and_path(spark):
    items = [
        {"url": "https://example.com/x", "is_pdf": True},
        {"url": "https://e.com/a/minutes.pdf?page=4"},
        {"url": "https://example.com/releases/q1-results"},
        {"url": "u", "type": "PDF"},
        {"url": "u.pdf", "type": "html"},
        {"url": "u", "type": "", "article_type": "pdf"},
        {"url": "u", "is_pdf": "true"},
        {"url": "u", "filepath": " data/a.PDF"},
        {"url": "u", "filepath": "https://h/a.pdf"},
        {"url": "u", "type": " pdf "},
    ]
    got = item_values(spark, items, fn.document_type(), fn.document_filepath())
    assert [g[0] for g in got] == ["pdf", "pdf", "html", "pdf", "html", "pdf", "html", "pdf", "pdf", "html"]
    assert got[2][1] == "data/com_aa/2026/069c957e404a5f5fbc1e713ef0df2cd9.html"
    assert got[7][1] == "data/a.PDF"
    assert got[8][1].startswith("data/com_aa/2026/") and got[8][1].endswith(".pdf")


def test_prod_key_and_uri_parts(spark):
    keys = [
        "stage/knowledge/company_metadata/provider=lseg/ticker=AA/year=2026/doc.parquet",
        "stage/edgar/v1/date=2024-12-31/doc.parquet", "stage/other/x", "x/stage/knowledge/y",
        "stage/knowledge/stage/knowledge/z",
    ]
    assert one(spark, keys, fn.prod_key("x")) == [
        "prod/knowledge/company_metadata/provider=lseg/ticker=AA/year=2026/doc.parquet",
        "prod/edgar/v1/date=2024-12-31/doc.parquet", None, None, "prod/knowledge/stage/knowledge/z",
    ]
    uris = ["gs://b/k/x", "gs://b/", "gs:///k", "http://b/k", "gs://b/k\nx"]
    assert one(spark, uris, fn.uri_bucket("x")) == ["b", None, None, None, "b"]
    assert one(spark, uris, fn.uri_key("x")) == ["k/x", None, None, None, "k\nx"]


def test_chunk_key_has_at_least_five_digits(spark):
    got = values(spark, [("d", 1), ("d", 123456)], "document_id string, chunk_no int", fn.chunk_key("/p/%/"))
    assert [g[0] for g in got] == ["p/%/d/part-00001.pdf", "p/%/d/part-123456.pdf"]


def test_error_outcomes(spark):
    size = "400 INVALID_ARGUMENT file is 61000017 bytes, exceeds max allowed file size for application/pdf"
    rows = [
        (size, "application/pdf", "direct", "split"), (size, "application/pdf", "chunk", "fail"),
        (size, "text/html", "direct", "empty"), ("429 busy", "application/pdf", "direct", "retry"),
        ("read Timed Out", "text/html", "chunk", "retry"), ("code 14290", "text/html", "direct", "fail"),
        ("http 400", "text/html", "direct", "empty"), ("http 400", "text/html", "merge", "fail"),
        ("400 and 503", "text/html", "direct", "retry"), ("x4001", "text/html", "direct", "fail"),
    ]
    got = values(spark, rows, "m string, mime_type string, stage string, want string", fn.error_outcome("m"), "want")
    assert [g[0] for g in got] == [g[1] for g in got]
    assert one(spark, [size], fn.is_transient("x")) == [False]


def test_json_texts(spark):
    assert one(spark, ['["a","b"]', "{bad", "", None, "[]"], fn.json_list_or_empty("x")) == [["a", "b"], [], [], None, []]
    texts = ['{"b":1,"a":{"d":null,"c":"é"}}', "null", "[1.0,2]", None]
    want = [json.dumps(json.loads(t), sort_keys=True) if t else None for t in texts]
    assert one(spark, texts, fn.sorted_json("x")) == want


def test_small_rules(spark):
    assert one(spark, ["pdf", "PDF", "html", "x"], fn.mime_type("x")) == ["application/pdf"] * 2 + ["text/html"] * 2
    assert one(spark, ["a b"], fn.search_base_url("x")) == ["https://www.google.com/search?q=a b"]
    rows = [(None, "AA"), (" ", "AA"), (" id ", "AA")]
    got = values(spark, rows, "i string, t string", fn.default_company_id("i", "t"))
    assert [g[0] for g in got] == ["com_aa", "com_aa", "id"]

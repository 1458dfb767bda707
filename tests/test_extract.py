import random
import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docflow.functions.features import standard_features
from docflow.operators import extract


def model(text):
    counts = Counter(re.findall("[a-z]{5,}", text.lower()))
    topics = [w for w, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:5]]
    lines = [line.strip() for line in text.split("\n")]
    scored = sorted((-sum(t in line.lower() for t in topics), i) for i, line in enumerate(lines) if line)
    summary = " ".join(lines[i] for i in sorted(i for _, i in scored[:2]))
    return summary, sorted(set(re.findall("[A-Z][a-z]{3,}", text))), topics


def test_default_extractor_reads_the_whole_text(spark):
    rng = random.Random(3)
    words = ["Bramley", "results", "quarter", "net", "Income", "growth", "and", "Board", "dividend"]
    texts = ["", "\n\n", "one line only", "x" * 50_000 + "\nLast line growth growth"]
    for _ in range(40):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(rng.randint(1, 8))]
        texts.append("\n".join(lines))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: tuple(r["f"]) for r in df.select("i", standard_features("text").alias("f")).collect()}
    assert got == {i: model(t) for i, t in enumerate(texts)}
    none = spark.createDataFrame([(None,)], "text string").select(standard_features("text").alias("f"))
    assert none.head()["f"] is None


def feature_rows(spark, rows):
    schema = "doc string, chunk_no int, features struct<summary:string,key_entities:array<string>,topics:array<string>>"
    return spark.createDataFrame(rows, schema)


def test_merge_keeps_first_occurrence_in_chunk_order(spark, monkeypatch):
    monkeypatch.setattr(extract, "MERGE_FAN_IN", 2)
    rows = [("a", n, (f"s{n}", ["Bramley", f"E{n % 3}"], [f"t{9 - n}"])) for n in range(1, 8)]
    rows += [("b", 1, ("only", ["Z", "A"], ["q"]))]
    random.Random(0).shuffle(rows)
    got = {r["doc"]: r for r in extract.merge_chunk_features(feature_rows(spark, rows), "doc").collect()}
    assert tuple(got["b"]["features"]) == ("only", ["Z", "A"], ["q"])
    merged = got["a"]["features"]
    assert merged["summary"] == "s1 s2 s3 s4 s5 s6 s7"
    assert merged["key_entities"] == ["Bramley", "E1", "E2", "E0"]
    assert merged["topics"] == ["t8", "t7", "t6", "t5", "t4", "t3", "t2"]
    assert (got["a"]["chunk_count"], got["b"]["chunk_count"]) == (7, 1)


def test_chunk_metadata_lists_every_part_in_order(spark):
    chunks = spark.createDataFrame([("d", 2), ("d", 1), ("e", 1)], "document_id string, chunk_no int")
    got = {r["document_id"]: r for r in extract.chunk_metadata(chunks, "gs://b/p").collect()}
    assert got["d"]["gemini_chunk_uris"] == ["gs://b/p/d/part-00001.pdf", "gs://b/p/d/part-00002.pdf"]
    assert got["e"]["gemini_chunk_count"] == 1


def test_route_limit_is_exclusive(spark):
    rows = [("pdf", 99), ("pdf", 100), ("pdf", 101), ("html", 101), ("pdf", None)]
    df = spark.createDataFrame(rows, "type string, n_bytes long").coalesce(1)
    routes = [r["route"] for r in extract.route_by_size(df, 100).collect()]
    assert routes == ["direct", "direct", "chunk", "direct", "direct"]


def test_custom_extractor_and_empty_answer(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "c")], "i int, text string")

    def upper(texts):
        return pd.DataFrame({"summary": texts.str.upper(), "key_entities": [[t] for t in texts], "topics": [[]] * len(texts)})

    made = extract.extract_features(df, upper)
    assert {r["i"]: tuple(r["features"]) for r in made.collect()} == {1: ("AB", ["ab"], []), 2: ("C", ["c"], [])}
    for none in (lambda texts: None, lambda texts: upper(texts).assign(summary=None)):
        with pytest.raises(Exception, match="empty answer"):
            extract.extract_features(df, none).collect()


def test_placeholder_only_for_rejected_direct_calls(spark):
    rows = [("http 400", "text/html", "direct"), ("http 400", "text/html", "chunk"), ("503", "text/html", "direct")]
    df = spark.createDataFrame(rows, "message string, mime_type string, stage string").coalesce(1)
    got = [r["features"] for r in extract.placeholder_for_errors(df).collect()]
    assert got[0]["summary"] == "Document parsing failed or document is empty."
    assert got[0]["topics"] == [] and got[1:] == [None, None]


def test_oversized_document_takes_the_chunk_route_whole(spark):
    text = "\n".join(f"Line{i} alpha beta gamma growth" for i in range(200))
    pages = spark.createDataFrame([("d", text)], "document_id string, text string")
    from docflow.operators.packing import text_pages

    split = extract.extract_chunked(text_pages(pages, "document_id"), 300)
    row = split.valid.head()
    assert row["chunk_count"] > 10 and row["features"]["topics"][0] == "alpha"
    assert split.rejected.isEmpty()
    assert split.valid.select(F.size("features.topics")).head()[0] >= 3

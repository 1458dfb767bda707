"""Landed JSON files against a plain reader of the same texts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from docflow.sources import json_values, readers


def put(root, name, text, ticker="AA"):
    path = root / f"company_ticker={ticker}" / "year=2024" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def titles(df):
    rows = df.orderBy("pos").select(F.try_variant_get("item.title", "$", "string").alias("t")).collect()
    return [r["t"] for r in rows]


ITEMS = [{"title": f"t{i} {{[}}] \" \\ é", "url": "u}", "n": {"a": [1, {"b": "]}"}]}} for i in range(3)]
NAMES = [i["title"] for i in ITEMS]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("".join(map(json.dumps, ITEMS)), NAMES),
        ("\n".join(json.dumps(i, indent=1) for i in ITEMS) + "\n", NAMES),
        (json.dumps(ITEMS), NAMES),
        (json.dumps(ITEMS, indent=3), NAMES),
        ("\n".join(map(json.dumps, ITEMS)) + "\n\n", NAMES),
        (json.dumps(ITEMS[:2]) + " rubbish " + json.dumps(ITEMS[2:]), [*NAMES[:2], None, NAMES[2]]),
        (json.dumps(ITEMS[:1]) + "\n" + json.dumps(ITEMS[1:]) + " and more", [*NAMES, None]),
        (json.dumps([1, "x", ITEMS[0], None]), [None, None, NAMES[0], None]),
        ("not json", [None]),
        ("", []),
        (" \n", []),
        ("[]", []),
        ("[[]]\n[ ]", []),
        ('{"title": "cut', [None]),
        ('{"title": "cut"', [None]),
        ('[{"title": "a"}, {"title": "b"', ["a", None]),
        ('{"title": broken}{"title": "b"}', [None, "b"]),
        (b"\xef\xbb\xbf" + json.dumps(ITEMS[:1]).encode(), NAMES[:1]),
        ('{"title": "open\n{"title": "b"}', [None]),
    ],
)
def test_every_item_of_a_file(spark, tmp_path, text, want):
    put(tmp_path, "r.json", text)
    got = readers.read_articles(spark, str(tmp_path))
    assert titles(got) == want
    assert {(r["company_ticker"], r["year"]) for r in got.collect()} <= {("AA", 2024)}


def test_lines_are_read_by_themselves(spark, tmp_path):
    text = '{"title": "a"}{"title": "b"}\n{"title": "open\n[{"title": "c"}, {"title": "d"}]\nrubbish } {\n{"title": "e"}\n'
    put(tmp_path, "r.ndjson", text)
    assert titles(readers.read_filings(spark, str(tmp_path), whole_file=False)) == ["a", "b", None, "c", "d", None, "e"]


def some_items(rng, n):
    out = []
    for i in range(n):
        deep = {"k": "}{" * rng.randrange(4), "l": [{"m": '"' * rng.randrange(3)}] * rng.randrange(3)}
        out.append({"title": f"t{i}", "url": "x" * rng.choice([0, 5, 300]), "deep": deep})
    return out


@pytest.mark.parametrize("split", [200, 1000])
@pytest.mark.parametrize("shape", ["array", "pretty", "lines", "row"])
def test_files_larger_than_a_split(spark, tmp_path, split, shape):
    rng = random.Random(split)
    items = some_items(rng, 120)
    text = {
        "array": json.dumps(items),
        "pretty": json.dumps(items, indent=2),
        "lines": "\n".join(map(json.dumps, items)),
        "row": json.dumps(items[:50]) + "oops" + "".join(map(json.dumps, items[50:])) + "]",
    }[shape]
    put(tmp_path, "large.json", text)
    put(tmp_path, "small.json", json.dumps(items[:3]), "BB")
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = readers.read_articles(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 3
        names = [f"t{i}" for i in range(120)]
        want = [*names[:50], None, *names[50:]] if shape == "row" else names
        assert titles(got.where("company_ticker = 'AA'")) == want
        assert titles(got.where("company_ticker = 'BB'")) == names[:3]
        at = [r["at"] for r in got.where("company_ticker = 'AA'").select("pos.at", "item").collect() if r["item"] is not None]
        raw = text.encode()
        assert sorted(at) == [i for i in sorted(at) if raw[i : i + 9] == b'{"title":' or raw[i : i + 1] == b"{"] and len(set(at)) == 120
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_scan_carries_its_state():
    import numpy as np

    text = '[{"a": "x}{\\"", "b": [1, {"c": 2}]}, {"d": 3}]{"e": "["}'
    buf = np.frombuffer(text.encode(), np.uint8)
    whole = json_values.scan(buf, np.zeros(1, np.int64), [json_values.State()])
    assert [text[b:e] for b, e in zip(whole.begin, whole.end)] == ['{"a": "x}{\\"", "b": [1, {"c": 2}]}', '{"d": 3}', '{"e": "["}']
    for cut in range(1, len(text)):
        if text[cut - 1] == "\\":
            continue  # pieces end with a brace
        state = json_values.State()
        for part in (buf[:cut], buf[cut:]):
            state = json_values.scan(part, np.zeros(1, np.int64), [state]).states[0]
        assert state == whole.states[0]
    assert json_values._size("16m") == 16 << 20 and json_values._size("134217728b") == 1 << 27

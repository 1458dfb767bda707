from docflow.llm import quality_rules as q
from tests.llm import plain


def test_counts_and_verdicts_on_awkward_rows(spark):
    counted = q.text_counts(plain.frame(spark)).cache()
    judged = q.judge(counted, ["lang", "source"]).collect()
    assert len(judged) == len(plain.awkward())
    want = {(i, *plain.rule_counts(t)) for i, t, *_ in plain.awkward()}
    assert {(r["doc_id"], *(r[c] for c in q.COUNTS)) for r in judged} == want
    for r in judged:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    counted.unpersist()
    assert q.judge(q.text_counts(spark.createDataFrame([], plain.SCHEMA)), ["lang"]).count() == 0


def test_thresholds_follow_the_group(spark):
    clean = " ".join(f"w{i}" for i in range(80))
    tables = " ".join(f"| w{i}" for i in range(80))
    rows = [(i, clean + f" n{i}", "en", "news", 1) for i in range(40)] + [(100 + i, tables + f" n{i}", "en", "tables", 1) for i in range(40)]
    rows += [(200, tables, "en", "news", 1), (201, clean, "en", "tables", 1)]
    got = {r["doc_id"]: r["kept"] for r in q.judge(q.text_counts(plain.frame(spark, rows)), ["lang", "source"]).collect()}
    assert not got[200] and got[201]
    assert all(got[i] for i in range(40))


def test_a_junk_source_of_a_third_of_all_rows_is_held(spark):
    clean = " ".join(f"w{i}" for i in range(80))
    junk = lambda k: " ".join(f"w{i}|" + "|" * (i < k % 37) for i in range(70))  # a share of 0.26 to 0.35
    for hot in (60, 13):  # a third of all rows, and a tenth
        rows = [(i, clean + f" n{i}", "en", f"s{i % 10}", 1) for i in range(120)]
        rows += [(1000 + i, junk(i), "en", "hot", 1) for i in range(hot)]
        judged = q.judge(q.text_counts(plain.frame(spark, rows)), ["lang", "source"]).collect()
        assert not any(r["base_failed"] for r in judged)
        assert {r["doc_id"] for r in judged if r["kept"]} == set(range(120))
    # in two languages, and as more than half of all rows
    for langs, n in ((["en", "fr"], 60), (["en"], 300)):
        rows = [(i, clean + f" n{i}", "en", f"s{i % 10}", 1) for i in range(120)]
        rows += [(1000 + i, junk(i), langs[i % len(langs)], "hot", 1) for i in range(n)]
        judged = q.judge(q.text_counts(plain.frame(spark, rows)), ["lang", "source"]).collect()
        assert {r["doc_id"] for r in judged if r["kept"]} == set(range(120))


def test_sketches_merge_and_are_accurate(spark):
    rows = [(i, " ".join(["abc" * (1 + i % 5)] * 60), "en", f"s{i % 3}", 1) for i in range(60)]
    counted = q.text_counts(plain.frame(spark, rows)).cache()
    whole = {(r["rule"], r["bucket"]): r["n"] for r in q.sketches(counted, []).collect()}
    parts = {}
    for r in q.sketches(counted, ["source"]).collect():
        key = (r["rule"], r["bucket"])
        parts[key] = parts.get(key, 0) + r["n"]
    assert whole == parts
    values = {r["bucket"]: r["v"] for r in q.sketches(counted, []).filter("rule = 'word_length'").selectExpr("bucket", f"{q.bucket_value('bucket')} as v").collect()}
    assert len(values) == 5
    for want, got in zip([3, 6, 9, 12, 15], sorted(values.values()), strict=True):
        assert abs(got - want) <= 1.01 * q.ACCURACY * want
    counted.unpersist()


def test_the_sql_is_the_same_rule(spark, tmp_path):
    import duckdb

    from docflow.llm import oracles

    clean = " ".join(f"word{i} and more" for i in range(40))
    junk = " ".join(f"#$% w{i}" for i in range(60))
    rows = [(i, f"{clean} {i}", "en", f"s{i % 4}", 1) for i in range(120)] + [(200 + i, f"{junk} {i}", "en", "junk", 1) for i in range(60)]
    rows += [(400, None, "de", None, None), (401, "", None, "s1", 0)]
    spark.createDataFrame(rows, plain.SCHEMA).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = q.op3_adaptive_rules(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = db.execute(oracles.SQL["op3_adaptive_rules"])
    order = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.fetchall())
    assert {r["doc_id"] for r in got.filter("kept").collect()} == set(range(120))

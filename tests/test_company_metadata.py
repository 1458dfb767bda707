import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docflow.operators import company_metadata as cm
from docflow.plans import company_metadata as plan

COMPANY = "company_ticker string, company_name string, company_id string, base_url string"
GOOD = {
    "provider": "lseg", "company_ticker": " qvt", "company_name": "Quillvane Tidal Power ", "company_id": "qv-17", "base_url": "https://quillvane.test",
    "matched_on": "company_ticker+base_url", "source_snapshot_uri": "gs://snapshots/q", "source_snapshot_date": "2023-11-30",
    "metadata": {"turbines": 12, "height_m": 1.0, "sites": {"west": [1, 2.50], "east": None, "open": True}, "näme": "Ørsund"}, "source_record": None,
}


def responses(spark, **bodies):
    rows = [(ticker, 2026, "lseg", json.dumps(body)) for ticker, body in bodies.items()]
    df = spark.createDataFrame(rows, "company_ticker string, year int, provider string, body string")
    return df.withColumn("response", F.parse_json("body"))


def companies(spark, *tickers):
    return spark.createDataFrame([(t, "Quillvane", None, "https://asked.test") for t in tickers], COMPANY)


def test_rows_and_summary(spark):
    made = plan.ingest_company_metadata(companies(spark, "qvt", "bb"), responses(spark, QVT=GOOD), 2026, " LSEG ")
    row = made.rows.head().asDict()
    key = hashlib.md5(b"com_qvt|QVT|https://asked.test|2026|lseg").hexdigest()[:16]
    # The id comes from the request, the fields from the response.
    assert row["metadata_id"] == f"com_qvt_2026_lseg_{key}"
    assert (row["company_ticker"], row["company_name"], row["company_id"], row["base_url"]) == ("QVT", "Quillvane Tidal Power", "qv-17", "https://quillvane.test")
    assert row["metadata_json"] == json.dumps(GOOD["metadata"], sort_keys=True) and row["source_record_json"] == "{}"
    assert row["ingestion_timestamp"].endswith("+00:00") and made.rows.count() == 1
    summary = {r["company"]: r.asDict() for r in made.summary.collect()}
    assert summary["QVT"]["promoted"] == 1 and summary["QVT"]["prod_gcs_uri"].startswith("gs://b/prod/knowledge/company_metadata/provider=lseg/ticker=QVT/year=2026/")
    assert summary["BB"]["message"] == "No company metadata found." and summary["BB"]["provider"] is None


def test_unusable_responses_are_rejected(spark):
    bad = {k: v for k, v in GOOD.items() if k != "matched_on"}
    cases = {"A": [], "B": bad, "C": {**GOOD, "metadata": "text"}, "D": {**GOOD, "source_snapshot_date": 5},
             "E": {**GOOD, "metadata": {}, "source_record": []}, "F": {**GOOD, "company_name": 7}}
    valid, rejected = cm.valid_metadata_response(responses(spark, **cases))
    assert sorted(r["company_ticker"] for r in valid.collect()) == ["E", "F"]
    assert rejected.count() == 4


def test_provider(spark):
    with pytest.raises(ValueError, match="unsupported"):
        cm.normalize_provider("other")
    df = spark.createDataFrame([(" Lseg ",), ("x",), (None,)], "provider string")
    valid, rejected = cm.require_provider(df)
    assert [r["provider"] for r in valid.collect()] == ["lseg"] and rejected.count() == 2

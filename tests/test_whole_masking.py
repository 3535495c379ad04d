import json

from recordflow.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_whole_texts_are_masked_and_come_back(spark):
    import duckdb

    shown = {r.id: r.shown for r in QUERIES["broken_whole_texts_masked"](spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert shown.keys() == texts.keys()
    for i, text in texts.items():
        if i % 4 < 2:
            assert shown[i].endswith(f"{text} u{i}@x.org")
        else:
            assert json.loads(shown[i])["note"] == text
    sql = ORACLES["broken_whole_texts_masked"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")
    assert dict(duckdb.sql(sql).fetchall()) == shown

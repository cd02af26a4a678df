from __future__ import annotations

import json
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.plans import insurance
from ledgerloom.sources import readers, writers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_source(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("transaction_id,amount,transaction_date\nT1,12.5,2024-01-02T03:04:05\nT2,,\n")
    df = readers.read_csv_source(spark, str(path), "transaction_id string, amount double, transaction_date timestamp")
    assert rows(df) == [("T1", 12.5, datetime(2024, 1, 2, 3, 4, 5)), ("T2", None, None)]


def test_trimmed_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("customer_id,email,risk_score\n C1 , Ann@X.COM ,2.5\n ,x@y.z,1\nC2,bad,oops\n")
    df = readers.read_csv_trimmed(
        spark, str(path), "customer_id string, email string, risk_score double", "customer_id", ["email"], insurance.customer_warnings()
    )
    assert rows(df) == [("C1", "ann@x.com", 2.5, []), ("C2", "bad", 0.0, ["invalid email format"])]


def test_json_array(spark, tmp_path):
    path = tmp_path / "p.json"
    schema = "policy_id string, customer_id string, policy_type string, coverage_amount double, annual_premium double, status string"
    path.write_text(
        json.dumps(
            [
                {"policy_id": " P1 ", "customer_id": "C1", "policy_type": "Auto", "coverage_amount": "100", "annual_premium": 5},
                {"policy_id": "P2", "policy_type": "Boat", "coverage_amount": 0, "annual_premium": "x", "status": "Lapsed "},
                {"customer_id": "C9"},
            ]
        )
    )
    df = readers.read_json_array(spark, str(path), schema, "policy_id", {"status": "Active"}, insurance.policy_warnings())
    found = {r.policy_id: r for r in df.collect()}
    assert sorted(found) == ["P1", "P2"]
    assert (found["P1"].status, found["P1"].annual_premium, found["P1"].dq_flags) == ("Active", 5.0, [])
    assert found["P2"].dq_flags == ["missing customer_id", "invalid policy_type", "invalid coverage_amount", "invalid annual_premium"]
    path.write_text("{ not json")
    with pytest.raises(Exception):
        readers.read_json_array(spark, str(path), schema, "policy_id").collect()


def test_documents(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"name": "Ann", "reading_history": ["x", "y"]}\n{"name": "Bob"}\n')
    df = readers.read_document_collection(spark, str(path), "name string, reading_history array<string>")
    assert rows(df) == [("Ann", ["x", "y"]), ("Bob", None)]


def test_rules(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(
        '{"rule_id": "R1", "rule_name": "one", "priority": "HIGH", "thresholds": {"risk_score": 75}, "active": true}\n\n'
        "this is no rule\n"
        '{"rule_id": "R2", "rule_name": "two", "is_active": false}\n'
    )
    assert rows(readers.read_jsonl_rules(spark, str(path))) == [
        ("R1", "one", "HIGH", 75, True, "file"), ("R2", "two", None, None, False, "file"),
    ]
    missing = readers.read_jsonl_rules(spark, str(tmp_path / "nowhere.json"))
    assert missing.count() == 3 and {r.rules_from for r in missing.collect()} == {"default"}
    with pytest.raises(Exception, match="nosuchscheme"):
        readers.read_jsonl_rules(spark, "nosuchscheme:///rules.json")


def test_declared_types_are_kept(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("id,v,d,n\n 1 , 2.50 , 2024-01-31 , x\n2,many,31-31-31,\n,1,2024-01-01,y\n")
    df = readers.read_csv_trimmed(spark, str(path), "id bigint, v decimal(10,2), d date, n string", "id")
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "decimal(10,2)", "date", "string"]
    assert rows(df) == [(1, Decimal("2.50"), date(2024, 1, 31), "x"), (2, None, None, "")]


def test_tables(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    with pytest.raises(LookupError, match="run the stage"):
        readers.read_table(spark, name)
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    try:
        writers.publish_table(df, name)
        writers.append_table(spark.createDataFrame([("b", 2, "ignored")], "v string, id int, extra string"), name)
        assert rows(readers.read_table(spark, name)) == [(1, "a"), (2, "b")]
        writers.append_table(spark.createDataFrame([(3,)], "id int"), name, replace=True)
        assert rows(readers.read_table(spark, name)) == [(3, None)]
        writers.publish_table(df, name)
        assert rows(readers.read_table(spark, name)) == [(1, "a")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_tables_join_without_a_shuffle(spark):
    names = [f"b_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in names:
            writers.publish_table(spark.range(100).toDF("customer_id"), name, bucket_by=(4, "customer_id"))
        joined = spark.table(names[0]).join(spark.table(names[1]), "customer_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_exports_and_views(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    writers.export_csv(df.repartition(4), str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("*.csv"))) == 4
    writers.export_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    back = readers.read_csv_source(spark, str(tmp_path / "many"), "id bigint, part bigint")
    assert rows(back) == rows(df)
    writers.export_json(df, str(tmp_path / "json"))
    assert readers.read_document_collection(spark, str(tmp_path / "json"), "id bigint, part bigint").count() == 100
    writers.register_views({"numbers": df})
    assert spark.sql("SELECT sum(id) AS s FROM numbers").first().s == 4950


def test_replace_period_rewrites_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "facts")
    first = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, year int")
    writers.replace_period(first, path, ["year"])
    writers.replace_period(spark.createDataFrame([(3, 2024)], "id int, year int"), path, ["year"])
    assert rows(spark.read.parquet(path).select("id", "year")) == [(1, 2023), (3, 2024)]


def test_stage_table_uses_the_folder_of_the_session(spark):
    folder = session.stage_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert folder.startswith(configured)
    stored = session.stage_table(spark.range(3).toDF("id"), "numbers")
    assert rows(stored) == [(0,), (1,), (2,)]
    assert all(folder.removeprefix("file:") in f for f in stored.inputFiles())

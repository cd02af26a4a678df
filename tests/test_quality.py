from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.operators.quality import FieldRule, TableRule
from ledgerloom.plans import banking


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


BOOKS = [("9781234567890", "Book", 1), ("bad", "", 2), (None, None, 3), ("9791234567890", "A very long title", 4)]


@pytest.fixture
def books(spark):
    return spark.createDataFrame(BOOKS, "isbn string, title string, id int")


def test_validate_schema(books):
    assert quality.validate_schema(books, ["isbn", "price"]) == ({"price"}, {"title", "id"})


def test_validate_field_level(books):
    rules = [
        FieldRule("isbn", required=True, type="string", pattern=r"97[89]\d{10}"),
        FieldRule("title", required=True, min_length=1, max_length=10, severity=quality.WARNING),
    ]
    assert rows(quality.validate_field_level(books, rules, "id")) == [
        ("2", "isbn", "pattern", "Pattern mismatch", "ERROR"),
        ("2", "title", "required", "Missing required value", "WARNING"),
        ("3", "isbn", "required", "Missing required value", "ERROR"),
        ("3", "title", "required", "Missing required value", "WARNING"),
        ("4", "title", "max_length", "String too long (len 17 > max 10)", "WARNING"),
    ]


def test_optional_fields_type_and_allowed(spark):
    df = spark.createDataFrame([("1", "12", "Auto"), ("2", "x", "Boat"), ("3", None, None), ("4", "", "")], "id string, n string, t string")
    found = quality.validate_field_level(df, [FieldRule("n", type="int"), FieldRule("t", allowed=("Auto", "Home"))], "id")
    assert rows(found.select("row_key", "rule")) == [("2", "allowed"), ("2", "type"), ("4", "allowed"), ("4", "type")]


def test_missing_field_empty_frame_and_no_rules(spark, books):
    rule = [FieldRule("price", required=True), FieldRule("stock")]
    assert rows(quality.validate_field_level(books, rule, "id")) == [
        (None, "price", "required", "Missing required field 'price'", "ERROR")
    ]
    assert quality.validate_field_level(books.limit(0), rule, "id").count() == 0
    assert quality.validate_field_level(books, [], "id").count() == 0


def test_validate_list_length(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, ["a", "b", "c"]), (4, None)], "id int, genres array<string>")
    found = quality.validate_list_length(df, "genres", "id", 1, 2)
    assert rows(found.select("row_key", "message")) == [
        ("2", "Too short (length 0 < min_length 1)"), ("3", "Too long (length 3 > max_length 2)"),
    ]
    text = spark.createDataFrame([(1, "notalist")], "id int, genres string")
    assert quality.validate_list_length(text, "genres", "id", 1, 2).count() == 0
    assert quality.validate_list_length(text, "absent", "id", 1).count() == 0
    assert quality.validate_list_length(df, "genres", "id").count() == 0


def test_report_text(spark, books):
    found = quality.validate_field_level(books, [FieldRule("title", required=True)], "id")
    assert quality.quality_report_text(found).first().report == (
        "Data Quality Report Field 'title': [ERROR] Missing required value (2 rows)"
    )
    assert quality.quality_report_text(found.limit(0)).first().report == "No data quality issues found"


def test_gaps(spark):
    df = spark.createDataFrame([("1", "a@b.com"), ("2", "bad"), ("3", None), ("4", "c@d.org")], "customer_id string, email string")
    gaps = {
        r.field: (r.actual, round(r.gap, 3))
        for r in quality.field_quality_gaps(
            df, {"customer_id": (None, 1.0), "email": (F.col("email").contains("@"), 0.95), "age": (None, 0.6)}
        ).collect()
    }
    assert gaps == {"customer_id": (1.0, 0.0), "email": (0.5, 0.45), "age": (0.0, 0.6)}
    empty = quality.field_quality_gaps(df.limit(0), {"email": (None, 0.5)}).first()
    assert (empty.actual, empty.gap) == (0.0, 0.5)


def test_row_rules_on_an_empty_table_pass(spark):
    df = spark.createDataFrame([], "x int")
    result = quality.check_rows(df, "t", [TableRule("positive", F.col("x") < 0, "fine", "broken")]).first()
    assert tuple(result) == ("positive", "t", 0, 0, "PASSED", 0.0, "fine")


def test_foreign_key_counts_rows_and_missing_keys(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dimension = spark.createDataFrame([(1,), (1,)], "k int")
    late = TableRule("late", F.col("k") > 0, "fine", "broken")
    references = {"k": (dimension, TableRule("fk", F.lit(False), "fine", "broken"))}
    result, known = quality.check_key_sets(facts, references, "t", {"k": [late]}).collect()
    assert (known.rule_name, known.records_checked, known.records_failed) == ("late", 2, 2)
    assert (result.records_checked, result.records_failed, result.failure_percentage) == (4, 2, 50.0)


def test_extract_checks(spark):
    people = spark.createDataFrame([("a",), ("b",)], "id string")
    orders = spark.createDataFrame([("a",), ("z",), ("z",)], "id string")
    found = {r.check_name: (r.actual, r.passed) for r in quality.check_extracts({"p": people, "o": orders}, {"p": 2, "o": 5}, [("o", "p", "id")]).collect()}
    assert found == {"minimum rows: p": (2, True), "minimum rows: o": (3, False), "orphaned id: o": (1, False)}


def test_orphan_report(spark):
    facts = spark.createDataFrame([(1,), (9,), (9,)], "k int")
    assert rows(quality.orphan_report(facts, {"customers": ("k", spark.createDataFrame([(1,)], "k int"))})) == [("customers", 2)]


def test_validation_suite_finds_each_kind(spark):
    holders = spark.createDataFrame(
        [
            (1, "a", date(2020, 1, 1), None, True),
            (2, "a", date(2020, 1, 1), None, True),
            (3, "b", date(2021, 1, 1), date(2020, 1, 1), True),
        ],
        "account_holder_key int, account_holder_id string, effective_date date, expiration_date date, is_current boolean",
    )
    products = spark.createDataFrame([(1,)], "banking_product_key int")
    dates = spark.createDataFrame([(20240101,), (20300101,)], "date_key int")
    facts = spark.createDataFrame(
        [
            (1, 1, 20240101, 10, "CC123456", Decimal("5.00")),
            (9, 2, 20300101, 10, "XX1", Decimal("60000.00")),
            (1, 1, 19990101, 11, None, Decimal("-60000.00")),
        ],
        "account_holder_key int, banking_product_key int, date_key int, transaction_id int, account_number string, transaction_amount decimal(12,2)",
    )
    result = banking.validation_suite(facts, holders, products, dates, date(2024, 6, 1)).collect()
    titles = {text[0]: name for name, text in banking.RULE_TEXT.items()}
    assert {titles[r.rule_name]: (r.records_checked, r.records_failed) for r in result} == {
        "holder": (3, 1), "product": (3, 1), "date": (3, 1), "future": (2, 1), "amount": (3, 2), "account": (3, 2),
        "sequence": (3, 1), "current": (3, 1), "one_current": (2, 1), "unique": (2, 1),
    }
    assert {r.validation_status for r in result} == {"FAILED"}
    clean = banking.validation_suite(facts.limit(0), holders.limit(0), products, dates, date(2024, 6, 1)).collect()
    assert {(r.validation_status, r.records_checked) for r in clean} == {("PASSED", 0)} and len(clean) == 10


def test_run_health(spark):
    at = lambda second: datetime(2024, 1, 1, 0, 0, second)
    log = spark.createDataFrame(
        [("extract", at(0), at(5), 10, 9), ("extract", at(2), at(9), 10, 10), ("load", at(10), at(40), 0, 0)],
        "step string, started_at timestamp, finished_at timestamp, records int, good_records int",
    )
    found = {r.step: tuple(r)[1:] for r in quality.run_health(log, {"extract": 8, "total": 60}, 30).collect()}
    assert found == {
        "extract": (9.0, 20, 0.95, 8.0, False),
        "load": (30.0, 0, 1.0, 30.0, True),
        "total": (40.0, 20, 0.95, 60.0, True),
    }
    assert quality.run_health(log.limit(0), {}).count() == 0


def test_validation_from_states_after_added_changed_and_removed_days(spark, tmp_path):
    import shutil

    from ledgerloom.operators.daystates import DayPartitions
    from ledgerloom.sources.writers import replace_period

    ids = spark.range(1, 400)
    holders = spark.createDataFrame(
        [(k, f"h{k}", date(2020, 1, 1), None, True) for k in range(5)],
        "account_holder_key bigint, account_holder_id string, effective_date date, expiration_date date, is_current boolean",
    )
    products = spark.createDataFrame([(1,), (2,)], "banking_product_key bigint")
    dates = spark.createDataFrame([(20240100 + d,) for d in range(1, 5)] + [(20240701,)], "date_key int")

    def day(key, shift):
        return ids.select(
            (F.col("id") % 6).alias("account_holder_key"), (F.col("id") % 3).alias("banking_product_key"), F.lit(key).cast("int").alias("date_key"),
            (F.col("id") + shift).alias("transaction_id"), F.when(F.col("id") % 7 > 0, "CC123456").alias("account_number"),
            (F.col("id") * 200).cast("decimal(12,2)").alias("transaction_amount"),
        )

    path, store = str(tmp_path / "facts"), str(tmp_path / "states")
    write = lambda df: replace_period(df, path, ["date_key"])
    table = DayPartitions(spark, path, "date_key", day(1, 0).schema)
    until = date(2024, 6, 1)

    def same_as_full(expected, limits=banking.AMOUNT_LIMITS):
        assert banking.refresh_check_states(table, store, limits) == [f"date_key={d}" for d in expected]
        report = banking.validation_from_states(store, holders, products, dates, until, limits)
        assert "facts" not in {f.split("/")[-3] for f in report.inputFiles()} and not any(path in f for f in report.inputFiles())
        whole = spark.read.schema(table.schema).parquet(path)
        full = banking.validation_suite(whole, holders, products, dates, until, limits)
        assert sorted(map(tuple, report.collect())) == sorted(map(tuple, full.collect()))
        return {r.rule_name: r.records_failed for r in full.collect()}

    write(day(20240101, 0).unionByName(day(20240102, 1000)).unionByName(day(20240701, 2000)))
    same_as_full(["20240101", "20240102", "20240701"])
    assert banking.refresh_check_states(table, store) == []
    write(day(20240103, 900))  # shares ids with the second day
    found = same_as_full(["20240103"])
    assert found[banking.RULE_TEXT["unique"][0]] == 299
    write(day(20240102, 5000).limit(50))
    assert same_as_full(["20240102"])[banking.RULE_TEXT["unique"][0]] == 0
    shutil.rmtree(f"{path}/date_key=20240701")
    assert same_as_full([])[banking.RULE_TEXT["future"][0]] == 0
    assert len(banking.refresh_check_states(table, store, (-10, 10))) == 3  # other limits judge all days again

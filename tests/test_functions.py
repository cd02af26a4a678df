from __future__ import annotations

import hashlib
import string
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import conditions, dates, numbers, text
from ledgerloom.plans import insurance


def test_clean_dates(values):
    assert values(dates.parse_iso_date, ["2020-01-01", "not-a-date", None, "32-13-2020", "2020-02-30", " 2020-02-29 "]) == [
        date(2020, 1, 1), None, None, None, None, date(2020, 2, 29),
    ]


def test_clean_email(values):
    texts = ["good@email.com", "bad-email", None, "  a.b+c@x-y.org ", "a@b", "a@b.c", "two@a.com b@c.de", "a@b.com\n"]
    assert values(text.clean_email, texts) == ["good@email.com", None, None, "a.b+c@x-y.org", None, None, None, "a@b.com"]


def test_clean_phone(values):
    assert values(text.clean_phone, ["(123) 456-7890", "12345", None, "11234567890"]) == ["1234567890", None, None, None]


def test_standardize_phone(values):
    texts = [
        "1234567890", "11234567890", "(123) 456-7890", "123-456-7890", "", "123456789", "12345678901", "+1 (123) 456-7890", None, "  ",
    ]
    assert values(text.standardize_phone, texts) == [
        "(123) 456-7890", "(123) 456-7890", "(123) 456-7890", "(123) 456-7890", "UNKNOWN", "INVALID", "(234) 567-8901",
        "(123) 456-7890", "UNKNOWN", "UNKNOWN",
    ]


def test_clean_numeric(values):
    assert values(numbers.clean_numeric, ["10", "bad", None, "$1,234.50", "-1"]) == [10.0, None, None, 1234.5, -1.0]
    assert values(lambda c: numbers.clean_numeric(c, keep_sign=False), ["-1"]) == [1.0]


def test_clean_text(values):
    assert values(text.clean_text, ["  hello ", "WORLD", None, "o'brien mary-jane 3rd\n", "straße ß"]) == [
        "Hello", "World", "", "O'Brien Mary-Jane 3Rd", "Straße Ss",
    ]


@settings(max_examples=1, suppress_health_check=list(HealthCheck), deadline=None)
@given(st.lists(st.text(alphabet=string.printable + "äéßñøçÀÏœ", max_size=30), min_size=150, max_size=150))
def test_title_case_is_str_title(values, texts):
    assert values(text.title_case, texts) == [t.title() for t in texts]


def test_proper_case_needs_a_name(values):
    assert values(text.proper_case, ["", "  ", None, "mary ann LEE", "cher"]) == [None, None, None, "Mary Ann Lee", "Cher"]


def test_address(values):
    assert values(text.squeeze_spaces, ["  1  Main   St, New York  NY "]) == ["1 Main St, New York NY"]
    assert values(text.metro_city, ["1 Main St, New York NY", "1 Main St, Chicago IL ", "no comma", "1 A, B, Los Angeles CA"]) == [
        "New York", "Chicago", "", "B, Los Angeles",
    ]


def test_email_key_is_md5_modulo(values):
    texts = ["a@b.com", "", "é", "x" * 1000]
    wanted = [int(hashlib.md5(t.encode()).hexdigest(), 16) for t in texts]
    assert values(text.email_key, texts) == [w % 100_000 for w in wanted]
    assert values(lambda c: text.email_key(c, 15), texts) == [w % 15 for w in wanted]


def test_safe_numbers(values):
    assert values(numbers.safe_double, ["123.45", "", "invalid", " 7 ", None]) == [123.45, 0.0, 0.0, 7.0, 0.0]
    assert values(numbers.safe_int, ["123", "123.7", "", "45.9", "invalid", "-2.9", "1e300", None]) == [123, 123, 0, 45, 0, -2, 0, 0]


def test_round_half_up(values):
    assert values(numbers.round_to, [1.005, 2.675, -1.005, 0.125, None], "double") == [1.01, 2.68, -1.01, 0.13, None]


def test_cap_keeps_null(values):
    assert values(lambda c: numbers.cap(c, 100), [99, 101, None], "int") == [99, 100, None]


def test_age_and_keys(values):
    as_of = date(2024, 3, 15)
    age = lambda c: dates.age_in_years(dates.parse_iso_date(c), as_of)
    assert values(age, ["1985-03-15", "1985-03-16", "1990-12-25", "", "invalid"]) == [39, 38, 33, 0, 0]
    key = lambda c: dates.date_key(dates.parse_iso_date(c))
    assert values(key, ["2024-01-05", "", None, "2024-13-01"]) == [20240105, 0, 0, 0]


def test_season(values):
    texts = ["2024-12-01", "2024-02-01", "2024-03-01", "2024-06-30", "2024-11-30"]
    assert values(lambda c: dates.season(dates.parse_iso_date(c)), texts) == ["Winter", "Winter", "Spring", "Summer", "Fall"]


def test_case_bucket_first_match_and_null(values):
    ladder = lambda c: conditions.at_least(c, [(70, "HIGH"), (40, "MEDIUM")], "LOW")
    assert values(ladder, [70, 69, 40, 39, None], "int") == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def test_map_synonyms(values):
    groups = {"Premium": ("PREM", "PREMIUM"), "Basic": ("BASIC",)}
    mapped = lambda c: conditions.map_synonyms(c, groups, "Standard")
    assert values(mapped, ["prem", " Premium ", "basic", "other", None]) == ["Premium", "Premium", "Basic", "Standard", "Standard"]


def test_code_pattern(values):
    pattern = lambda c: conditions.code_pattern(c, ["CC", "CHK"], 6)
    assert values(pattern, ["CC123456", "CHK000001", "CC12345", "CC1234567", "XX123456", "CC123456\n", None]) == [
        True, True, False, False, False, False, None,
    ]


def test_insurance_tiers(spark):
    rows = [(1.5, 30), (3.2, 22), (2.5, 35), (1.8, 24), (1.8, 45)]
    df = spark.createDataFrame(rows, "s double, a int")
    tiers = [r.t for r in df.select(insurance.risk_tier(F.col("s"), F.col("a")).alias("t")).collect()]
    assert tiers == ["Low", "High", "Medium", "High", "Low"]
    premiums = spark.createDataFrame([(999.0,), (1000.0,), (1999.0,), (2000.0,)], "p double")
    assert [r.t for r in premiums.select(insurance.premium_tier(F.col("p")).alias("t")).collect()] == [
        "Economy", "Standard", "Standard", "Premium",
    ]
    claims = spark.createDataFrame([(0, 100), (1, 100), (100, 100), (101, 100), (1000, 200)], "c int, v int")
    assert [r.ok for r in claims.select(insurance.valid_claim_amount(F.col("c"), F.col("v")).alias("ok")).collect()] == [
        False, True, True, False, False,
    ]

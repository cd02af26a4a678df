from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, cleaning, dimensions, facts, keys, ordered


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- keys ----------------------------------------------------------------------------------


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"))
    first = {r.k: r.sk for r in keys.assign_surrogate_keys(df, "k", "sk", 50).collect()}
    again = {r.k: r.sk for r in keys.assign_surrogate_keys(df.repartition(7), "k", "sk", 50).collect()}
    assert sorted(first.values()) == list(range(51, 1051))
    assert first == again


def test_null_keys_are_numbered_and_upserted(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    found = {r.k: r.sk for r in keys.assign_surrogate_keys(df, "k", "sk").collect()}
    assert sorted(found.values()) == [1, 2, 3] and found.keys() == {"a", "b", None}
    # The number of buckets changes no number.
    assert found == {r.k: r.sk for r in keys.assign_surrogate_keys(df, "k", "sk", hex_digits=1).collect()}
    old = spark.createDataFrame([(1, "a", "x"), (2, "z", "y")], "sk bigint, k string, v string")
    new = spark.createDataFrame([("a", "A"), ("b", "B"), (None, "N")], "k string, v string")
    once = dimensions.scd1_upsert(old, new, "k", "sk")
    assert {r.k: r.v for r in once.collect()} == {"a": "A", "z": "y", "b": "B", None: "N"}
    again = dimensions.scd1_upsert(once, new, "k", "sk")
    assert rows(again) == rows(once)


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "z"), (None, "y")], "k int, v string")
    kept = keys.first_per_key(df, ["k"], ["v"])
    assert rows(kept) == [(1, "a"), (2, "c"), (None, "y")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert rows(keys.null_safe_join(left, right, ["k"])) == [(1, "a", "x"), (None, "b", "y")]


# --- ordered calculations ------------------------------------------------------------------


@pytest.fixture
def transactions(spark):
    """One key holds more than a third of all rows; some keys have very few."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = 0 if rng.random() < 0.4 else rng.choice([1, 2, 3, 4, 5, None])
        day = date(2024, 1, rng.randint(1, 9))
        amount = None if rng.random() < 0.02 else Decimal(rng.randint(-500, 500)) / 100
        data.append((key, day, i, amount))
    data += [(77, date(2024, 1, 1), 5000, Decimal("1.00")), (78, date(2024, 1, 1), 5001, Decimal("2.00")), (78, date(2024, 1, 9), 5002, Decimal("4.00"))]
    return spark.createDataFrame(data, "k int, day date, id bigint, amount decimal(12,2)")


@pytest.fixture(params=[1, 4, 23])
def ranges(spark, request):
    """One range holds everything, or every key is cut."""
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", kept)


IDS = {
    "dense": "id",
    "sparse": "id * 1000003 - 5000000000",
    "text": "concat('TXN', lpad(id, 6, '0'))",
    "hash": "md5(cast(id as string))",
}


@pytest.mark.parametrize("ids", IDS)
def test_running_sum_equals_plain_window(transactions, ranges, ids):
    df = transactions.withColumn("id", F.expr(IDS[ids]))
    w = Window.partitionBy("k").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("total", F.sum("amount").over(w))
    assert rows(ordered.running_sum(df, "k", "day", "id", "amount", "total")) == rows(plain)


@pytest.mark.parametrize("size,ids", [(3, "dense"), (3, "hash"), (5, "text"), (2, "sparse")])
def test_moving_average_equals_plain_window(transactions, ranges, size, ids):
    df = transactions.withColumn("id", F.expr(IDS[ids]))
    w = Window.partitionBy("k").orderBy("day", "id").rowsBetween(-(size - 1), 0)
    plain = df.withColumn(
        "m", F.try_divide(F.sum("amount").over(w).cast("double"), F.count("amount").over(w).cast("double"))
    )
    assert rows(ordered.moving_average(df, "k", "day", "id", "amount", "m", size)) == rows(plain)


@pytest.mark.parametrize("amount", ["amount", "amount / 1000", "cast(amount as double) * 1e9"])
def test_dense_rank_equals_plain_window(transactions, ranges, amount):
    df = transactions.withColumn("amount", F.expr(amount))
    w = Window.partitionBy("k").orderBy(F.desc("amount"))
    plain = df.withColumn("r", F.dense_rank().over(w))
    ranked = ordered.dense_rank_desc(df, "k", "amount", "r")
    assert rows(ranked) == rows(plain)


def test_a_hot_key_is_spread_over_the_ranges(spark, transactions):
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    sizes = [r["count"] for r in ordered.in_ranges(transactions, "k", ["day", "id"]).groupBy("_range").count().collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) >= 18 and max(sizes) < 3 * len(transactions.collect()) / 20


# --- aggregates ----------------------------------------------------------------------------


def brute_quantile(numbers, p):
    ordered_numbers = sorted(numbers)
    return next(v for i, v in enumerate(ordered_numbers, 1) if i / len(ordered_numbers) >= p)


@pytest.mark.parametrize(
    "name,numbers",
    [
        ("spread", [random.Random(1).randint(-(10**9), 10**9) for _ in range(500)]),
        ("skewed", [5] * 400 + list(range(100))),
        ("constant", [7] * 10),
        ("single", [3]),
        ("wide", [-(10**13), 0, 10**13, 10**13 - 1]),
    ],
)
@pytest.mark.parametrize("buckets", [64, 2**18])
def test_exact_quantiles(spark, name, numbers, buckets):
    probabilities = [0.1, 0.5, 0.7, 0.9, 1.0]
    df = spark.createDataFrame([(Decimal(n) / 100,) for n in numbers] + [(None,)], "v decimal(18,2)")
    found = aggregates.exact_quantiles(df, "v", probabilities, scale=2, buckets=buckets)
    assert found == [Decimal(brute_quantile(numbers, p)) / 100 for p in probabilities]


def test_quantiles_read_their_input_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    draw = random.Random(3)
    numbers = [int(draw.gauss(0, 10**6)) for _ in range(30_000)] + [77] * 9_000
    df = spark.createDataFrame([(n,) for n in numbers], "v long").mapInArrow(counting, "v long")
    probabilities = [0.01, 0.5, 0.5001, 0.6, 0.85, 0.999]
    found = aggregates.exact_quantiles(df, "v", probabilities, scale=0, buckets=64, accuracy=500)
    assert found == [brute_quantile(numbers, p) for p in probabilities]
    assert seen.value == 2 * len(numbers)


def test_quantiles_outside_their_brackets_are_found(spark, monkeypatch):
    """A sketch that errs costs time, not exactness."""
    numbers = list(range(1000))
    monkeypatch.setattr(aggregates, "quantile_brackets", lambda *_: (1000, [(3, 9), (400, 402)]))
    df = spark.createDataFrame([(n,) for n in numbers], "v long")
    assert aggregates.exact_quantiles(df, "v", [0.5, 0.9], scale=0) == [499, 899]


def brute_as_of(facts, versions):
    out = []
    for key, day, fact in facts:
        found = [v for v in versions if None not in (key, day, v[0], v[1]) and v[0] == key and v[1] <= day]
        best = max(found, key=lambda v: (v[1], v[2]), default=(None,) * 4)
        out.append((key, day, fact, best[1], best[3]))
    return out


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_as_of_takes_the_version_of_the_day(spark, partitions):
    draw = random.Random(11)
    start = date(2020, 1, 1)

    def day():
        return None if draw.random() < 0.03 else start + timedelta(draw.randrange(90))

    # One key owns half of all rows, and one has no version.
    keys = ["hot"] * 8 + ["a", "b", "c", "d", None, "never", "hot2", "e"]
    facts = [(draw.choice(keys), day(), n) for n in range(700)]
    versions = [(draw.choice([k for k in keys if k != "never"]), day(), n, draw.choice([None, "x", "y"])) for n in range(200)]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = ordered.as_of(
            spark.createDataFrame(facts, "k string, day date, fact int"),
            spark.createDataFrame(versions, "k string, since date, version int, tier string"), "k", "day", "since", ["since", "tier"], ["version"]
        )
        assert found.columns == ["k", "day", "fact", "since", "tier"]
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute_as_of(facts, versions)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def brute_history(events):
    out = []
    for key in {e[0] for e in events}:
        days = {}
        for _, day, version, state in sorted((e for e in events if e[0] == key and e[1]), key=lambda e: e[2]):
            days[day] = state
        rows = []
        for day, state in sorted(days.items()):
            if not rows or rows[-1][1] != state:
                rows.append((day, state))
        for (day, state), following in zip(rows, [*rows[1:], None]):
            out.append((key, day, state, following[0] - timedelta(1) if following else None, following is None))
    return out


@pytest.mark.parametrize("partitions", ["1", "9"])
def test_history_is_the_same_in_any_order_of_arrival(spark, partitions):
    draw = random.Random(5)
    start = date(2021, 5, 1)
    keys = ["hot"] * 6 + ["a", "b", None, "c"]
    events = [(draw.choice(keys), start + timedelta(draw.randrange(60)), n, draw.choice([None, "x", "y"])) for n in range(400)]
    events.append(("a", None, 999, "x"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for part in (events[:150], events, list(reversed(events)), events + events[:50]):
            df = spark.createDataFrame(part, "k string, day date, version int, state string")
            found = ordered.history(df, "k", "day", ["state"], ["version"])
            assert found.columns == ["k", "day", "state", "valid_to", "is_current"]
            assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute_history(part)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_exact_quantiles_of_nothing(spark):
    assert aggregates.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "x string, y int")
    found = {r.column_name: r for r in aggregates.column_profile(df).collect()}
    assert (found["x"].missing_values, found["x"].percent_missing, found["x"].unique_values) == (1, 25.0, 2)
    assert (found["y"].missing_values, found["y"].unique_values, found["y"].duplicate_rows) == (1, 2, 1)


def test_column_profile_of_long_texts(spark):
    df = spark.createDataFrame([("x" * 500,), ("x" * 500,), ("x" * 499 + "y",)], "x string")
    found = aggregates.column_profile(df).first()
    assert (found.unique_values, found.duplicate_rows) == (2, 1)


def test_precision_recall_without_hits(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "f int, a int")
    row = aggregates.precision_recall(df, F.col("f") == 1, F.col("a") == 1).first()
    assert (row.precision, row.recall) == (0.0, 0.0)


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert rows(aggregates.duplicate_values(df, "x")) == [(1, 2)]
    assert rows(aggregates.duplicate_id_check(df, "x")) == [(3, 2, 1)]


# --- dimensions ----------------------------------------------------------------------------

HISTORY = "sk bigint, id string, name string, city string, effective_date date, expiration_date date, is_current boolean"


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [
            (1, "a", "Ann", "X", date(2020, 1, 1), date(2021, 1, 1), False),
            (2, "a", "Ann", "Y", date(2021, 1, 1), None, True),
            (3, "b", "Bob", None, date(2020, 1, 1), None, True),
            (9, "c", "Cid", "Z", date(2020, 1, 1), None, True),
        ],
        HISTORY,
    )


STAGED = [("a", "Ann", "Y"), ("b", "Bob", "W"), ("c", "Cid", None), ("d", "Dee", "V")]


def test_scd2(spark, history):
    staged = spark.createDataFrame(STAGED, "id string, name string, city string")
    detected = {r.id: r.change_type for r in dimensions.scd2_detect(history, staged, "id", "sk", ["name", "city"]).collect()}
    assert detected == {"a": "UNCHANGED", "b": "CHANGED", "c": "CHANGED", "d": "NEW"}
    day = date(2024, 1, 1)
    after = dimensions.scd2_apply(history, staged, "id", "sk", ["name", "city"], day)
    found = {r.sk: r for r in after.collect()}
    assert len(found) == 7 and sorted(found) == [1, 2, 3, 9, 10, 11, 12]
    assert found[3].expiration_date == day and not found[3].is_current
    assert found[2].is_current and found[2].expiration_date is None
    assert found[1].expiration_date == date(2021, 1, 1)
    current = after.where("is_current").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in current} == {"a": 1, "b": 1, "c": 1, "d": 1}
    again = dimensions.scd2_apply(after, staged, "id", "sk", ["name", "city"], day)
    assert rows(again) == rows(after)


def test_scd2_into_an_empty_dimension(spark):
    empty = spark.createDataFrame([], HISTORY)
    staged = spark.createDataFrame(STAGED, "id string, name string, city string")
    after = dimensions.scd2_apply(empty, staged, "id", "sk", ["name", "city"], date(2024, 1, 1))
    assert sorted(r.sk for r in after.collect()) == [1, 2, 3, 4]


def test_scd1(spark):
    known = spark.createDataFrame([(5, "a", "old"), (6, "b", "old")], "sk bigint, id string, v string")
    incoming = spark.createDataFrame([("b", "new"), ("c", "new")], "id string, v string")
    after = dimensions.scd1_upsert(known, incoming, "id", "sk")
    assert rows(after) == [(5, "a", "old"), (6, "b", "new"), (7, "c", "new")]
    assert rows(dimensions.scd1_upsert(after, incoming, "id", "sk")) == rows(after)


def test_insert_only(spark):
    known = spark.createDataFrame([(1, "a", "A")], "sk bigint, id string, v string")
    incoming = spark.createDataFrame([("a", "other"), ("b", "B2"), ("b", "B1")], "id string, v string")
    assert rows(dimensions.insert_only(known, incoming, "id", "sk", ["v"])) == [(2, "b", "B1")]


def test_date_dimension(spark):
    days = dimensions.build_date_dimension(spark, date(2020, 1, 1), date(2025, 12, 31))
    assert days.count() == 2192
    leap = days.where("date_key = 20240229").first()
    assert (leap.day_name, leap.month_name, leap.quarter_number, leap.is_weekend) == ("Thursday", "February", 1, False)
    sunday = days.where("date_key = 20231231").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.is_business_day, sunday.week_of_year) == (6, True, False, 52)
    year = dimensions.build_date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31))
    assert year.count() == 366


def test_needed_and_missing_dates(spark):
    df = spark.createDataFrame([(20240101, 0), (20240102, 20240101), (0, None)], "a int, b int")
    needed = dimensions.needed_date_keys(df, ["a", "b"])
    assert rows(needed) == [(20240101,), (20240102,)]
    days = dimensions.build_date_dimension(spark, date(2024, 1, 1), date(2024, 1, 1))
    assert rows(dimensions.missing_date_keys(needed, days)) == [(20240102,)]


def test_flag_members_and_period(spark):
    df = spark.createDataFrame([(1, None), (2, 0)], "id int, flag int")
    members = spark.createDataFrame([(1,)], "id int")
    assert rows(dimensions.flag_members(df, members, "id", {"flag": F.lit(1)})) == [(1, 1), (2, 0)]
    assert rows(dimensions.without_period(df, F.col("flag") == 0)) == [(1, None)]


# --- facts ---------------------------------------------------------------------------------


def test_fact_load_conserves_rows_and_repeats_cleanly(spark):
    incoming = spark.createDataFrame(
        [("f1", "a", 5), ("f1", "a", 3), ("f2", "x", 1), ("f3", "b", -1), ("f4", "b", 2), ("f4", "x", 1), ("f5", "a", 9)],
        "fid string, id string, amount int",
    )
    dimension = spark.createDataFrame([("a", 1), ("b", 2)], "id string, sk bigint")
    loaded = spark.createDataFrame([("f5",), ("f5",)], "fid string")
    valid = [(F.col("amount") > 0, "invalid amount")]
    load = facts.load_facts(incoming, "fid", {"id": (dimension, "sk")}, valid, ["amount"], loaded)
    assert rows(load.facts.select("fid", "sk", "amount")) == [("f1", 1, 3), ("f4", 2, 2)]
    assert rows(load.rejects) == [
        ("f1", "duplicate", 1), ("f2", "unknown id", 1), ("f3", "invalid amount", 1), ("f4", "unknown id", 1), ("f5", "duplicate", 1),
    ]
    counters = load.counters.first()
    assert tuple(counters) == (7, 2, 3, 2)
    assert counters.total_processed == counters.successfully_loaded + counters.failed_validation + counters.duplicate_facts
    rate = facts.load_success_rate(load.counters).first()
    assert (rate.success_rate, rate.load_status) == (28.6, "LOW SUCCESS RATE")
    again = facts.load_facts(incoming, "fid", {"id": (dimension, "sk")}, valid, ["amount"], load.facts.select("fid").unionByName(loaded))
    assert again.facts.count() == 0


def test_fact_load_of_nothing(spark):
    incoming = spark.createDataFrame([], "fid string, id string, amount int")
    dimension = spark.createDataFrame([("a", 1)], "id string, sk bigint")
    load = facts.load_facts(incoming, "fid", {"id": (dimension, "sk")}, [], ["amount"])
    assert tuple(load.counters.first()) == (0, 0, 0, 0)
    assert facts.load_success_rate(load.counters).first().load_status == "NOTHING LOADED"


# --- cleaning ------------------------------------------------------------------------------


def test_handle_missing(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y"), (2, "")], "a int, b string")
    assert rows(cleaning.handle_missing(df, "drop")) == [(1, "x")]
    assert rows(cleaning.handle_missing(df, "fill", 0).select("a")) == [(0,), (1,), (2,)]
    assert cleaning.handle_missing(df, "unknown").count() == 3


def test_remove_duplicates_and_columns(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "a int, b string")
    assert rows(cleaning.remove_duplicates(df, ["a"], ["b"])) == [(1, "a"), (2, "c")]
    assert cleaning.keep_expected_columns(df, ["b", "zzz", "a"]).columns == ["a", "b"]
    added = cleaning.add_constant_column(df, "discount", 0, "decimal(10,2)")
    assert {r.discount for r in added.collect()} == {Decimal("0.00")}
    assert cleaning.append_sources(df, df.select("a")).count() == 6



def test_helper_fraction(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, None)], "p double, w double")
    assert [r.f for r in df.select(facts.safe_fraction(F.col("p"), F.col("w")).alias("f")).collect()] == [0.25, 0.0, 0.0]


def test_distinct_counts_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5), ("a", 2, 6), (None, 3, None)], "k string, x int, y int")
    found = aggregates.distinct_counts(df, "k", {"xs": "x", "ys": "y"})
    assert rows(found.select("k", "xs", "ys")) == [("a", 2, 2), (None, 1, 0)]
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_digests_tell_a_text_from_its_digest(spark):
    import hashlib

    long = "x" * 65
    df = spark.createDataFrame([(long,), (hashlib.sha256(long.encode()).hexdigest(),), (long,), (None,), (None,)], "v string")
    assert aggregates.column_profile(df).first().unique_values == 2
    assert {tuple(r) for r in aggregates.duplicate_values(df, "v").collect()} == {(None, 2), (long, 2)}


# --- mergeable distinct counts -----------------------------------------------------------------


def test_rolled_up_states_equal_states_of_all_rows(spark, tmp_path):
    from ledgerloom.operators import distinct
    from ledgerloom.sources.writers import replace_period

    rows_of = lambda low, high, day: spark.range(low, high).select(
        F.lit(day).alias("day"), F.when(F.col("id") % 3 == 0, "hot").otherwise("rare").alias("k"), (F.col("id") % 7000).alias("user"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).otherwise("").alias("text"),
    )
    columns = {"users": "user", "texts": "text"}
    store = str(tmp_path / "states")
    days = [rows_of(0, 9000, 1), rows_of(6000, 20000, 2)]
    for day in [*days, rows_of(0, 10, 3), rows_of(20000, 21000, 3)]:  # the third day is loaded again
        replace_period(distinct.distinct_states(day, ["day", "k"], columns), store, ["day"])
    stored = spark.read.parquet(store)
    whole = days[0].unionByName(days[1]).unionByName(rows_of(20000, 21000, 3))
    rolled = distinct.roll_up(stored, ["k"], list(columns))
    assert "states" in rolled.inputFiles()[0] and all("states" in f for f in rolled.inputFiles())
    report = distinct.error_report(whole, rolled, "k", columns).collect()
    assert len(report) == 4 and all(r.within_error for r in report), report
    assert {(r.k, r.measure): r.exact_count for r in report}[("hot", "users")] == 7000
    assert sum(r[distinct.ROWS] for r in rolled.collect()) == whole.count()


def test_states_of_nulls_and_nothing(spark):
    from ledgerloom.operators import distinct

    df = spark.createDataFrame([("a", None, 1.5), ("a", "", 1.5), ("a", "x", None), (None, None, None)], "k string, t string, d double")
    states = distinct.distinct_states(df, ["k"], {"texts": "t", "sizes": "d"})
    found = rows(distinct.with_estimates(states, ["texts", "sizes"]).select("k", "row_count", "texts", "sizes"))
    assert sorted(found, key=str) == sorted([("a", 3, 2, 1), (None, 1, 0, 0)], key=str)
    report = distinct.error_report(df, states, "k", {"texts": "t", "sizes": "d"})
    assert report.where("within_error").count() == 4
    assert distinct.distinct_states(df.limit(0), ["k"], {"texts": "t"}).count() == 0


def test_sketched_profile_equals_the_exact_one(spark):
    from ledgerloom.operators import distinct

    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("", 2), (None, None)], "t string, n int")
    shown = ["column_name", "missing_values", "percent_missing", "unique_values", "duplicate_rows"]
    assert rows(distinct.sketched_profile(df).select(shown)) == rows(aggregates.column_profile(df).select(shown))
    assert rows(distinct.sketched_profile(df.limit(0)).select("column_name", "row_count", "unique_values")) == [("n", 0, 0), ("t", 0, 0)]
    big = spark.range(50_000).select(F.col("id"), (F.col("id") % 900).alias("m"), F.md5(F.col("id").cast("string")).alias("x"))
    plan = distinct.sketched_profile(big)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan
    off = {r.column_name: r.unique_values for r in distinct.sketched_profile(big).collect()}
    for name, exact in (("id", 50_000), ("m", 900), ("x", 50_000)):
        assert abs(off[name] - exact) <= distinct.stated_error() * exact

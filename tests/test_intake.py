"""Filters of loaded keys, and intakes that set rows aside."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import facts, membership
from ledgerloom.sources import intake


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- filters -------------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 7, 3000])
def test_filter_misses_no_key(spark, buckets):
    """Broadcast and joined filters alike; NULL is no key."""
    keys = spark.createDataFrame([(f"k{i % 3000}",) for i in range(4000)] + [(None,), ("",)], "k string")
    members = membership.key_filter(keys, "k", buckets)
    assert members.rows.count() <= buckets
    assert membership.candidates(keys, "k", members).count() == 4001
    assert membership.candidates(keys.where("k is null"), "k", members).count() == 0
    assert membership.candidates(keys, "k", membership.key_filter(keys.limit(0), "k", buckets)).count() == 0


def test_false_positives_stay_near_the_stated_rate(spark):
    keys, buckets = 20_000, membership.buckets_for(20_000)
    members = membership.key_filter(spark.range(keys).withColumnRenamed("id", "k"), "k", buckets)
    others = spark.range(keys, keys + 200_000).withColumnRenamed("id", "k")
    found = membership.candidates(others, "k", members).count() / 200_000
    stated = membership.false_positive_rate(keys, buckets)
    assert stated < 0.01 and stated / 2 < found < stated * 2


def test_filters_unite_and_are_kept(spark, tmp_path):
    numbers = spark.range(2000).withColumnRenamed("id", "k")
    parts = [membership.key_filter(numbers.where(F.col("k") % 3 == part), "k", 5) for part in range(3)]
    both = parts[0].united(parts[1]).united(parts[2])
    whole = membership.key_filter(numbers, "k", 5)
    assert rows(both.rows) == rows(whole.rows)
    both.save(str(tmp_path / "f"))
    assert rows(membership.read_filter(spark, str(tmp_path / "f"), 5).rows) == rows(whole.rows)
    with pytest.raises(ValueError):
        membership.read_filter(spark, str(tmp_path / "f"), 6)
    with pytest.raises(ValueError):
        both.united(membership.key_filter(numbers, "k", 6))


def test_only_candidates_are_shuffled(spark, tmp_path):
    """Of 50,000 loaded keys few reach the exchange below the exact join."""
    spark.range(50_000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "loaded"))
    loaded = spark.read.parquet(str(tmp_path / "loaded"))
    members = membership.key_filter(loaded, "k", membership.buckets_for(50_000))
    incoming = spark.range(49_990, 60_000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = membership.keys_in_both(incoming, loaded, "k", members)
        assert rows(found) == [(i,) for i in range(49_990, 50_000)]
        plan = found._jdf.queryExecution().executedPlan()
        text = plan.toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The loaded keys meet the broadcast filter of the candidates before any exchange by key.
    scan = text[: text.index("/loaded")]
    assert scan.rindex("BroadcastHashJoin") > scan.rindex("hashpartitioning(k")
    maybe = membership.candidates(incoming, "k", members).count()
    assert maybe < 10 + 10_000 * 0.03
    assert membership.candidates(loaded, "k", membership.key_filter(membership.candidates(incoming, "k", members), "k", 1)).count() < 2 * maybe


def test_load_with_a_filter_equals_the_load_without(spark):
    incoming = spark.createDataFrame([(i % 900, i % 50, i % 7 - 1) for i in range(1200)] + [(None, 1, 1)], "fid int, id int, amount int")
    dimension = spark.range(45).select(F.col("id").cast("int"), (F.col("id") + 100).alias("sk"))
    loaded = spark.range(300, 2000).select(F.col("id").cast("int").alias("fid"))
    valid = [(F.col("amount") >= 0, "invalid amount")]
    members = membership.key_filter(loaded, "fid", 2)
    plain = facts.load_facts(incoming, "fid", {"id": (dimension, "sk")}, valid, ["amount", "id"], loaded)
    filtered = facts.load_facts(incoming, "fid", {"id": (dimension, "sk")}, valid, ["amount", "id"], loaded, members)
    for part in ("facts", "rejects", "counters"):
        assert rows(getattr(plain, part)) == rows(getattr(filtered, part).select(getattr(plain, part).columns))


# --- intakes -------------------------------------------------------------------------------

FIELDS = "id string, amount double, day date"


def test_csv_rows_are_kept_or_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,amount,day\n A1 ,2.5,2024-01-02\n ,1,2024-01-02\nA2,x,2024-13-40\n")
    (tmp_path / "in" / "b.csv").write_text("id,amount,day\nA3,1,2024-01-03,too,many\nA4\nA1,2,2024-01-02\n,9,\n")
    rejects = [(F.col("day").isNull(), "no day")]
    taken = intake.take_in_csv(spark, str(tmp_path / "in"), FIELDS, "id", str(tmp_path / "out"), lower=["id"], rejects=rejects)
    assert [(r.id, r.amount, str(r.day)) for r in taken.kept.orderBy("amount").collect()] == [("a1", 2.0, "2024-01-02"), ("a1", 2.5, "2024-01-02")]
    aside = {(r.reject_reason, (r.id or "").strip(), r.amount) for r in taken.quarantined.collect()}
    assert aside == {("missing key", "", "1"), ("missing key", "", "9"), ("no day", "A2", "x"), ("broken line", "A3", "1"), ("broken line", "A4", None)}
    assert [r.line for r in taken.quarantined.where("id = 'A3'").collect()] == ["A3,1,2024-01-03,too,many"]
    assert (taken.rows_read, taken.rows_kept, taken.rows_quarantined) == (7, 2, 5)


def test_json_array_and_empty_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([{"id": " A1", "amount": "3"}, {"amount": 4}]))
    (tmp_path / "in" / "b.json").write_text("{ not json")
    taken = intake.take_in_json_array(spark, str(tmp_path / "in"), "id string, amount double", "id", str(tmp_path / "out"))
    assert rows(taken.kept) == [("A1", 3.0)]
    assert sorted(r.reject_reason for r in taken.quarantined.collect()) == ["broken line", "missing key"]
    assert (taken.rows_read, taken.rows_kept, taken.rows_quarantined) == (3, 1, 2)
    (tmp_path / "none.csv").write_text("id,amount,day\n")
    none = intake.take_in_csv(spark, str(tmp_path / "none.csv"), FIELDS, "id", str(tmp_path / "none"))
    assert (none.rows_read, none.rows_kept, none.rows_quarantined, none.kept.count(), none.quarantined.count()) == (0, 0, 0, 0, 0)
    assert none.kept.columns == ["id", "amount", "day"]


def test_the_source_is_read_once(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,amount,day\nA1,2,2024-01-02\n,1,\n")
    raw = spark.read.schema("id string, amount string, day string").csv(str(tmp_path / "c.csv"), header=True)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    taken = intake.take_in(raw.mapInArrow(counted, raw.schema), FIELDS, "id", str(tmp_path / "out"))
    assert (taken.kept.count(), taken.quarantined.count(), taken.rows_read, reads.value) == (1, 1, 2, 2)
    assert not re.search("MapInArrow", taken.kept._jdf.queryExecution().executedPlan().toString())

"""Extra columns with the names that operators use for their own work change nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm import mixing, sharding, url_filter

WORKING = ("_right_source", "_rightsource", "_right_row_id", "_right_each", "_right__slice", "_right_text_md5", "_digest", "_part", "_Inside", "_carried", "_size", "_slice")


def clashing(df, names):
    return df.withColumns({name: F.lit("own") for name in names})


def test_sharding_and_mixing_keep_them(frame):
    rows = frame([(i, "some words " * (i % 7), f"s{i % 3}") for i in range(60)] + [(None, None, None), (3, "x", None)])
    wide = clashing(rows, WORKING)
    plain, found = (sharding.interleaved(df, "doc_id", "source", 4, ties=("text",)) for df in (rows, wide))
    key = ["doc_id", "source", "shard", "slot"]
    assert sorted(map(str, plain.select(key).collect())) == sorted(map(str, found.select(key).collect()))
    assert found.columns == [*wide.columns, "shard", "slot"] and found.select(*WORKING).distinct().count() == 1
    plain, found = (mixing.mix_rows(df, "doc_id", "source", "text") for df in (rows, wide))
    assert found.columns == wide.columns and sorted(map(str, plain.collect())) == sorted(map(str, found.select(rows.columns).collect()))


def test_url_filter_keeps_them(spark):
    rows = [(i, f"https://{host}/a/{i}", f"<p>{text}</p>") for i, (host, text) in enumerate([("freebets.net", "free bets gr\u00f6\u00dfe"), ("garden.org", "quiet garden")] * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    wide = clashing(pages, ("_right_host", "_right_shape", "_right_score", "_right_tokens", "_shape"))
    plain, found = (url_filter.judged(df, "url", "html") for df in (pages, wide))
    key = ["page_id", "host", "path", "rule", "verdict", "tokens"]
    assert sorted(map(str, plain.select(key).collect())) == sorted(map(str, found.select(key).collect()))
    assert {r["_right_host"] for r in found.collect()} == {"own"}


def test_words_are_whole_runs_of_letters(spark):
    long = "x" * (url_filter.LONGEST_WORD + 1)
    pages = spark.createDataFrame([(f"<p>Gr\u00f6\u00dfe gr\u00f6\u00dfe f\u00fcr a2b {long} on_off</p>",), (None,)], "html string")
    found = {r.word: r.n for r in url_filter.word_counts(pages, "html").collect()}
    assert found == {"gr\u00f6\u00dfe": 2, "f\u00fcr": 1, "on": 1, "off": 1}

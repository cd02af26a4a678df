"""URL filter: rules, word segmentation of hosts, and naive Bayes over the words.

Hosts glue words together (``freebets``). A unigram model - counts of the words in all pages' text, and
the seed words below - splits each host label by a Viterbi search: the split with the highest product of
word probabilities wins. Multinomial naive Bayes then scores a url by the words of its host and path.

No page is labelled, so the Bayes model learns from seeds: a url whose words hold a seed word counts as an
example to block, any other as one to allow. Counts cover all pages. Each host counts once per word, in the share of its
urls with the word that are to block, so no host with many pages outvotes the others; and a host's own urls never vote on
its own words: it is judged by what other hosts show, and by the seeds, each of which counts as ``SEED_HOSTS`` hosts to
block. So a host without a seed word is blocked when its words stand on blocked hosts elsewhere, and a word that no other
host has says nothing. Without an example to block, nothing is blocked by the method.

Everything the model knows stays in tables and meets the urls in joins: nothing that grows with the corpus
is broadcast or collected. Hosts and paths are segmented once per distinct value, digits count as one
word, and pages of one host share its score.

NULL urls and urls without ``://`` have an empty host and path, and are judged by no words: the method
allows them. Rows may repeat; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded, free_name, read

# Fixed values: (rule, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Words that mark a url as an example to block.
SEEDS = (
    "ads", "adult", "bet", "bets", "betting", "bingo", "casino", "cheap", "dating", "escort", "farm", "gambling", "jackpot", "loan",
    "lottery", "nude", "payday", "pharmacy", "pills", "poker", "porn", "sex", "slots", "spam", "torrent", "track", "viagra", "warez", "xxx",
)
#: A seed word counts as often as one word in so many.
SEED_SHARE = 10_000
LONGEST_WORD = 20
#: A seed word counts as it would had it stood on so many hosts to block, besides the hosts that do have it.
SEED_HOSTS = 1_000
#: Hosts added to each word's count in the Bayes model, shared out as the classes share all words. Without other
#: evidence, a word that blocks a host must stand on that many more hosts to block than hosts to allow.
SMOOTHING = 5.0
#: A url is blocked when that is so many times as likely as the contrary: words that go together (a host's name and its
#: usual paths) each count in full, and a blocked clean host costs more than a missed one.
BLOCK_ODDS = 2.0
NUMBER = "0"

_HOST = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_MARKUP = re.compile(r"<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[a-z]+;", re.S | re.I)
_WORD = re.compile(r"[^\W\d_]+")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    value = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(value, _HOST, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(value, _HOST, 2)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or NULL."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def word_counts(pages: DataFrame, html: str) -> DataFrame:
    """Words of all pages' text with their counts; each batch is counted before it is sent on.

    A word is a whole run of letters, of any script. Single letters and words over ``LONGEST_WORD`` letters are left out, not cut.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for page in batch.column(0).to_pylist():
                words = _WORD.findall(_MARKUP.sub(" ", page or "").lower())
                counts.update(w for w in words if 2 <= len(w) <= LONGEST_WORD)
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    return pages.select(html).mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def with_seeds(words: DataFrame, seeds=SEEDS) -> DataFrame:
    """The unigram model, ``word`` and ``n``: a seed counts at least as often as one word in ``SEED_SHARE``."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).scalar()
    extra = words.sparkSession.createDataFrame([(s,) for s in seeds], "word string")
    extra = extra.select("word", F.greatest(F.ceil(total / SEED_SHARE), F.lit(1)).cast("long").alias("n"))
    return words.unionByName(extra).groupBy("word").agg(F.max("n").alias("n"))


def label_splits(labels: DataFrame, words: DataFrame) -> DataFrame:
    """``label`` and its ``words``: the best split by the unigram model.

    ``labels`` has distinct labels. All their parts up to ``LONGEST_WORD`` letters meet the model in a join; a label is
    at most as long as a url allows, so its parts found are gathered per label.
    """
    starts = F.sequence(F.lit(1), F.length("label"))
    places = labels.where(F.length("label") > 0).select("label", F.explode(starts).alias("start"))
    places = places.select("label", "start", F.substr("label", F.col("start"), F.lit(LONGEST_WORD)).alias("ahead"))
    sized = places.select("label", "start", "ahead", F.explode(F.sequence(F.lit(1), F.length("ahead"))).alias("size"))
    parts = sized.select("label", "start", "size", F.substr("ahead", F.lit(1), F.col("size")).alias("word"))
    found = parts.join(words, "word").groupBy("label").agg(F.collect_list(F.struct("start", "size", "n")).alias("found"))
    total = words.agg(F.sum("n").cast("double").alias("total")).scalar()

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series, lists: pd.Series, totals: pd.Series) -> pd.Series:
        return pd.Series([best_split(t, f if f is not None else [], n) for t, f, n in zip(texts, lists, totals, strict=True)])

    return labels.join(found, "label", "left").select("label", split("label", "found", F.coalesce(total, F.lit(1.0))).alias("words"))


def best_split(label: str, found, total: float) -> list[str]:
    """Viterbi: ``found`` has (start from 1, size, count) of the known words in the label.

    A part that is no known word counts ``10 / (total * 10 ** size)``, so unknown stretches stay whole; the best
    unknown stretch up to a letter goes on from the one before or starts anew, so long labels take linear time. Of equal
    splits the one with the longest last word wins.
    """
    ending: dict[int, list[tuple[int, int]]] = {}
    for f in found:
        ending.setdefault(f["start"] - 1 + f["size"], []).append((f["start"] - 1, f["n"]))
    best, begin = [0.0], [0]
    unknown, letter = math.log(10 / total), math.log(10)
    stretch = (-math.inf, 0)  # score and minus the start of the best unknown stretch
    for end in range(1, len(label) + 1):
        stretch = max((stretch[0] - letter, stretch[1]), (best[end - 1] + unknown - letter, 1 - end))
        top = max([stretch, *((best[start] + math.log(count / total), -start) for start, count in ending.get(end, ()))])
        best.append(top[0])
        begin.append(-top[1])
    words, end = [], len(label)
    while end:
        words.append(label[begin[end] : end])
        end = begin[end]
    return words[::-1]


def path_words(path: Column) -> Column:
    """Words of a path; each run of digits is the one word ``NUMBER``."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(path), "[0-9]+", f"/{NUMBER}/"), F.lit(r"[\p{L}0]+"), F.lit(0))


def site_scores(urls: DataFrame, words: DataFrame, seeds=SEEDS) -> DataFrame:
    """Per distinct ``host`` and ``shape`` (the path's words): ``score``, the log odds of block, and its ``tokens``.

    ``urls`` has ``host`` and ``shape`` of every url.
    """
    sites = urls.groupBy("host", "shape").agg(F.count("*").alias("urls"))
    labels = sites.select("host").distinct().select("host", F.posexplode(F.split("host", r"[^\p{L}0-9]+")).alias("at", "raw"))
    labels = labels.select("host", "at", F.regexp_replace("raw", "[0-9]+", "").alias("label"))
    splits = label_splits(labels.select("label").distinct(), words)
    named = labels.join(splits, "label").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
    named = named.select("host", F.flatten("parts.words").alias("host_words"))
    joined = sites.join(named, "host", "left").withColumn(
        "tokens", F.concat(F.coalesce("host_words", F.array().cast("array<string>")), F.filter(F.split("shape", " "), lambda w: w != ""))
    )
    marked = joined.withColumn("bad", F.arrays_overlap("tokens", F.array(*map(F.lit, seeds)))).drop("host_words")
    sites = stage_table(marked, "url-sites")

    share = F.sum(F.when(F.col("bad"), F.col("urls")).otherwise(0)) / F.sum("urls")
    places = sites.select("host", "shape", F.explode("tokens").alias("token"), "bad", "urls")
    own = places.groupBy("host", "token").agg(share.alias("own_b")).withColumn("own_a", 1 - F.col("own_b"))
    own = stage_table(own, "url-words")
    both_sums = (F.sum("own_b").alias("b"), F.sum("own_a").alias("a"))
    totals = own.agg(*both_sums).collect()[0]  # one row
    hosts = sites.groupBy("host").agg(share.alias("own_b")).withColumn("own_a", 1 - F.col("own_b"))
    classes = hosts.agg(*both_sums).collect()[0]
    if not totals.b:
        return sites.select("host", "shape", F.lit(float("-inf")).alias("score"), "tokens")
    prior = math.log(classes.b) - math.log(classes.a or 0.5)
    block, allow = totals.b / (totals.a + totals.b), (totals.a or 0.5) / (totals.a + totals.b)

    counts = own.groupBy("token").agg(*both_sums)
    seeded = F.when(F.col("token").isin(*seeds), SEED_HOSTS).otherwise(0)
    for_block = F.col("b") - F.col("own_b") + seeded + SMOOTHING * block
    for_allow = F.col("a") - F.col("own_a") + SMOOTHING * allow
    odds = F.log(for_block / for_allow) - math.log(block / allow)
    odds = own.join(counts, "token").select("host", "token", odds.alias("odds"))
    summed = places.select("host", "shape", "token").join(odds, ["host", "token"]).groupBy("host", "shape").agg(F.sum("odds").alias("sum"))
    both = sites.select("host", "shape", "tokens").join(summed, ["host", "shape"], "left")
    return both.select("host", "shape", F.round(F.coalesce("sum", F.lit(0.0)) + prior, 9).alias("score"), "tokens")


def judged(df: DataFrame, url: str, html: str, rules=RULES, seeds=SEEDS) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``score`` and ``tokens`` (replaced where they exist)."""
    host, path = url_parts(F.col(url))
    df = bounded(df)
    shape = free_name(df, "_shape")
    parted = df.withColumns({"host": host, "path": path}).withColumn(shape, F.concat_ws(" ", path_words(F.col("path"))))
    words = stage_table(with_seeds(stage_table(word_counts(df, html), "page-words"), seeds), "url-unigrams")
    scores = site_scores(parted.select("host", F.col(shape).alias("shape")), words, seeds)
    right = {c: free_name(parted, f"_right_{c}") for c in scores.columns}
    scores = scores.withColumnsRenamed(right)
    # Every url finds its row, as the scores come from the urls themselves.
    joined = parted.join(scores, (F.col("host") == F.col(right["host"])) & (F.col(shape) == F.col(right["shape"])))
    match = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when((F.col("score") > math.log(BLOCK_ODDS)) & (F.col("host") != ""), "block").otherwise("allow")
    joined = joined.withColumns({"score": F.col(right["score"]), "tokens": F.col(right["tokens"]), "rule": match["rule"]})
    joined = joined.withColumn("verdict", F.coalesce(match["verdict"], method))
    return joined.drop(shape, *right.values())


def op1_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judged(pages, "url", "html").select("page_id", "host", "path", "rule", "verdict", "tokens", F.round("score", 6).alias("score"))

"""Maximal periodic runs of words, by maximal pairs in the LCP-interval tree.

A run is a stretch of words whose smallest period ``q`` fits at least ``REPEATS`` times and that no neighbouring word extends. With
``l = length - q`` its start ``i`` and ``j = i + q`` are a *maximal pair*: the words from ``i`` and from ``j`` agree for exactly ``l``
words, and the words before them differ. As ``l >= (REPEATS - 1) q``, the distance of the pair says whether it is a run, and a pair that
meets the limits needs no extension to either side.

1. The texts of a batch become numbers, equal only for equal words of one text. Ranks of 1, 2, 4, ... words are refined for the
   places that still share theirs (most text drops out at once), which sorts the suffixes and gives neighbours' LCP.
2. The tree of LCP intervals is walked from the bottom up with a stack. An interval's list holds its places in text order, each
   with its class, the word to its left. Where two lists meet, the smaller goes into the larger.
3. A pair is read off where a place gets a neighbour of another class in the united list. Only neighbours count: all places
   of an interval within ``l / (REPEATS - 1)`` words of each other are in arithmetic progression, and all but the first have the same
   class. A pair farther apart in the progression would be the same stretch with a multiple of its period. So each run comes once.

Work is ``n log n`` for ``n`` words of a batch; a batch is bounded in rows and bytes, and one text is never split. NULL, empty and
short texts have no runs. Rows are judged alone: ties, repeated rows and ids don't matter, extra columns stay, and the working
column takes a free name. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, free_name, read

#: A run holds its period so many times (twice or more), and so many words at least.
REPEATS = 4
LEAST_WORDS = 6
SPACE = r"[\x20\x09-\x0D]+"
_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def numbered_words(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number per word of all texts in a row, equal for equal words of one text only, and where each text ends."""
    known: dict[bytes, int] = {}
    flat = np.fromiter((known.setdefault(w, len(known)) for words in texts for w in words), np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.repeat(np.arange(len(texts)), sizes) * max(len(known), 1) + flat, np.cumsum(sizes)


def refined(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of pairs within their old rank ``first``, and which of them are shared still."""
    order = np.lexsort((second, first))
    f, s = first[order], second[order]
    old = np.r_[True, f[1:] != f[:-1]]
    new = old | np.r_[True, s[1:] != s[:-1]]
    places = np.arange(len(f))
    begin = np.maximum.accumulate(np.where(new, places, 0))
    rank = np.empty_like(first)
    rank[order] = f + begin - np.maximum.accumulate(np.where(old, places, 0))
    shared = np.empty(len(f), bool)
    shared[order] = ~(new & np.r_[new[1:], True])
    return rank, shared


def sorted_suffixes(words: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places by the suffix that starts there, and the LCP with the one before; without places whose next ``least`` words stand nowhere
    else in the text (or, where ``least`` is no power of two, some of them)."""
    n = len(words)
    none = np.empty(0, np.int64)
    if not n:
        return none, none
    stop = np.repeat(ends, np.diff(ends, prepend=0))
    rank, shared = refined(words - words.min(), np.zeros(n, np.int64))
    # refined() counts from the old rank on; here that is the word's number, so ranks are counted anew.
    order = np.argsort(words, kind="stable")
    begin = np.r_[True, words[order][1:] != words[order][:-1]]
    rank[order] = np.maximum.accumulate(np.where(begin, np.arange(n), 0))
    ranks, active, width, alive = [rank], np.flatnonzero(shared), 1, none
    while len(active):
        if width <= least:
            alive = active
        ahead = active + width
        second = np.where(ahead < stop[active], rank[np.minimum(ahead, n - 1)], -1)
        rank = rank.copy()
        rank[active], still = refined(rank[active], second)
        active = active[still]
        width *= 2
        if len(active):
            ranks.append(rank)
    if width <= least or not len(alive):
        return none, none
    places = alive[np.argsort(rank[alive])]
    a, b = places[:-1], places[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        left, right = a + lcp, b + lcp
        inside = (left < stop[a]) & (right < stop[b])
        same = ranks[k][np.minimum(left, n - 1)] == ranks[k][np.minimum(right, n - 1)]
        lcp += np.where(inside & same, 1 << k, 0)
    return places, np.r_[0, lcp]


def least_common(repeats: int, least: int) -> int:
    """Words that a pair must have in common to be a run at all: its distance is ``1 / (repeats - 1)`` of them at most."""
    return -(-least * (repeats - 1) // repeats)


def maximal_pairs(places: Sequence[int], lcp: Sequence[int], before: Sequence[int], repeats: int, least: int) -> list[tuple[int, int, int]]:
    """(i, j, l) of all maximal pairs that are runs. ``before``: the class (word to the left) by place."""
    found: list[tuple[int, int, int]] = []
    share = repeats - 1

    def note(i: int, j: int, common: int) -> None:
        if share * (j - i) <= common and j - i + common >= least and before[i] != before[j]:
            found.append((i, j, common))

    def united(one: list[int], other: list[int], common: int) -> list[int]:
        """Both lists in one; new neighbours are the pairs to look at."""
        if len(one) < len(other):
            one, other = other, one
        for place in other:
            at = bisect_left(one, place)
            one.insert(at, place)
        held = set(other)
        for place in other:
            at = bisect_left(one, place)
            if at and one[at - 1] not in held:
                note(one[at - 1], place, common)
            if at + 1 < len(one) and one[at + 1] not in held:
                note(place, one[at + 1], common)
        return one

    shallowest = least_common(repeats, least)
    stack: list[tuple[int, list[int]]] = []
    for k, place in enumerate(places):
        node = [place]
        common = lcp[k + 1] if k + 1 < len(places) else 0
        while stack and stack[-1][0] >= common:
            depth, held = stack.pop()
            node = united(held, node, depth)
        if common >= shallowest:
            stack.append((common, node))
    return found


def runs_of(texts: Sequence[list[bytes]], repeats: int = REPEATS, least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """For each text, given as its words, all runs as (start, length, period), by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    words, ends = numbered_words(texts)
    places, lcp = sorted_suffixes(words, ends, least_common(repeats, least))
    if not len(places):
        return out
    begins = np.r_[0, ends[:-1]]
    before = np.r_[-1, words[:-1]]
    before[begins[begins < len(words)]] = -1
    pairs = maximal_pairs(places.tolist(), lcp.tolist(), before.tolist(), repeats, least)
    if pairs:
        i, j, common = np.array(pairs, np.int64).T
        text = np.searchsorted(ends, i, side="right")
        for t, start, length, period in sorted(zip(text.tolist(), (i - begins[text]).tolist(), (j - i + common).tolist(), (j - i).tolist(), strict=True)):
            out[t].append((start, length, period))
    return out


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    start, length, period = np.array(runs, np.int64).T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [w for w, depth in zip(words, np.cumsum(change).tolist(), strict=False) if not depth]


def with_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", repeats: int = REPEATS, least: int = LEAST_WORDS) -> DataFrame:
    """``df`` with ``runs`` (start word, length, period; by start, then period) and ``collapsed``, the words outside repeats joined by a space.

    Columns of these names are replaced; others pass through the task as they are.
    """
    kept = [c for c in bounded(df).columns if c.lower() not in (runs.lower(), collapsed.lower())]
    given = free_name(df, "_text")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(0).to_pylist()]
            all_runs = runs_of(texts, repeats, least)
            flat = np.array([run for one in all_runs for run in one], np.int64).reshape(-1, 3)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, all_runs)]), pa.int32()), fields)
            left = [b" ".join(without_repeats(words, one)).decode("utf-8", "surrogatepass") for words, one in zip(texts, all_runs, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists, pa.array(left, pa.string())], [*kept, runs, collapsed])

    rows = df.select(F.col(text).alias(given), *kept)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField(runs, T.DataType.fromDDL(_RUN)), T.StructField(collapsed, T.StringType())])
    return rows.mapInArrow(found, schema)


def planted(text: Column, row_id: Column) -> Column:
    """The text of every tenth row (by the id's checksum) with its tail repeating a few words; other texts as they are."""
    h = F.crc32(row_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        return F.transform(w, lambda word, i: F.when(i < a, word).otherwise(w[(a + F.pmod(i - a, p)).cast("int")]))

    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(F.lit("")))[0]
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.isNotNull(), changed).otherwise(text)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period; of equal ones the first by start and period."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, none, better)


def op13_maximal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    found = with_runs(documents.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("words")), "words")
    found = found.withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

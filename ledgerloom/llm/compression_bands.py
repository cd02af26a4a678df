"""Quality rules: counts of words, symbols and repeats, and bands of zstandard ratios.

The ratio of a text is its UTF-8 bytes divided by its compressed bytes. Repetitive text has a high
ratio, random text one near 1. What is usual depends on the length, as a short text gives the
compressor little to work with, so each length class has its own band. Besides the whole text, its
chunks are judged, which finds long stretches of noise or repetition that the rest of a document would
hide. Chunks of one size follow each other from the start, and one more ends where the text ends, so every
byte lies in a judged chunk; shorter texts have smaller chunks with limits of their own. Texts below the smallest
chunk are one chunk already and have the whole text's band only. What counts is the share of the text's bytes in
chunks outside the band, each byte in the first chunk that holds it, so the last chunk weighs what it adds.
Noise much shorter than a chunk is judged together with the text beside it and may pass.

NULL and empty texts have no words and fail the base rules. The measures join the other columns as
one struct, so no input column can clash but the one that has the struct's own name, which is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, free_name, read

LEVEL = 3
#: Smallest byte length of a class, lowest and highest ratio kept. Texts below the first class are not judged.
WHOLE_BANDS = (
    (64, 0.60, 2.2),
    (256, 1.05, 2.4),
    (1024, 1.25, 2.5),
    (4096, 1.40, 2.7),
    (16384, 1.50, 2.95),
    (65536, 1.50, 3.5),
)
#: Bytes of a chunk, lowest and highest ratio of one. A text has chunks of the largest size that it fills.
CHUNK_BANDS = (
    (256, 1.12, 2.4),
    (1024, 1.35, 2.5),
    (4096, 1.35, 2.7),
)
#: Share of the bytes that may lie in chunks outside the band.
CHUNK_SHARE = 0.25
REPEAT_WORDS = 5

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, lowest_chunk_ratio double, highest_chunk_ratio double, odd_chunks long, chunks long, in_band boolean"
)


def repeated_words(words: Sequence[str], width: int = REPEAT_WORDS) -> int:
    """Words that lie in a window of ``width`` words which occurs more than once."""
    windows = list(zip(*(words[k:] for k in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0  # words before ``covered`` are counted
    for start, window in enumerate(windows):
        if counts[window] > 1:
            total += start + width - max(start, covered)
            covered = start + width
    return total


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


def band_of(length: int, bands: Sequence[tuple[int, float, float]]) -> tuple[float, float] | None:
    found = None
    for least, low, high in bands:
        if length >= least:
            found = (low, high)
    return found


def chunk_starts(length: int, chunk_bands: Sequence[tuple[int, float, float]]) -> tuple[list[int], int]:
    """Where the chunks of a text of ``length`` bytes start, and their size. The last one ends with the text."""
    size = max((least for least, _, _ in chunk_bands if least <= length), default=0)
    if not size:
        return [], 0
    starts = list(range(0, length - size + 1, size))
    return starts + [length - size] * (length % size > 0), size


def measure(text: str | None, compress, whole_bands=WHOLE_BANDS, chunk_bands=CHUNK_BANDS, chunk_share=CHUNK_SHARE) -> tuple:
    """The measures of one text; ``compress`` maps bytes to compressed bytes."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = _WORD.findall(text)
    ratio = len(raw) / len(compress(raw)) if raw else None
    starts, size = chunk_starts(len(raw), chunk_bands)
    chunks = [size / len(compress(raw[k : k + size])) for k in starts]
    low, high = band_of(len(raw), chunk_bands) or (0, 0)
    odd = [k for k, c in zip(starts, chunks, strict=True) if not low <= c <= high]
    odd_bytes = sum(len(raw) % size if k % size else size for k in odd)
    band = band_of(len(raw), whole_bands)
    in_band = (band is None or band[0] <= ratio <= band[1]) and odd_bytes <= chunk_share * len(raw)
    return (
        len(words),
        sum(map(len, words)),
        sum(raw.count(s) for s in _SYMBOLS),
        duplicate_lines(text),
        repeated_words(words),
        ratio,
        min(chunks, default=None),
        max(chunks, default=None),
        len(odd),
        len(chunks),
        in_band,
    )


def quality_measures(text: Column, **limits) -> Column:
    """A struct of ``MEASURES`` for a text column; ``limits`` as in ``measure``."""
    names = [part.split()[0] for part in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        return pd.DataFrame([measure(t, compress, **limits) for t in texts], columns=names)

    return measured(text)


def base_failed(measures: str) -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    words, repeats = F.col(f"{measures}.n_words"), F.col(f"{measures}.n_repeat_words")
    return (words < 10) | (100 * repeats > 20 * words)


def with_quality(df: DataFrame, text: str = "text", name: str = "quality", **limits) -> DataFrame:
    """Add the struct ``name``: the measures, ``base_failed`` and ``kept``."""
    measured = bounded(df).withColumn(name, quality_measures(F.col(text), **limits))
    failed = base_failed(name)
    verdict = F.struct(f"{name}.*", failed.alias("base_failed"), (~failed & F.col(f"{name}.in_band")).alias("kept"))
    return measured.withColumn(name, verdict)


def keep_quality(df: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The rows whose text passes the base rules and lies in its bands, with their columns as they were."""
    name = free_name(df, "_quality")
    return with_quality(df, text, name, **limits).where(F.col(f"{name}.kept")).drop(name)


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_quality(read(spark, sf_dir, "documents").select("doc_id", "text"), name="q").drop("text")
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept whole_ratio lowest_chunk_ratio highest_chunk_ratio"
    return judged.select("doc_id", *[F.col(f"q.{c}").alias(c) for c in columns.split()])

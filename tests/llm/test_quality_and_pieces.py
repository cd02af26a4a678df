"""Compression bands, byte convolution and sentence pieces."""

from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import byte_convolution as conv
from ledgerloom.llm import compression_bands as bands
from ledgerloom.llm import sentencepieces as sp
from ledgerloom.llm.words import WordMemory

def prose(words: int, seed: int = 1) -> str:
    draw = random.Random(seed)
    parts = [a + b + c for a in "bdfghklmnprstvwz" for b in "aeiou" for c in ("", "n", "r", "st", "l")]
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(words))


# --- compression bands -----------------------------------------------------------------------------


def brute_repeats(words: list[str]) -> int:
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(hit)


@given(st.lists(st.sampled_from("ab"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_repeated_words_match_marked_positions(words):
    assert bands.repeated_words(words) == brute_repeats(words)


def test_measures_of_odd_texts(frame):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "x\x85y z\n\nx\x85y z\n", "b"), (5, "#$% a|b\na|b", "b"), (None, prose(50), None)]
    found = {r.doc_id: r.q for r in bands.with_quality(frame(rows), name="q").collect()}
    assert [(found[i].n_words, found[i].word_chars, found[i].n_symbols, found[i].n_dup_lines) for i in (1, 2, 3)] == [(0, 0, 0, 0)] * 3
    assert all(found[i].base_failed and not found[i].kept for i in (1, 2, 3))
    # \x85 is no white space here, and lines without a word do not count as copies.
    assert (found[4].n_words, found[4].n_dup_lines) == (4, 1)
    assert (found[5].n_words, found[5].n_symbols, found[5].n_dup_lines) == (3, 5, 0)
    assert found[None].kept


def test_bands_reject_repetitive_and_random_text():
    compress = zstandard.ZstdCompressor(level=bands.LEVEL).compress
    draw = random.Random(5)
    noise = "".join(chr(draw.randrange(33, 0x2FF)) + (" " if i % 9 == 0 else "") for i in range(6000))
    spam = " ".join(f"buy cheap pills now {i % 7}" for i in range(800))
    keep = lambda t: bands.measure(t, compress)[-1]
    assert not keep(spam) and not keep(noise)
    for n in (12, 60, 300, 3000, 20000):
        assert keep(prose(n, n)), n
    # A long text whose middle repeats itself is found by its chunks.
    mixed = prose(2000) + " " + spam * 2 + prose(2000, 2)
    assert not keep(mixed)


def test_every_byte_lies_in_a_judged_chunk():
    for length in (*range(256, 1100), 1500, 4095, 4096, 4097, 7996, 8192, 12289):
        starts, size = bands.chunk_starts(length, bands.CHUNK_BANDS)
        assert {b for k in starts for b in range(k, k + size)} == set(range(length)) and starts == sorted(set(starts))
    assert bands.chunk_starts(255, bands.CHUNK_BANDS) == ([], 0)


def test_noise_is_found_wherever_it_stands():
    compress = zstandard.ZstdCompressor(level=bands.LEVEL).compress
    keep = lambda t: bands.measure(t, compress)[-1]
    draw = random.Random(3)
    for size, tail in ((4096, 3900), (1024, 900), (256, 240)):
        text, noise = prose(2000, size)[:size], base64.b64encode(draw.randbytes(tail)).decode()[:tail]
        repeats = ("again and again " * tail)[:tail]
        assert keep(text) and keep(prose(2000, size)[: size + tail])
        assert not keep(text + noise) and not keep(noise + text), size
        assert not keep(text + repeats) and not keep(repeats + text), size


def test_keep_quality_keeps_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, prose(40), True, 7), (2, "too short", False, 8)], "doc_id long, text string, kept boolean, _quality int")
    kept = bands.keep_quality(df)
    assert kept.columns == df.columns and [tuple(r)[0] for r in kept.collect()] == [1]
    assert bands.keep_quality(df.limit(0)).count() == 0


# --- byte convolution ------------------------------------------------------------------------------


def test_pooling_sees_the_whole_text_and_pieces_change_nothing(monkeypatch):
    net = conv.fit([prose(40, i) + " !!!" * (i % 2) for i in range(40)], [1 - i % 2 for i in range(40)], epochs=1)
    text = prose(9000) + " !!! !!! !!! " + prose(9000, 3)
    whole = conv.chunk_means(conv.responses(net, conv.padded(text))).max(axis=0)
    monkeypatch.setattr(conv, "PIECE", 16 * conv.BLOCK)
    assert np.allclose(conv.pooled(net, text), whole, atol=1e-6)


def plain_score(net, text: str) -> float:
    """The score by loops over bytes, steps, filters and chunks."""
    raw = text.encode()
    data = list(raw) + [0] * (max(conv.TAPS + 2, len(raw) + len(raw) % 2) - len(raw))
    rows = []
    for at in range(0, len(data) - conv.TAPS + 1, 2):
        again = any(at >= lag and data[at : at + 4] == data[at - lag : at - lag + 4] for lag in conv.LAGS)
        rows.append([max(0.0, net.offset[f] + again * net.repeat[f] + sum(net.taps[k][data[at + k]][f] for k in range(conv.TAPS))) for f in range(conv.FILTERS)])
    blocks = [rows[at : at + conv.BLOCK] for at in range(0, len(rows), conv.BLOCK)]
    chunks = [a + b for a, b in zip(blocks, blocks[1:], strict=False)] or blocks
    best = [max(0.0, *(sum(r[f] for r in chunk) / (2 * conv.BLOCK) for chunk in chunks)) for f in range(conv.FILTERS)] if text else [0.0] * conv.FILTERS
    return 1 / (1 + np.exp(-(sum(b * w for b, w in zip(best, net.weight, strict=True)) + net.bias[0])))


def test_scores_match_plain_loops_and_see_every_byte():
    net = conv.fit(["some good text", "bad bad bad"] * 3, [1, 0] * 3, epochs=1)
    for size in [*range(41), 63, 64, 65, 66, 67, 68, 69, 70, 99, 131, 200]:
        text = "".join(chr(97 + (i * i) % 23) for i in range(size))
        assert conv.probability(net, text) == pytest.approx(plain_score(net, text), abs=1e-5), size
        data = conv.padded(text)
        for at in range(size):
            changed = data.copy()
            changed[at] ^= 64
            assert not np.array_equal(conv.responses(net, data), conv.responses(net, changed)) or (net.taps[:, data[at]] == net.taps[:, changed[at]]).all(), (size, at)


def test_gradients_match_differences():
    net = conv.fit(["abc def ghi jkl mno", "x" * 60], [1, 0], epochs=1)
    net = conv.Network(*(p.astype(np.float64) for p in net.parameters()))
    data = conv.padded("some words to look at, some words to look at and others")
    sums = [np.zeros_like(p) for p in net.parameters()]
    conv.gradients(net, data, 0, sums)
    zero = lambda: [np.zeros_like(p) for p in net.parameters()]
    for which, place in ((0, (2, ord("o"), 3)), (0, (0, ord(" "), 7)), (1, (4,)), (2, (5,)), (3, (6,)), (4, (0,))):
        p, step = net.parameters()[which], 1e-4
        p[place] += step
        up = conv.gradients(net, data, 0, zero())
        p[place] -= 2 * step
        down = conv.gradients(net, data, 0, zero())
        p[place] += step
        assert (up - down) / (2 * step) == pytest.approx(sums[which][place], abs=2e-4)


def test_learns_and_scores_odd_texts(spark, frame, folder):
    good = [(i, prose(60, i), "s") for i in range(200)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in prose(60, i).split()), "s") for i in range(100)]
    odd = [(5000, None, None), (5001, "", "s"), (5002, "é", "s"), (5003, prose(30000), "s"), (None, prose(9), "s"), (1, prose(60, 1), "s")]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _, _ in good + bad] + [(5002, None), (9999, 1)], "doc_id long, quality int")
    where = folder(documents=frame(good + bad + odd), labels=labels)
    rows = conv.op4_byte_convolution(spark, where).collect()
    assert len(rows) == 306 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 5000 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held) and sum(r.predicted == int(r.doc_id < 1000) for r in held) / len(held) > 0.95
    empty = folder(documents=frame([]), labels=labels)
    assert conv.op4_byte_convolution(spark, empty).count() == 0


def test_one_label_gives_its_share():
    for labels, side in (([1, 1], 1), ([0, 0], 0)):
        assert abs(conv.probability(conv.fit(["a b", "c d"], labels), "e") - side) < 0.01
    assert conv.probability(conv.fit([], []), "text") == 0.5


def test_held_out_accuracy_on_the_corpus(spark):
    folder = "/root/testdata/sf0.1"
    scored = conv.op4_byte_convolution(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = scored.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    zeros, ones = ([r.score for r in held if r.quality == q] for q in (0, 1))
    assert sum(a < b for a in zeros for b in ones) / (len(zeros) * len(ones)) > 0.98


# --- sentence pieces -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trie():
    return sp.load_pieces(sp.default_pieces())


def brute_best(table: dict[bytes, float], unknown: float, text: str) -> float:
    """The highest score of all segmentations of a text, by a dictionary."""
    chars = list(text)
    best = [0.0] + [float("-inf")] * len(chars)
    for start in range(len(chars)):
        for end in range(start + 1, min(len(chars), start + 24) + 1):
            piece = "".join(chars[start:end]).encode()
            if piece in table:
                best[end] = max(best[end], best[start] + table[piece])
        if chars[start].encode() not in table:
            best[start + 1] = max(best[start + 1], best[start] + unknown)
    return best[-1]


@given(st.text(st.sampled_from("  the inganr\n\t▁é漢😀xqz.!"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_best_score_and_round_trip(trie, text):
    table = {trie.texts[i]: s for i, s in enumerate(trie.scores) if np.isfinite(s)}
    ids, _ = sp.Segmenter(trie).encode([text])
    assert sp.decode_ids(ids, trie.texts) == text
    if text:
        score, run = 0.0, 0
        for i in ids.tolist():
            if np.isfinite(trie.scores[i]):
                score += trie.scores[i]
            else:  # bytes of an uncovered character: its first byte carries the cost
                run = trie.texts[i][0]
                score += trie.unknown_score if run < 0x80 or run >= 0xC0 else 0
        assert score == pytest.approx(brute_best(table, trie.unknown_score, " " + text))


def test_trie_holds_exactly_its_pieces(trie):
    keys = {t: i for i, t in enumerate(trie.texts) if np.isfinite(trie.scores[i])}

    def look_up(key: bytes) -> int:
        node = 0
        for byte in key:
            step = trie.base[node] + byte
            if step >= len(trie.check) or trie.check[step] != node:
                return -1
            node = step
        return trie.piece[node]

    assert all(look_up(k) == i for k, i in keys.items())
    assert all(look_up(k + b"\xff") == -1 and look_up(b"\xff" + k) == -1 for k in list(keys)[:500])


def test_words_side_by_side_and_alone_agree(trie):
    draw = random.Random(2)
    words = list({"".join(draw.choices("theinga rs.é漢", k=draw.randint(1, 30))).encode() for _ in range(500)} | {b"x" * 500})
    segmenter = sp.Segmenter(trie)
    ids, sizes = segmenter.best_of_all(words)
    ends = np.cumsum(sizes)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes, strict=True)] == [segmenter.best(w) for w in words]


def test_forgetting_words_changes_nothing(trie):
    texts = [prose(30, i) for i in range(20)]
    one, few = sp.Segmenter(trie), sp.Segmenter(trie)
    few.memory = WordMemory(few.best_of_all, remembered=10)
    for t in texts:
        assert one.encode([t])[0].tolist() == few.encode([t])[0].tolist()


def test_pieces_of_odd_rows(spark, frame, trie):
    rows = [(1, None, "a"), (2, "", "a"), (3, "  two  spaces ", None), (None, "naïve ▁ 漢字 \n end", "b"), (3, "  two  spaces ", None), (5, "y" * 20000, "b")]
    out = sp.round_trips(frame(rows).withColumn("_decoded", F.lit(1)))
    found = out.collect()
    assert len(found) == 6 and all(r.round_trip for r in found) and "_decoded" in out.columns
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].ids is None and by_id[1].n_pieces == 0 and by_id[2].ids == [] and by_id[5].n_pieces > 1000
    assert sp.round_trips(frame([])).count() == 0

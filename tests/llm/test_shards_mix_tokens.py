"""Sharding, mixing, token files and the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_copies import brute_classes, shingles

import __spark_entry__ as entry_module
import corpus_pipeline
from check import TABLES, compare, duck
from ledgerloom.llm import catalog, compression_bands, context_mixing, mixing, pii, sentencepieces, sharding, token_files, words

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered_once_per_operator():
    names = list(catalog.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= entry_module.queries().keys() and catalog.oracles().keys() <= set(names)


def connection(where: str):
    here = duck(FOLDER)
    for name in TABLES:
        if Path(where, f"{name}.parquet").exists():
            pattern = f"{where}/{name}.parquet"
            here.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{pattern}{'/*.parquet' if Path(pattern).is_dir() else ''}'")
    return here


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_queries_match_their_twins(spark, frame, folder, name):
    for where in (FOLDER, folder(documents=odd_documents(frame)), folder(documents=odd_documents(frame).limit(0))):
        outcome = compare(catalog.queries()[name](spark, where), connection(where).execute(catalog.oracles()[name]))
        assert outcome.startswith("ok") and "types" not in outcome, outcome


def odd_documents(frame):
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choices("ab cde fé|# x", k=draw.randint(0, 90))), f"s{min(i % 9, 4)}") for i in range(400)]
    rows += [(500, None, "s0"), (501, "", None), (None, "no id here", None), (None, "no id here", None), (3, rows[3][1], "s3"), (502, "é" * 3000, "Z"), (503, None, "only empty")]
    return frame(rows).withColumns({"lang": F.when(F.col("doc_id") % 5 > 0, F.lit("en")), "n_chars": F.length("text").cast("long")})


# --- sharding --------------------------------------------------------------------------------------


def test_every_shard_holds_the_mixture(frame):
    rows = [(i, None, "big" if i % 3 == 0 else f"s{i % 7}") for i in range(2400)]
    found = sharding.interleaved(frame(rows).withColumn("slot", F.lit("mine")), "doc_id", "source", shards=24).collect()
    assert len(found) == 2400 and {c for c in Counter(r.shard for r in found).values()} == {100}
    total = Counter(r.source for r in found)
    for shard in range(24):
        mine = [r for r in found if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        for source, count in Counter(r.source for r in mine).items():
            assert abs(count - total[source] / 24) < 2


def test_odd_tables_are_sharded(spark, frame, folder):
    df = odd_documents(frame)
    found = sharding.op5_stratified_interleaving(spark, folder(documents=df)).collect()
    counts = Counter(r.shard for r in found)
    assert len(found) == 407 and max(counts.values()) - min(counts.values()) <= 1
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in found:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id].encode()) + 8, zlib.crc32(texts[r.doc_id].encode()))
    few = sharding.op5_stratified_interleaving(spark, folder(documents=df.where("doc_id < 5"))).collect()
    assert all(r.slot == 0 for r in few) and len({r.shard for r in few}) == len(few)
    again = sharding.op5_stratified_interleaving(spark, folder(documents=df.repartition(7))).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.shard, r.slot)
    assert sorted(map(key, again), key=str) == sorted(map(key, found), key=str)


def test_sharding_runs_no_python(spark):
    plan = sharding.op5_stratified_interleaving(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- mixing ----------------------------------------------------------------------------------------


def brute_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, targets, free = 1.5 * sum(sizes.values()), {}, set(order)
    while True:  # share, cut what is above, share the excess again
        left = total - sum(targets.values())
        weight = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / weight > 2 * sizes[s] + 1e-9}
        if not over:
            return targets | {s: left * weights[s] / weight for s in free}
        targets |= {s: 2.0 * sizes[s] for s in over}
        free -= over


@pytest.mark.parametrize("sizes", [{"a": 100}, {"a": 10, "b": 1000, None: 5}, {"a": 0, "b": 7}, {f"s{i}": (i * 37) % 91 + 1 for i in range(20)}, {"a": 4, "b": 4, "c": 4, "d": 4}])
def test_targets_are_those_of_repeated_sharing(frame, sizes):
    df = frame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(df, "source", "size").collect()}
    assert found == pytest.approx(brute_targets(sizes)) and sum(found.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_the_mix_meets_its_targets(spark, frame, folder):
    df = odd_documents(frame)
    found = mixing.op6_weighted_mix(spark, folder(documents=df)).collect()
    assert len(found) == 407 and all(r.taken == r.copies * r["size"] and r.taken <= 2 * r["size"] for r in found)
    for source in {r.source for r in found}:
        mine = [r for r in found if r.source == source]
        assert sum(r["size"] for r in mine) == mine[0].source_size
        largest = max(r["size"] for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= largest / 2 + 1
        # Complete epochs come first: copies differ by one at most.
        assert max(r.copies for r in mine) - min(r.copies for r in mine) <= 1


def test_low_quality_is_taken_less(frame):
    rows = [(i, "word " * 20 if i % 2 else "w# | " * 20, "one" if i < 900 else "two") for i in range(1000)]
    chosen = [r for r in mixing.mixed(frame(rows), "doc_id", "source", "text").collect() if r.source == "one" and r.copies == 2]
    clean = sum(r.row_id % 2 for r in chosen)
    assert clean > 1.5 * (len(chosen) - clean)


def test_mixed_rows_keep_their_columns(frame):
    df = odd_documents(frame).withColumn("copies", F.lit("mine")).withColumn("_digest", F.lit(1))
    wanted = Counter()
    for r in mixing.mixed(df, "doc_id", "source", "text").collect():
        wanted[r.row_id] += r.copies
    out = mixing.mix_rows(df, "doc_id", "source", "text")
    assert out.columns == df.columns and Counter(r.doc_id for r in out.collect()) == +wanted
    assert mixing.mix_rows(df.limit(0), "doc_id", "source", "text").count() == 0


# --- token files -----------------------------------------------------------------------------------


@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_257), st.integers(0, 2**32 - 1)), max_size=200), max_size=6))
@settings(max_examples=60, deadline=None)
def test_blocks_decode_to_their_ids(blocks):
    arrays = [np.array(b, np.int64) for b in blocks]
    coded = context_mixing.encode_blocks(arrays)
    assert [b.tolist() for b in context_mixing.decode_blocks(coded)] == blocks
    # Each block stands alone: any company gives the same ids.
    assert [context_mixing.decode_blocks([c])[0].tolist() for c in coded] == blocks


def test_long_blocks_repeats_and_bucket_edges():
    draw = np.random.default_rng(1)
    edges = [v + d for v in (0, 256, 1280, 9472, 50_256) for d in (-1, 0, 1) if v + d >= 0]
    blocks = [np.zeros(4096, np.int64), draw.integers(0, 50_257, 4096), np.tile(draw.integers(0, 999, 17), 200), np.array(edges), draw.zipf(1.3, 4096) % 50_257]
    coded = context_mixing.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(context_mixing.decode_blocks(coded), blocks, strict=True))
    # What can be predicted costs little: zeros next to nothing, a loop far below its two bytes an id.
    assert len(coded[0]) < 300 and len(coded[2]) < 0.25 * 2 * len(blocks[2])


def test_damage_is_found():
    coded = context_mixing.encode_blocks([np.arange(500)])[0]
    for at in (1, 9, 40, len(coded) // 2):
        broken = bytearray(coded)
        broken[at] ^= 0x10
        with pytest.raises(ValueError):
            context_mixing.decode_blocks([bytes(broken)])


def test_rare_and_large_ids_and_many_lanes():
    draw = np.random.default_rng(5)
    blocks = [
        draw.permutation(70_000),  # more ids than have a frequency of their own
        np.concatenate([draw.permutation(40_000), np.zeros(30_000, np.int64)]),
        draw.integers(2**30 - 9, 2**30 + 9, 9000),
        np.tile([2**32 - 1, 0, 2**30 - 1], 5000),
        draw.integers(0, 2**32, 40_000),
        np.array([], np.int64),
        np.array([2**32 - 1]),
        draw.zipf(1.2, context_mixing.BLOCK_IDS) % 50_257,
    ]
    coded = context_mixing.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(context_mixing.decode_blocks(coded), blocks, strict=True))
    assert all(np.array_equal(context_mixing.decode_blocks([c])[0], b) for c, b in zip(coded, blocks, strict=True))
    assert context_mixing.encode_blocks([]) == [] == context_mixing.decode_blocks([])
    # More blocks than are read side by side, of all lengths.
    many = [draw.integers(0, 9, k * 61) for k in range(150)]
    assert all(np.array_equal(a, b) for a, b in zip(context_mixing.decode_blocks(context_mixing.encode_blocks(many)), many, strict=True))


def test_ids_without_order_cost_their_entropy():
    draw = np.random.default_rng(6)
    share = np.bincount(draw.integers(0, 3000, 9000) ** 2 // 3000, minlength=3000) + 1.0
    share[::7] *= 30
    ids = draw.choice(3000, 100_000, p=share / share.sum()) * 16
    found = np.unique(ids, return_counts=True)[1] / len(ids)
    entropy = -(found * np.log2(found)).sum() / 8 * len(ids)
    assert sum(map(len, context_mixing.encode_blocks([ids]))) < 1.1 * entropy


def test_pieces_are_encoded_as_the_library_does_whole_texts():
    from tokenizers import Tokenizer

    draw = random.Random(4)
    parts = ["a", "Bc", " ", " ", "  ", "\n", "\t", "\r\n", "'s", "'ll", "'", "<|endoftext|>", "<|", "|>", "é", "漢", "\u3000", "\u2003", "\xa0", "\x85", "\x1c", "\x00", "7", "1.5", ",", "!?", "😀", "\u0301", "ß", "Ж"]
    plain, encode = Tokenizer.from_str(token_files.default_tokenizer()), token_files.text_encoder(token_files.default_tokenizer(), public_tokenizers.PATTERN)
    for k in range(60):
        texts = ["".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(50)] + [None, "", " "]
        flat, ends = encode(pa.array(texts).slice(k % 3))
        found = np.split(flat, ends[:-1])
        assert [f.tolist() for f in found] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts[k % 3 :]]
    assert [len(x) for x in encode(pa.array([None, ""]))] == [0, 2] and [len(x) for x in encode(pa.array([], pa.string()))] == [0, 0]
    # A pattern that isn't known to split where texts are cut: whole texts.
    whole = token_files.text_encoder.__wrapped__(token_files.default_tokenizer(), "other")(pa.array(["it's a  b, c"]))
    assert whole[0].tolist() == plain.encode("it's a  b, c", add_special_tokens=False).ids


def test_pieces_are_looked_up_once():
    pieces, ends = token_files.text_pieces(pa.array(["and, and. and", "", "And and  and\n x ", "and.\nAnd\n"]), [])
    assert sorted(pieces.dictionary.to_pylist()) == [b"\n", b" ", b" and", b" x", b",", b".", b"And", b"and"]
    assert len(pieces) == ends[-1] and b"".join(pieces.to_pylist()) == b"and, and. andAnd and  and\n x and.\nAnd\n"
    # A worker keeps what it has encoded between tasks.
    assert token_files.text_encoder(token_files.default_tokenizer(), public_tokenizers.PATTERN) is token_files.text_encoder(token_files.default_tokenizer(), public_tokenizers.PATTERN)


def test_long_pieces_are_forgotten():
    encode_new = lambda new: (np.concatenate([np.full(len(w), len(w), np.int32) for w in new]), np.array([len(w) for w in new]))
    memory = words.WordMemory(encode_new, remembered=10)
    for k in range(1, 60):
        flat, ends = memory.encode([["x" * k, "ab"], [], ["ab"]])
        assert flat.tolist() == [k] * k + [2] * 4 and ends.tolist() == [k + 2, k + 2, k + 4]
        assert len(memory.ids) <= words.IDS_PER_WORD * 10 + k + 2


def test_joined_checksums():
    draw = random.Random(2)
    for _ in range(50):
        parts = [draw.randbytes(4 * draw.randint(0, 400)) for _ in range(draw.randint(1, 6))]
        assert token_files.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def expected_tokens(rows) -> list[tuple]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document(spark, frame, folder, monkeypatch):
    odd = ["<|endoftext|> a", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b", "<|endoftext|", " <|endoftext|>'s", "tabs\t\tand  spaces \n\n x", "naïve 漢字😀", "it's they'll 'S", "1234 5.6", "!!!", " lead", "trail ", "x" * 3000, "word " * 6000]
    rows = [(i, t) for i, t in enumerate(odd)] + [(50, None), (51, ""), (7, odd[7]), (None, "nobody's"), (40, "a\x00b")]
    where = folder(documents=frame(rows, "doc_id long, text string"))
    found = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.op8_context_mixing(spark, where).collect()]
    assert sorted(found, key=str) == sorted(expected_tokens(rows), key=str)
    empty = folder(documents=frame([], "doc_id long, text string"))
    assert token_files.op8_context_mixing(spark, empty).count() == 0


def test_few_lanes_change_nothing(spark, frame):
    rows = [(i, f"word{i} and more words " * (i % 40 * 30)) for i in range(60)]
    df = frame(rows, "doc_id long, text string")
    blocks = token_files.coded_blocks(df, "doc_id", "text", token_files.default_tokenizer(), public_tokenizers.PATTERN, parts=3, lanes=2)
    found = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.documents_of(blocks).collect()]
    assert sorted(found) == expected_tokens(rows)


# --- pipeline --------------------------------------------------------------------------------------


def pipeline_documents(frame):
    draw = random.Random(12)
    vocabulary = ["".join(draw.choices("bdfgklmnprst", k=1) + draw.choices("aeiou", k=1) + draw.choices("bdfgklmnprst", k=draw.randint(1, 4))) for _ in range(900)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(20, 200))) for _ in range(150)]
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [(300 + i, t + " endword", "en", "s1", len(t)) for i, t in enumerate(texts[:20]) if len(t.split()) > 80]
    rows += [(400, "short one", "en", "s0", 9), (401, None, "en", "s0", None), (402, "again and again " * 60, "en", "s2", 9), (403, texts[5], None, None, 1)]
    rows += [(410 + i, f"{' '.join(draw.choices(vocabulary, k=60))} write to p{i}@example.org please", "en", "s3", 1) for i in range(5)]
    return frame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_do_what_they_say(spark, frame, tmp_path):
    docs = pipeline_documents(frame)
    names = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == names
        kept[name] = docs.collect()
        now = {r.doc_id: r for r in kept[name]}
        if name == "quality_rules":
            assert before.keys() - now.keys() == {400, 401, 402} and all(tuple(before[i]) == tuple(now[i]) for i in now)
        elif name == "near_copies":
            classes = brute_classes([(i, r.text) for i, r in before.items()], 85)
            assert now.keys() == {i for i, (_, c) in classes.items() if i == c} and len(now) < len(before)
        elif name == "personal_data":
            assert now.keys() == before.keys() and not any("@example.org" in r.text for r in now.values())
            assert any("[EMAIL]" in r.text for r in now.values()) and all(r.n_chars == len(r.text) for r in now.values())
            clean = [i for i, r in before.items() if "@" not in r.text]
            assert all(now[i].text == before[i].text for i in clean)
        elif name == "source_mix":
            words = {s: sum(len(r.text.split()) for r in before.values() if r.source == s) for s in {r.source for r in before.values()}}
            taken = {s: sum(len(r.text.split()) for r in kept[name] if r.source == s) for s in words}
            assert all(abs(taken[s] - t) <= 120 for s, t in brute_targets(words).items())
        else:
            trie = sentencepieces.load_pieces(sentencepieces.default_pieces())
            texts = {r.doc_id: r.text for r in kept["source_mix"]}
            assert len(kept[name]) == len(kept["source_mix"])
            assert all(r.round_trip and sentencepieces.decode_ids(np.array(r.ids), trie.texts) == texts[r.doc_id] for r in kept[name])


def test_near_copies_stage_takes_five_words_and_four_fifths(spark, frame):
    draw = random.Random(7)
    rows = []
    for i, changes in enumerate((0, 1, 2, 2, 3, 4)):
        words = [f"w{draw.randrange(10**6)}" for _ in range(100)]
        changed = ["other" if k in range(20, 20 + 20 * changes, 20) else w for k, w in enumerate(words)]
        rows += [(i, " ".join(words)), (10 + i, " ".join(changed))]
    sets = {i: shingles(t, 5) for i, t in rows}
    copies = {10 + i for i in range(6) if 5 * len(sets[i] & sets[10 + i]) >= 4 * len(sets[i] | sets[10 + i])}
    # Two changed words lie between op2's limit and the stage's.
    assert copies == {10, 11, 12, 13} and {c for i, (_, c) in brute_classes(rows, 85).items() if i != c} == {0, 1}
    docs = frame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, FOLDER).collect()} == {i for i, _ in rows} - copies


def test_pipeline_over_tables(spark, frame, folder):
    rows = corpus_pipeline.run(spark, folder(documents=pipeline_documents(frame))).collect()
    assert rows and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    empty = pipeline_documents(frame).limit(0)
    assert corpus_pipeline.run(spark, folder(documents=empty)).count() == 0


def test_filters_keep_clean_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    good = documents.join(labels, "doc_id", "left_semi")
    judged = compression_bands.with_quality(good, name="q")
    assert judged.where("NOT q.base_failed AND NOT q.kept").count() == 0
    spans = pii.with_spans(good, "doc_id").where(~F.col("text").rlike(r"[@0-9+]"))
    assert spans.where(F.size("spans") > 0).count() == 0

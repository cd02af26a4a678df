"""Token-group matrix, pruned graph and components against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import group_matrix as gm
from ledgerloom.llm import pruned_graph as pg
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import shingle_sets


class Sets:
    """Union-find with the smallest member as the root."""

    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def root(self, n):
        while self.parent[n] != n:
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text: str | None, width: int = 4) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_classes(rows: list[tuple], percent: int, width: int = 4) -> dict:
    sets = {i: shingles(t, width) for i, t in rows}
    classes = Sets(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                classes.join(a, b)
    return {i: (len(sets[i]), classes.root(i)) for i in ids}


def corpus(seed: int) -> list[tuple]:
    """Random texts, exact and near copies of them in groups of different sizes, and lines that many share."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünïcode", "A\x85B"]
    lines = [" ".join(draw.choices(vocabulary, k=n)) for n in (8, 14, 60)]
    texts: list[str | None] = [None, "", " \n ", "one", "ONE", "one two", "one two three four"]
    for size in (1, 1, 1, 2, 3, 5, 40):
        for words in (5, 9, 14, 30, 80, 300):
            origin = draw.choices(vocabulary, k=words)
            for _ in range(size):
                copy = list(origin)
                for _ in range(draw.choice((0, 0, 1, 2, 3)) if words > 9 else draw.choice((0, 0, 1))):
                    copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
                if draw.random() < 0.3:
                    copy += draw.choice(lines).split()
                texts.append(draw.choice((" ", "  ", "\n")).join(copy))
    draw.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize(("seed", "percent", "block", "width"), [(1, 85, 512, 4), (2, 85, 7, 4), (3, 70, 16, 4), (4, 80, 512, 5), (5, 80, 5, 5)])
def test_classes_match_brute_force(spark, frame, seed, percent, block, width):
    rows = corpus(seed)
    found = gm.near_copies(frame(rows, "doc_id long, text string"), percent=percent, block=block, width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_classes(rows, percent, width)


@pytest.mark.parametrize("rounds", [0, 1])
def test_classes_match_brute_force_whatever_the_pivots_leave(frame, monkeypatch, rounds):
    """With few rounds or none, the units have to find what pivots find otherwise."""
    rows = corpus(6)
    if rounds:
        monkeypatch.setattr(gm, "ROUNDS", rounds)
    else:
        monkeypatch.setattr(gm, "contracted", lambda linking, *_: (linking.select("set_id", F.col("set_id").alias("cls")).limit(0), []))
    found = gm.near_copies(frame(rows, "doc_id long, text string"), block=9).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_classes(rows, 85)


def near_group(size: int, edits: int) -> list[tuple]:
    draw = random.Random(size)
    origin = [f"o{i}" for i in range(200)]
    rows = []
    for i in range(size):
        copy = list(origin)
        for k in range(edits):
            copy[draw.randrange(len(copy))] = f"x{i}_{k}"
        rows.append((i, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("edits", "width", "percent"), [(2, 5, 80), (1, 4, 85)])
def test_work_grows_with_the_group_and_not_with_its_square(frame, monkeypatch, edits, width, percent):
    counted = []

    def counting(df, name, stage=gm.stage_table):
        found = stage(df, name)
        counted[-1] += found.count() if name in ("pivot-units", "compare-units", "set-group-meetings") else 0
        return found

    monkeypatch.setattr(gm, "stage_table", counting)
    for size in (500, 1000, 2000):
        counted.append(0)
        found = gm.near_copies(frame(near_group(size, edits), "doc_id long, text string"), width=width, percent=percent)
        assert {r.component_id for r in found.collect()} == {0}
    assert counted[1] <= 2.2 * counted[0] and counted[2] <= 2.2 * counted[1], counted
    assert counted[2] <= 2000 * (3 * gm.ROUNDS + 2)


def test_hashed_sets_have_the_sizes_of_the_true_ones():
    texts = [t for _, t in corpus(9)]
    hashed = shingle_sets(texts, 4)
    assert [len(s) for s in hashed] == [len(shingles(t)) for t in texts]
    assert [len(np.intersect1d(hashed[0 if len(hashed[0]) else 5], s)) for s in hashed] == [
        len(shingles(texts[0 if len(hashed[0]) else 5]) & shingles(t)) for t in texts
    ]
    assert [s.tolist() for s in shingle_sets(texts[::-1], 4)] == [s.tolist() for s in hashed[::-1]]


def test_head_bounds_hold_for_all_sizes():
    for percent in (70, 85, 95):
        sizes = [gm.needed(n, percent) for n in range(1, 3000)]
        assert sizes == sorted(sizes) and all(k >= 1 for k in sizes)
        for n in range(1, 3000):
            # Linked sets of sizes n and m <= n share `shared` tokens; each head loses at most what the other lacks.
            m = gm.least_overlap(n, percent)
            shared = min(gm.head_size(k, percent) - (k - gm.least_overlap(k, percent)) for k in (n, m))
            assert shared >= gm.needed(n, percent)


def test_odd_rows_keep_their_result(frame):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(5, text, "a", 1), (5, text, "a", 1), (3, text, None, 2), (None, text, "b", 3), (7, None, "b", 4), (8, "", "b", 5), (8, "", "b", 5)]
    df = frame(rows, "doc_id long, text string, source string, component_id int")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in gm.near_copies(df).collect()), key=str)
    assert found == sorted([(5, 57, 3), (5, 57, 3), (3, 57, 3), (None, 57, None), (7, 0, 7), (8, 0, 8), (8, 0, 8)], key=str)
    kept = gm.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 7, 8, None]
    assert gm.one_of_each(df.limit(0)).count() == 0 and gm.near_copies(df.limit(0)).count() == 0


def test_large_group_of_near_copies_is_one_class(frame):
    origin = [f"o{i}" for i in range(150)]
    rows = [(i, " ".join(origin[: i % 100] + [f"x{i}"] + origin[i % 100 + 1 :])) for i in range(1500)]
    rows += [(5000 + i, " ".join(f"p{i}_{k}" for k in range(100)) + " " + " ".join(origin[:14])) for i in range(300)]
    found = gm.near_copies(frame(rows, "doc_id long, text string"), block=128).collect()
    assert all(r.component_id == (0 if r.doc_id < 5000 else r.doc_id) for r in found)


def test_components_of_chains_stars_and_loops(frame):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7000, 7000), (9001, 9000), (9000, 9001)]
    edges += [(draw.randrange(2000, 3000), draw.randrange(2000, 3000)) for _ in range(400)]
    draw.shuffle(edges)
    classes = Sets({n for e in edges for n in e})
    for a, b in edges:
        classes.join(a, b)
    found = {r.node: r.component for r in components(frame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: classes.root(n) for n in linked}
    assert components(frame([], "a long, b long")).count() == 0


# --- embeddings ------------------------------------------------------------------------------------


def brute_vectors(rows: list[tuple], threshold: float) -> dict:
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v) / np.linalg.norm(v)
    classes, links = Sets([i for i, _ in rows if i is not None]), {i: 0 for i, _ in rows}
    ids = sorted(good)
    near = np.array([good[i] for i in ids]) @ np.array([good[i] for i in ids]).T >= threshold
    for a, b in zip(*np.nonzero(near), strict=True):
        if a != b:
            links[ids[a]] += 1
            classes.join(ids[a], ids[b])
    return {i: (links[i], classes.root(i)) for i, _ in rows if i is not None}


def brute_by_length(rows: list[tuple]) -> dict:
    lengths = {len(v) for _, v, _ in rows}
    return {i: found for n in lengths for i, found in brute_vectors([(i, v) for i, v, _ in rows if len(v) == n], 0.95).items()}


def test_lengths_with_and_without_centres_match_brute_force(frame, monkeypatch):
    monkeypatch.setattr(pg, "PER_CENTRE", 40)
    rows = [(i, v[: 16 if i % 3 else 9], 1) for i, v in vectors(5) if v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = pg.near_vectors(frame(rows, "vec_id long, embedding array<float>, v int"), block=30).collect()
    true = brute_by_length(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert got.keys() == true.keys() and sum(got[i] == true[i] for i in true) >= 0.98 * len(true)
    assert all(got[i][0] <= true[i][0] for i in true)
    # Planted pairs were asked for, and counted into the audit.
    assert found[0].audit_links > pg.PLANTED / 2 and found[0].audit_recall >= 0.9


def test_centres_take_bounded_memory():
    sample = pg.unit_rows(np.random.default_rng(6).normal(size=(65_536, 16))).astype(np.float32)
    tracemalloc.start()
    centres = pg.improved(sample, 65_536, rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(centres) == 65_536 and peak < 300 << 20


def vectors(seed: int, spread: float = 0.1) -> list[tuple]:
    """Random vectors, copies, and groups of near ones of different sizes (one large)."""
    draw = np.random.default_rng(seed)
    rows = [v for v in draw.normal(size=(400, 16))]
    for size in (2, 2, 3, 5, 20, 150):
        centre = draw.normal(size=16)
        rows += [centre + draw.normal(size=16) * spread * np.linalg.norm(centre) / 4 for _ in range(size)]
    rows += [rows[3]] * 30
    out = [(int(i), np.asarray(v, np.float32).tolist()) for i, v in enumerate(rows)]
    out += [(900, None), (901, []), (902, [0.0] * 16), (903, [None] + [1.0] * 15), (904, [float("nan")] * 16), (905, [float("inf")] + [0.0] * 15)]
    return out


@pytest.mark.parametrize(("seed", "block"), [(1, 2048), (2, 40), (3, 2048)])
def test_links_match_brute_force(frame, seed, block):
    rows = vectors(seed)
    found = pg.near_vectors(frame(rows, "vec_id long, embedding array<float>"), block=block).collect()
    true = brute_vectors(rows, 0.95)
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert got.keys() == true.keys() and all(r.kept == (r.vec_id == r.component_id) for r in found)
    # No link that is none, nearly all that are, and the audit agrees.
    assert all(got[i][0] <= true[i][0] for i in true)
    assert sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in true.values())
    assert sum(got[i][1] == true[i][1] for i in true) >= 0.98 * len(true)
    assert all(0.9 <= r.audit_recall <= 1 for r in found)


def test_vector_tables_of_odd_shape(frame):
    schema = "vec_id long, embedding array<float>, copies int"
    assert pg.near_vectors(frame([], schema)).count() == 0
    one = pg.near_vectors(frame([(4, [1.0, 0.0], 1)], schema)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in one] == [(4, 0, 4, True)]
    # The ends of a pair of any length link, also where it isn't the usual one.
    rare = [(i, [1.0, 0.1 * i], 1) for i in range(3)] + [(10, [1.0, 2.0, 3.0], 1), (11, [1.0, 2.0, 3.1], 1), (12, [-1.0, 2.0, 3.0], 1), (13, [5.0], 1), (14, [2.0], 1)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in pg.near_vectors(frame(rare, schema)).collect()}
    assert found == brute_by_length(rare)
    odd = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in pg.near_vectors(frame(odd, schema)).collect()), key=str)
    # Equal rows link with each other, scaled vectors too, other lengths and rows without an id do not.
    assert found == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (None, 0, None)]


def test_pruning_keeps_the_nearest_and_covers_the_rest():
    points = pg.unit_rows(np.random.default_rng(4).normal(size=(60, 8)))
    near = points @ points.T
    everyone = np.tile(np.arange(60), (60, 1))
    kept = pg.pruned(near, everyone, degree=60)
    far = 2 - 2 * near
    for i in range(60):
        chosen = [c for c in kept[i].tolist() if c >= 0]
        others = [c for c in range(60) if c != i]
        assert chosen[0] == min(others, key=lambda c: far[i, c])
        for c in set(others) - set(chosen):
            assert any(pg.ALPHA**2 * far[k, c] <= far[i, c] for k in chosen)


def test_recall_on_the_corpus_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    true = brute_vectors(rows, 0.95)
    found = pg.op9_pruned_graph(spark, "/root/testdata/sf0.01").collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == true


def test_only_sets_that_may_link_are_shuffled_and_once(spark, frame, monkeypatch):
    """Texts without a near copy stay where they are read, and the rounds read the whole sets where they lie."""
    alone = [(i, " ".join(f"t{i}w{k}" for k in range(40))) for i in range(200)]
    near = [(i, text) for i, text in enumerate([" ".join(f"n{k}" for k in range(60)), " ".join(f"n{k}" for k in range(59))], 500)]
    passed, plans = [], []

    def filtered(df, key, members, found=gm.candidates):
        passed.append(found(df, key, members))
        return passed[-1]

    def links(rows, percent, found=gm.pivot_links):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return found(rows, percent)

    monkeypatch.setattr(gm, "candidates", filtered)
    monkeypatch.setattr(gm, "pivot_links", links)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = len(spark.catalog.listTables())
    try:
        classes = {r.doc_id: r.component_id for r in gm.near_copies(frame(alone + near, "doc_id long, text string")).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert classes == {i: min(i, 500) for i, _ in alone + near}
    assert len(passed) == 1 and passed[0].where("set_id >= 500").count() == 2 and passed[0].count() < 20
    assert plans and all(plan.count("Exchange hashpartitioning(set_id") == 1 for plan in plans)
    assert len(spark.catalog.listTables()) == before

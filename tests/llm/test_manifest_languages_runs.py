"""Merkle manifest and periodic runs against brute force, languages by held-out accuracy and odd inputs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_families as lf
from ledgerloom.llm import merkle
from ledgerloom.llm import periodic_runs as pr
from ledgerloom.llm.common import BATCH_BYTES, bounded

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(nodes: list[str], arity: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i : i + arity]) for i in range(0, len(row), arity)])
    return levels


def brute_manifest(rows: list[tuple], arity: int = 2) -> list[tuple]:
    """(doc_id, leaf, subroot, root, siblings, folded root of the altered leaf) of each row, all levels in memory."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, h(*map(shown, row)), row))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {}
    for name in names:
        trees[name].sort(key=lambda r: r[:3])
        levels[name] = tree_of([leaf for _, _, leaf, _ in trees[name]], arity)
    top = tree_of([levels[name][-1][0] for name in names], arity)
    out = []
    for place, name in enumerate(names):
        for pos, (_, _, leaf, row) in enumerate(trees[name]):
            changed = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                changed[3] += 1
            node, siblings = h(*map(shown, changed)), []
            for rows_, at in [(levels[name], pos), (top, place)]:
                for level in rows_[:-1]:
                    first = at // arity * arity
                    run = level[first : first + arity]
                    siblings += run[: at - first] + run[at - first + 1 :]
                    node = h(*run[: at - first], node, *run[at - first + 1 :])
                    at //= arity
            out.append((row[0], leaf, levels[name][-1][0], top[-1][0], h(*siblings), node, node == top[-1][0]))
    return out


def documents(seed: int, count: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        lang = draw.choice(["en"] * 6 + ["de", "", "ß", "Z", None])
        text = draw.choice([None, "", "x" * 200_000 if i == 3 else "a", "ä€\n", " ".join(map(str, range(i)))])
        rows.append((i, draw.choice([None, "s1", "s2"]), lang, draw.choice([None, i, -i]), text))
    return [*rows, (None, None, None, None, None), (None, "s", "en", 1, "t"), rows[0], rows[0], (5, None, "en", None, None)]


@pytest.mark.parametrize("count", [1, 9, 400])
def test_manifest_is_that_of_all_levels(spark, folder, count):
    rows = documents(count, count)
    found = merkle.op11_checkpoint_manifest(spark, folder(documents=spark.createDataFrame(rows, DOCUMENTS))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute_manifest(rows)))


@pytest.mark.parametrize(("arity", "every"), [(2, 3), (3, 2), (16, 2)])
def test_every_arity_and_checkpoint_distance_gives_the_same_proofs(spark, arity, every):
    leaves = [("=a", n, h(str(n))) for n in range(77)] + [("=b", 0, h("b")), ("-", 0, h("n"))]
    df = spark.createDataFrame(leaves, "tree string, id long, digest string")
    found = merkle.sealed(df, ["id", "digest"], ["id"], arity, every).withColumn("proof", merkle.proof_digest(F.col("path")))
    found = found.withColumn("folded", merkle.fold(F.col("digest"), F.col("path"))).collect()
    trees = {"=a": tree_of([leaf for t, _, leaf in leaves if t == "=a"], arity), "=b": [[h("b")]], "-": [[h("n")]]}
    top = tree_of([trees[name][-1][0] for name in ("-", "=a", "=b")], arity)
    assert len(found) == len(leaves)
    for row in found:
        assert row.root == row.folded == top[-1][0] and row.subroot == trees[row.tree][-1][0]
        assert len(row.path) == len(trees[row.tree]) + len(top) - 2


def test_only_every_few_levels_are_stored(spark):
    df = spark.createDataFrame([("t", n, h(str(n))) for n in range(1000)], "tree string, id long, digest string")
    stored = merkle.build(merkle.numbered(df, ["id"]), 2, 4)
    assert [level.count() for level in stored.levels] == [1000, 63, 4, 1]
    assert stored.roots().first()["digest"] == tree_of([h(str(n)) for n in range(1000)], 2)[-1][0]


def test_manifest_reads_only_its_columns_and_takes_empty_tables(spark, folder):
    rows = documents(2, 30)
    clashing = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("tree", "pos", "size", "digest", "path", "root", "row", "range", "id", "claimed", "_tree"):
        clashing = clashing.withColumn(name, F.lit("x"))
    found = merkle.op11_checkpoint_manifest(spark, folder(documents=clashing)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute_manifest(rows)))
    assert merkle.op11_checkpoint_manifest(spark, folder(documents=clashing.limit(0))).count() == 0


def test_manifest_sql_agrees_on_nulls_and_ties(spark, folder):
    rows = documents(8, 90)
    path = folder(documents=spark.createDataFrame(rows, DOCUMENTS))
    found = merkle.op11_checkpoint_manifest(spark, path).collect()
    with duckdb.connect() as base:
        base.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
        twin = base.sql(merkle.ORACLE).fetchall()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, twin))


def brute_runs(words: list, repeats: int = 4, least: int = 6) -> list[tuple]:
    found: dict[tuple, int] = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((i, end - i, q) for (i, end), q in found.items())


def periodic_text(draw: random.Random) -> list[bytes]:
    symbols = draw.choice([1, 2, 2, 3, 5])

    def some(n):
        return [str(draw.randrange(symbols)).encode() for _ in range(n)]

    words = some(draw.randint(0, 60))
    while draw.random() < 0.7 and len(words) < 200:
        block = some(draw.randint(1, 6))
        words += block * draw.randint(1, 8) + block[: draw.randint(0, len(block))]
        if draw.random() < 0.3:
            words = words * 2
    return words


@pytest.mark.parametrize(("repeats", "least"), [(4, 6), (2, 6), (2, 2), (3, 1), (4, 20), (6, 7)])
def test_runs_are_those_of_brute_force(repeats, least):
    draw = random.Random(repeats * 100 + least)
    for _ in range(400):
        texts = [periodic_text(draw) for _ in range(draw.randint(1, 4))]
        assert pr.runs_of(texts, repeats, least) == [brute_runs(t, repeats, max(least, repeats)) for t in texts]


def test_runs_of_long_texts():
    draw = random.Random(4)
    assert pr.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert pr.runs_of([[b"a", b"b", b"c"] * 50_000 + [b"a"]]) == [[(0, 150_001, 3)]]
    assert pr.runs_of([[str(draw.randrange(300)).encode() for _ in range(200_000)]]) == [[]]
    # One phrase many times, with another word before it each time.
    assert pr.runs_of([[w for i in range(20_000) for w in (str(i).encode(), b"p", b"q", b"r", b"s", b"t", b"u")]]) == [[]]


def brute_op13(doc_id, text) -> tuple:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    checksum, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(words)
    g = checksum // 10
    if checksum % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, h(lines), h(kept))


def test_op13_is_brute_force(spark, folder):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    draw = random.Random(9)
    rows = [(1000 + i, b" ".join(periodic_text(draw)).decode()) for i in range(150)]
    rows += [(None, "a b " * 20), (None, None), (40, None), (41, ""), (42, " \t\n\x0b\x0c\r"), (43, "ä ä ä ä ä ä\x85 ä"), (43, "x\xa0 " * 9), (44, "w " * 30_000)]
    rows += [(i, "one two three four five six seven " * 3) for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    table = documents.unionByName(spark.createDataFrame([*rows, rows[0]], "doc_id long, text string"))
    found = pr.op13_maximal_pairs(spark, folder(documents=table)).collect()
    expected = [brute_op13(*row) for row in table.collect()]
    assert sum(row[1] > 0 for row in expected) > 50
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_runs_keep_other_columns(spark, frame):
    df = frame([(1, "a a a a a a b", "s"), (2, None, None)]).withColumns({"_text": F.lit(7), "Runs": F.lit("old"), "extra": F.array(F.lit(1))})
    found = pr.with_runs(df).orderBy("doc_id").collect()
    assert found[0].runs[0].asDict() == {"start": 0, "length": 6, "period": 1} and found[0].collapsed == "a b" and found[0]._text == 7
    assert found[1].runs == [] and found[1].collapsed == "" and found[1].extra == [1]
    assert pr.with_runs(df.limit(0)).collect() == []


def test_batches_are_bounded_by_bytes(spark):
    rows = spark.range(256, numPartitions=1).select(F.repeat(F.lit("word "), 100_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield batch.slice(0, 0) if not batch.num_rows else type(batch).from_pydict({"n": [batch.nbytes]})

    largest = bounded(rows).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
    assert largest <= BATCH_BYTES + 1_000_000


def test_languages_of_held_out_documents(spark):
    found = lf.op12_language_families(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    scored = found.join(truth, "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).alias("right"), "score").collect()
    assert np.mean([r.right for r in scored]) >= 0.98
    assert all(0 <= r.score <= 1 for r in scored)


def test_relatives_are_told_apart_by_their_machine(spark):
    """The family alone can't name the language; without its machines a family's first language would always win."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows, labels = lf.training_rows(bounded(df), "doc_id", "text", "lang", 400)
    model = lf.fit(rows, labels)
    assert model.families == ["germanic", "romance"] and model.languages["germanic"] == ["de", "en"]
    assert {f: m.shape[1] for f, m in model.machines.items()} == {"germanic": 1, "romance": 1}
    names, _ = model.predict(rows)
    assert np.mean([a == b for a, b in zip(names, labels, strict=True)]) > 0.95


def test_features_count_every_sequence_of_the_whole_text():
    text = "Größe, 12 Äpfel — und DAS." * 30

    def plain(clean: bytes) -> list[int]:
        counts = [0] * lf.BINS
        for at in range(len(clean)):
            hashed = 0
            for k in range(lf.GRAM):
                if at + k < len(clean):
                    hashed = ((hashed * 0x01000193) & 0xFFFFFFFF) ^ ((clean[at + k] * int(lf._MIX[k])) & 0xFFFFFFFF)
                    counts[(((hashed ^ (hashed >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF) >> int(lf._TOP_BITS)] += 1
        return counts

    clean = bytes(lf.letters(text))
    assert clean.startswith(" größe äpfel ".encode()) and b"  " not in clean
    for chunk in (7, 64, 1 << 20):
        lf.CHUNK, kept = chunk, lf.CHUNK
        try:
            assert lf.counted(lf.letters(text)).tolist() == plain(clean)
        finally:
            lf.CHUNK = kept


def test_languages_of_odd_texts(spark, frame):
    rows = [(i, t, l) for i, (t, l) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chien et le chat", "fr")] * 20)]
    table = frame([*rows, (None, "the end", "en"), (90, None, "en"), (91, "12 !", "en"), (92, "the", None)], "doc_id long, text string, lang string")
    table = table.withColumns({"_language": F.lit(1), "place": F.lit(2), "key": F.lit(3), "n": F.lit(4)})
    model = lf.fit(*lf.training_rows(bounded(table), "doc_id", "text", "lang"))
    odd = [(1, None), (2, ""), (3, "123 \n"), (4, "the dog"), (4, "the dog"), (None, "der hund"), (6, "le chat " * 200_000)]
    odd_rows = frame([(i, t, None) for i, t in odd]).withColumns({"_language": F.lit(1), "score": F.lit("old")})
    found = {(r.doc_id, (r.text or "")[:8]): (r.lang_pred, r.score) for r in lf.with_language(odd_rows, model).collect()}
    assert found[1, ""] == found[2, ""] == found[3, "123 \n"] == ("und", 0.0)
    assert found[4, "the dog"][0] == "en" and found[None, "der hund"][0] == "de" and found[6, "le chat "][0] == "fr"
    assert lf.with_language(odd_rows.limit(0), model).collect() == []
    # Nothing to learn from, and one language only.
    nothing = lf.fit(*lf.training_rows(bounded(table.limit(0)), "doc_id", "text", "lang"))
    assert {r.lang_pred for r in lf.with_language(odd_rows, nothing).collect()} == {"und"}
    one = lf.fit(*lf.training_rows(bounded(table.where("lang = 'de'")), "doc_id", "text", "lang"))
    assert {(r.lang_pred, r.score) for r in lf.with_language(odd_rows, one).collect()} == {("und", 0.0), ("de", 1.0)}

"""N-gram Jaccard join with a token-group matrix.

Documents become sets of word shingles; two link when their Jaccard similarity reaches a threshold. Similar
sets are put into groups, and the matrix stores for each group the union of its members' tokens. A set can only
link into a group whose union holds enough of its tokens: ``J(q, s) <= |q & union| / |q|``. Only groups that pass the
bound are opened, and their members compared exactly.

1. Equal sets are one set from here on, with the smallest id of its documents. Only its *head* is kept: the
   ``floor((1 - t) n) + 1 + extra`` tokens with the lowest hashes. Linked sets share at least ``needed`` tokens of their
   heads, as a set misses at most ``floor((1 - t) n)`` tokens of the other.
2. Head tokens are counted over all sets. Sets with fewer than ``needed`` tokens that others hold too can't link and are out;
   that is nearly all text that has no near copy. Of the rest, the ``needed - 1`` most frequent tokens may be left out, since
   linked sets must share one of the others; so passages that many documents hold cost little.
3. The group of a set is its token with the lowest digest among those about as frequent as its median token: near copies share
   it, whatever words they change. In a few rounds, each with another digest, every set is compared with one *pivot* of its group, a
   member of the group's largest class; linked sets take the pivot's class. So a large group of near copies becomes one class by
   one comparison per set and round.
4. From here on only tokens that two classes hold matter. All members of a class get one group. The matrix holds each group's
   tokens; it meets the sets of other groups in a join on the token, the smaller group asking the larger.
5. Sets that meet are compared in units of bounded size (a block of members, a block of queries), so no group is ever in one
   task. Within a group its largest class only answers, and is never compared with itself. A unit first bounds every query against the
   union of its members' whole sets and opens the block only for those that can pass, then counts exact overlaps. It
   returns a spanning forest of its links: as many edges as sets at most, never all pairs, and no connection is lost.
6. Components of all edges are the classes.

Everything is exact: heads, counts and bounds only leave out pairs that can't link. No partner or candidate
list has a cap. NULL and empty texts have empty sets and link with nothing, not with one another either. Rows without an id
have no class. Rows may repeat; of rows that share an id but not the text, one text is compared for all. An empty table gives
an empty result. Only the id and the text are read, so other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.membership import BROADCAST_BUCKETS, buckets_for, candidates, key_filter
from ..session import stage_buckets, stage_table
from .common import bounded, free_name, read
from .components import components
from .shingles import shingle_sets

WIDTH = 4
#: Threshold in percent.
PERCENT = 85
#: Sets in a block, and tokens in a block of long sets. A unit holds two blocks.
BLOCK = 512
BLOCK_TOKENS = 500_000
#: Rounds with a pivot per group at most; a round that links less than one in ``WORTHWHILE`` of the sets it asks is the last.
ROUNDS = 5
WORTHWHILE = 25
#: Kinds of units: members of a group's smaller classes among themselves or asking its largest class; other groups' sets asking either.
_AMONG, _TO_LARGEST, _GUESTS_TO_LARGEST, _GUESTS_TO_OTHERS = range(4)


def least_overlap(n, percent: int):
    """Tokens that a set of ``n`` must share with any set it links to: ``ceil(n * percent / 100)``."""
    return -(-n * percent // 100)


def head_size(n: int, percent: int) -> int:
    return min(n, n - least_overlap(n, percent) + 1 + n // 20 + 6)


def needed(n: int, percent: int) -> int:
    """Head tokens that linked sets share at least. It doesn't fall with ``n``, so the smallest partner's counts."""
    m = least_overlap(n, percent)
    return head_size(m, percent) - (m - least_overlap(m, percent))


def linkable_from(percent: int) -> int:
    """The smallest set that can link with a different one: one token in the union is not shared."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _needed(n: Column, percent: int) -> Column:
    """``needed`` as a column expression."""

    def least(x: Column) -> Column:
        return F.ceil(x * percent / F.lit(100))

    m = least(n)
    lost = m - least(m)
    return (F.least(m, lost + 1 + F.floor(m / 20) + 6) - lost).cast("int")


def document_sets(df: DataFrame, row_id: str, text: str, width: int, percent: int) -> DataFrame:
    """``doc_id``, ``n`` (set size), ``fp`` (digest of the set, NULL if empty), ``head`` (lowest hashes)."""
    smallest = linkable_from(percent)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            heads = [s[: head_size(len(s), percent)] if len(s) >= smallest else s[:0] for s in sets]
            ends = np.cumsum([0, *map(len, heads)])
            flat = np.concatenate([np.empty(0, np.uint64), *heads]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                ["doc_id", "n", "fp", "head"],
            )

    kind = df.schema[row_id].dataType.simpleString()
    return df.select(row_id, text).mapInArrow(compute, f"doc_id {kind}, n long, fp binary, head array<long>")


def with_shared_tokens(sets: DataFrame, percent: int) -> DataFrame:
    """Sets that may link: ``set_id``, ``n``, and ``shared``, their head tokens that other heads hold too as (df, token), rarest first."""
    tokens = sets.select("set_id", "n", F.explode("head").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    found = tokens.join(counts, "token").groupBy("set_id", "n").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    return found.where(F.size("shared") >= _needed(F.col("n"), percent)).withColumn("shared", F.array_sort("shared"))


def with_groups(sets: DataFrame, percent: int) -> DataFrame:
    """Add ``grps``, a group for each round, and ``prefix``, the rarest shared tokens of which linked sets share one."""
    median = F.element_at("shared", (F.size("shared") / 2).cast("int") + 1)["df"]
    usual = F.transform(F.filter("shared", lambda t: 2 * t["df"] >= F.col("_median")), lambda t: t["token"])

    def lowest(seed: int) -> Column:
        return F.array_min(F.transform("_usual", lambda t: F.struct(F.xxhash64(t, F.lit(seed)).alias("h"), t.alias("t"))))["t"]

    prefix = F.slice("shared", F.lit(1), F.size("shared") - _needed(F.col("n"), percent) + 1)
    grouped = sets.withColumn("_median", median).withColumn("_usual", usual)
    return grouped.select("set_id", "n", F.array(*map(lowest, range(ROUNDS))).alias("grps"), prefix["token"].alias("prefix"))


def _blocks(count: Column, tokens: Column, block: int) -> Column:
    return F.greatest(F.ceil(count / block), F.ceil(tokens / BLOCK_TOKENS))


def _dealt(into: str) -> Column:
    return F.pmod(F.xxhash64("set_id"), F.greatest(F.col(into), F.lit(1)))


def _each(count: str) -> Column:
    """The numbers of ``count`` blocks; none for 0."""
    return F.when(F.col(count) > 0, F.sequence(F.lit(0).cast("long"), F.col(count) - 1)).otherwise(F.array().cast("array<bigint>"))


def labelled(linking: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``cls``: the label of the set, or the set itself."""
    named = labels.select(F.col("set_id").alias("_set"), F.col("cls").alias("_cls"))
    return linking.join(named, F.col("set_id") == F.col("_set"), "left").withColumn("cls", F.coalesce("_cls", "set_id")).drop("_set", "_cls")


def pivot_units(sets: DataFrame, turn: int, block: int) -> DataFrame:
    """One row per set to compare, in blocks of its group, and the group's pivot in every block: ``grp``, ``i``, ``pivot``, ``set_id``, ``cls`` (the pivot's).

    ``sets``: ``set_id``, ``n``, ``grp``, ``cls``. The pivot's own class and groups of one class have no rows.
    """
    one = F.min(F.struct(F.xxhash64("set_id", F.lit(turn)).alias("h"), F.col("set_id").alias("id"))).alias("one")
    classes = sets.groupBy("grp", "cls").agg(F.count("*").alias("size"), F.sum("n").alias("tokens"), one)
    largest = F.max(F.struct("size", "cls", "one", "tokens")).alias("top")
    groups = classes.groupBy("grp").agg(largest, F.sum("size").alias("sets"), F.sum("tokens").alias("all")).where("sets > top.size")
    blocks = _blocks(F.col("sets") - F.col("top.size"), F.col("all") - F.col("top.tokens"), block)
    groups = groups.select(F.col("grp").alias("_grp"), F.col("top.cls").alias("_cls"), F.col("top.one.id").alias("_pivot"), blocks.alias("blocks"))
    asked = sets.join(groups, F.col("grp") == F.col("_grp")).where("cls <> _cls")
    asked = asked.select("grp", _dealt("blocks").alias("i"), F.lit(False).alias("pivot"), "set_id", F.col("_cls").alias("cls"))
    pivots = groups.select(F.col("_grp").alias("grp"), F.explode(_each("blocks")).alias("i"), F.lit(True).alias("pivot"), F.col("_pivot").alias("set_id"), F.col("_cls").alias("cls"))
    return asked.unionByName(pivots)


def pivot_links(rows: DataFrame, percent: int) -> DataFrame:
    """The sets of ``pivot_units`` (with ``tokens``) that link with their pivot: ``a``, ``b`` (the pivot), ``cls``."""

    def compare(table: pa.Table) -> pa.Table:
        ids, pivot = table.column("set_id").to_numpy(), table.column("pivot").to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in table.column("tokens").to_pylist()]
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "cls": pa.array([], pa.int64())})
        if not pivot.any() or pivot.all():
            return none
        centre, asking = int(np.flatnonzero(pivot)[0]), np.flatnonzero(~pivot).tolist()
        linked = [asking[q] for q, _ in links_between([sets[centre]], [sets[k] for k in asking], percent, False)]
        cls = table.column("cls")[centre].as_py()
        return pa.table({"a": ids[linked], "b": np.full(len(linked), ids[centre]), "cls": np.full(len(linked), cls, np.int64)}) if linked else none

    return rows.groupBy("grp", "i").applyInArrow(compare, "a long, b long, cls long")


def contracted(linking: DataFrame, tokens: DataFrame, percent: int, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """Labels (``set_id``, ``cls``) that only connected sets share, and the links found on the way.

    A set that links with a pivot takes its label; its old label stays with the others, which the links connect with it.
    """
    labels = linking.select("set_id", F.col("set_id").alias("cls")).limit(0)
    edges = []
    for turn in range(ROUNDS):
        sets = labelled(linking.select("set_id", "n", F.col("grps")[turn].alias("grp")), labels)
        rows = stage_table(pivot_units(sets, turn, block), "pivot-units")
        # Texts that share an id may have one set, so a set may have been asked twice.
        found = stage_table(pivot_links(rows.join(tokens, "set_id"), percent).distinct(), "pivot-links")
        edges.append(found.select("a", "b"))
        asked, linked = rows.where("NOT pivot").count(), found.count()
        if linked:
            new = found.select(F.col("a").alias("set_id"), "cls")
            labels = stage_table(labels.join(new, "set_id", "left_anti").unionByName(new), "set-labels")
        if linked * WORTHWHILE < asked or not asked:
            break
    return labels, edges


def open_sets(sets: DataFrame) -> DataFrame:
    """Sets with a token that another class holds too: ``set_id``, ``n``, ``cls``, ``live`` (those tokens), ``home`` (the group of the class)."""
    tokens = sets.select("set_id", "n", "cls", F.element_at("grps", 1).alias("grp"), F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("token")
    live = tokens.join(shared, "token").groupBy("set_id", "n", "cls", "grp").agg(F.collect_set("token").alias("live"))
    live = stage_table(live, "open-sets")
    homes = live.groupBy(F.col("cls").alias("_cls")).agg(F.min(F.struct(F.xxhash64("set_id").alias("h"), F.col("grp").alias("home")))["home"].alias("home"))
    return live.join(homes, F.col("cls") == F.col("_cls")).select("set_id", "n", "cls", "live", "home")


def meetings(sets: DataFrame) -> DataFrame:
    """Pairs (``set_id``, ``home``) of sets and larger groups (ties: later ones) that share a token."""
    sizes = sets.groupBy(F.col("home").alias("_home")).agg(F.count("*").alias("size"))
    held = sets.join(sizes, F.col("home") == F.col("_home")).select("set_id", "n", F.struct("size", "home").alias("own"), F.explode("live").alias("token"))
    matrix = held.select("token", F.col("own").alias("host")).distinct()
    return held.join(matrix, "token").where("own < host").select("set_id", "n", F.col("host.home").alias("home")).distinct()


def units(sets: DataFrame, met: DataFrame, block: int) -> DataFrame:
    """One row per set and unit: ``home``, ``kind``, ``i`` (block of members), ``j`` (block of queries), ``member``, ``set_id``."""
    classes = sets.groupBy("home", "cls").agg(F.count("*").alias("size"), F.sum("n").alias("tokens"))
    groups = classes.groupBy("home").agg(F.max(F.struct("size", "cls", "tokens")).alias("top"), F.sum("size").alias("sets"), F.sum("tokens").alias("all"))
    others = F.col("sets") - F.col("top.size")
    groups = groups.select(
        F.col("home").alias("_home"),
        F.col("top.cls").alias("_top"),
        _blocks(F.col("top.size"), F.col("top.tokens"), block).alias("_largest"),
        F.when(others > 0, _blocks(others, F.col("all") - F.col("top.tokens"), block)).otherwise(0).alias("_others"),
    )
    guests = met.groupBy(F.col("home").alias("_to")).agg(_blocks(F.count("*"), F.sum("n"), block).alias("_guests"))
    groups = groups.join(guests, F.col("_home") == F.col("_to"), "left").fillna(0, ["_guests"]).drop("_to").where("_others > 0 OR _guests > 0")

    inside = sets.join(groups, F.col("home") == F.col("_home"))
    largest = inside.where("cls = _top").withColumn("at", _dealt("_largest"))
    smaller = inside.where("cls <> _top").withColumn("at", _dealt("_others"))
    outside = met.join(groups, F.col("home") == F.col("_home")).withColumn("at", _dealt("_guests"))

    def hosts(df: DataFrame, kind: int, askers: str) -> DataFrame:
        return df.select("home", F.lit(kind).alias("kind"), F.col("at").alias("i"), F.explode(_each(askers)).alias("j"), F.lit(True).alias("member"), "set_id")

    def askers(df: DataFrame, kind: int, hosts: str) -> DataFrame:
        return df.select("home", F.lit(kind).alias("kind"), F.explode(_each(hosts)).alias("i"), F.col("at").alias("j"), F.lit(False).alias("member"), "set_id")

    among = smaller.withColumn("other", F.explode(_each("_others"))).select(
        "home", F.lit(_AMONG).alias("kind"), F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), (F.col("at") <= F.col("other")).alias("member"), "set_id"
    )
    parts = [
        hosts(largest, _TO_LARGEST, "_others"),
        askers(smaller, _TO_LARGEST, "_largest"),
        hosts(largest, _GUESTS_TO_LARGEST, "_guests"),
        askers(outside, _GUESTS_TO_LARGEST, "_largest"),
        hosts(smaller, _GUESTS_TO_OTHERS, "_guests"),
        askers(outside, _GUESTS_TO_OTHERS, "_others"),
    ]
    for part in parts:
        among = among.unionByName(part)
    return among


def whole_sets(df: DataFrame, row_id: str, text: str, wanted: DataFrame, width: int) -> DataFrame:
    """``set_id`` and ``tokens`` (the whole set as bytes) of the documents whose id is wanted."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())],
                ["set_id", "fp", "tokens", "found"],
            )

    kind = df.schema[row_id].dataType.simpleString()
    texts = df.select(F.col(row_id).alias("set_id"), F.col(text).alias("text"))
    buckets = buckets_for(wanted.count())
    if buckets <= BROADCAST_BUCKETS:
        # Texts that can't link are left out before the shuffle; the join settles the few that the filter lets pass.
        texts = candidates(texts, "set_id", key_filter(wanted, "set_id", buckets))
    texts = texts.join(wanted.select("set_id", "fp"), "set_id")
    # Repeated rows are dropped where the join has put them. Documents that share an id may differ in text.
    texts = texts.withColumn("same", F.md5(F.col("text").cast("binary"))).dropDuplicates(["set_id", "same"])
    sets = texts.select("set_id", "text", "fp").mapInArrow(compute, f"set_id {kind}, fp binary, tokens binary, found binary")
    return sets.where("fp = found").select("set_id", "tokens")


def links_between(members: list[np.ndarray], queries: list[np.ndarray], percent: int, same: bool) -> list[tuple[int, int]]:
    """Pairs (query, member) that link, after the bound on the union of all members."""
    sizes = np.array([len(m) for m in members])
    flat = np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    begins = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    union, ends = flat[begins], np.r_[begins[1:], len(flat)]
    found = []
    for q, tokens in enumerate(queries):
        at = np.searchsorted(union, tokens)
        at[at == len(union)] = 0
        hits = at[union[at] == tokens]
        if 100 * len(hits) < percent * len(tokens):
            continue
        counts = ends[hits] - begins[hits]
        places = np.repeat(begins[hits] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        overlap = np.bincount(owner[places], minlength=len(members))
        linked = np.flatnonzero(100 * overlap >= percent * (len(tokens) + sizes - overlap))
        found += [(q, m) for m in linked.tolist() if not (same and m >= q)]
    return found


def forest(links: list[tuple], nodes: set) -> list[tuple]:
    """Edges (node, smallest linked node) that connect what the links connect."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(n, r) for n in nodes if (r := root(n)) != n]


def opened(rows: DataFrame, percent: int) -> DataFrame:
    """Edges (``a``, ``b``) that connect the linked sets of each unit."""

    def compare(table: pa.Table) -> pa.Table:
        ids, member = table.column("set_id").to_pylist(), table.column("member").to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in table.column("tokens").to_pylist()]
        same = table.column("kind")[0].as_py() == _AMONG and table.column("i")[0].as_py() == table.column("j")[0].as_py()
        inside = np.flatnonzero(member).tolist()
        asking = inside if same else np.flatnonzero(~member).tolist()
        edges: list[tuple] = []
        if inside and asking:
            links = links_between([sets[i] for i in inside], [sets[i] for i in asking], percent, same)
            edges = forest([(ids[asking[q]], ids[inside[m]]) for q, m in links], set(ids))
        return pa.table({"a": pa.array([a for a, _ in edges], kind), "b": pa.array([b for _, b in edges], kind)})

    kind = pa.int64()
    return rows.groupBy("home", "kind", "i", "j").applyInArrow(compare, "a long, b long")


def near_copies(df: DataFrame, row_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable by links) of every row. Ids are integers."""
    df = bounded(df).select(F.col(row_id).cast("long").alias(row_id), text)
    documents = stage_table(document_sets(df, row_id, text, width, percent), "document-sets")
    sets = documents.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("set_id"), F.first("n").alias("n"), F.first("head").alias("head"))
    sets = stage_table(sets, "distinct-sets")
    linking = stage_table(with_groups(with_shared_tokens(sets, percent), percent), "linking-sets")
    wanted = stage_table(linking.select("set_id").join(sets.select("set_id", "fp"), "set_id"), "wanted-sets")
    # Every round and the comparison at the end read the whole sets: they lie by id and are not shuffled for each.
    with stage_buckets(whole_sets(df, row_id, text, wanted, width), "whole-sets", "set_id") as tokens:
        labels, found = contracted(linking, tokens, percent, block)
        left = stage_table(open_sets(labelled(linking, labels)), "open-groups")
        met = stage_table(meetings(left), "set-group-meetings")
        rows = stage_table(units(left, met, block), "compare-units")
        edges = opened(rows.join(tokens, "set_id"), percent)
        for links in found:
            edges = edges.unionByName(links)
        classes = components(edges)

    named = sets.select("fp", "set_id").join(classes, F.col("set_id") == F.col("node"), "left")
    named = named.select(F.col("fp").alias("_fp"), F.coalesce("component", "set_id").alias("component_id"))
    joined = documents.select("doc_id", "n", "fp").join(named, F.col("fp") == F.col("_fp"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(df: DataFrame, row_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without near copies: of each class the document with the smallest id stays.

    Of rows that agree in id and text one stays. Rows without an id are not compared and all stay.
    """
    key, digest = free_name(df, "_key"), free_name(df, "_digest")
    found = near_copies(df, row_id, text, **options)
    classes = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key))
    marked = classes.agg(F.min(F.col("component_id") == F.col("doc_id")).alias("first"), (F.count("*") > 1).alias("repeated"))
    marked = stage_table(marked.where("repeated OR NOT first"), "copies")
    here = F.col(row_id).cast("long") == F.col(key)
    alone = df.join(marked.select(key), here, "left_anti")
    again = df.join(marked.where("repeated AND first").select(key), here, "left_semi")
    again = again.withColumn(digest, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).dropDuplicates([row_id, digest])
    return alone.unionByName(again.select(*df.columns))


def op2_group_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"), "doc_id", "text")

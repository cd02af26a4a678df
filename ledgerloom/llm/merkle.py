"""Merkle manifest of a dataset by checkpoint and recompute.

Every row is a leaf: the digest of its fields. Leaves of one tree are ordered and numbered; every ``ARITY`` consecutive nodes of a
level become one node of the next, the last run may be shorter, and a level ends the tree when one node remains. The roots of
all trees are the leaves of an upper tree, whose root stands for the dataset.

1. **Checkpoint.** Only every ``EVERY``-th level is stored. A node of a stored level comes from an aligned subtree of at most
   ``ARITY ** EVERY`` nodes of the stored level below, in one step; the levels between exist inside that step only.
2. **Recompute.** Proofs are extracted from the top down. Each aligned subtree is gathered once more from its stored nodes, its
   missing levels are computed again, every node's siblings are emitted with the path of the subtree's root appended,
   and the interior nodes are dropped.
3. A proof folds a leaf with its siblings to the root. A leaf that was changed folds to another root.

A subtree is the largest thing that a task holds, however many rows a tree has; keys are (tree, number of the subtree), so one tree
may own all rows. Leaves are numbered by ranges of the order, each sorted in its own task; one row per range and tree carries the
counts. Rows that agree in the order's columns and in their digest are interchangeable.

A NULL field counts as ``-`` and a NULL tree as a tree of its own, before the others; a NULL id comes first in its tree. Empty and very
long texts are values like others. Repeated rows are leaves of their own. An empty table gives an empty result, and its
manifest has no root. Other columns of the table are not read, whatever their names. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded, let, read

ARITY = 2
#: Levels from one stored level to the next.
EVERY = 6
#: Rows that a range of the order holds, about.
RANGE_ROWS = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The one tree above all others.
_TOP = "top"
_ROW_BITS = 33  # of monotonically_increasing_id: the place in its partition


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts, F.lit("")).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field's share of its leaf: UTF-8 byte count, colon and value; ``-`` for NULL."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*map(field, values))


def tree_key(value: Column) -> Column:
    """Text that orders trees as their keys do, bytewise, NULL first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def _height(size: Column, arity: int) -> Column:
    """Levels above ``size`` nodes until one is left."""
    powers = [1]
    while powers[-1] * arity < 2**62:
        powers.append(powers[-1] * arity)
    return F.size(F.filter(F.array(*map(F.lit, powers)), lambda p: p < size))


def _runs(count: Column, arity: int) -> Column:
    return F.floor((count + (arity - 1)) / arity)


def _above(nodes: Column, arity: int) -> Column:
    """The digests of the next level."""
    numbers = F.sequence(F.lit(0).cast("long"), _runs(F.size(nodes), arity) - 1)
    return F.transform(numbers, lambda i: digest(F.array_join(F.slice(nodes, (i * arity + 1).cast("int"), arity), "")))


def _levels(nodes: Column, steps: Column, arity: int) -> Column:
    """All levels of a subtree: ``nodes``, and ``steps`` levels above them."""
    rounds = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, F.array(nodes), lambda done, _: F.concat(done, F.array(_above(F.element_at(done, -1), arity))))


def _siblings(levels: Column, place: Column, steps: Column, arity: int) -> Column:
    """From the subtree's bottom up, the digests to the ``left`` and ``right`` of the path from ``place``, each in one string."""

    def step(k: Column) -> Column:
        row, width = levels[k], F.lit(arity).cast("long")
        at = F.floor(place / F.pow(width, k)).cast("long")  # exact: places in a subtree are far below 2**53
        inside = F.pmod(at, width)
        left = F.slice(row, (at - inside + 1).cast("int"), inside.cast("int"))
        right = F.slice(row, (at + 2).cast("int"), (width - 1 - inside).cast("int"))
        return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))

    rounds = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(rounds, step)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path in a row."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def numbered(df: DataFrame, order: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``pos``, each row's number in its ``tree`` by ``order``, and ``size``, the tree's rows.

    Rows are dealt into ranges of the order and numbered inside them; one row per range and tree carries the rest.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // range_rows))
    dealt = df.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
    dealt = stage_table(dealt.withColumn("row", F.monotonically_increasing_id()), "merkle-order")
    place = F.shiftright("row", _ROW_BITS)
    counts = dealt.groupBy(F.col("tree").alias("_tree"), place.alias("range")).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    # One row per range and tree, so these windows stay small.
    whole = Window.partitionBy("_tree")
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tree", "range", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size")
    )
    joined = dealt.withColumn("_range", place).join(offsets, (F.col("tree") == F.col("_tree")) & (F.col("_range") == F.col("range")))
    return joined.select(*df.columns, "size", (F.col("row") - F.col("first") + F.col("before")).alias("pos"))


@dataclass(frozen=True)
class Manifest:
    """Stored levels of a forest, leaves first: ``tree``, ``size`` (nodes of the level in the tree), ``pos``, ``digest``."""

    levels: list[DataFrame]
    arity: int
    every: int

    def roots(self) -> DataFrame:
        """``tree`` and ``digest`` of the last node of each tree."""
        found = [level.where("size = 1").select("tree", "digest") for level in self.levels]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


def _subtrees(level: DataFrame, arity: int, every: int, carried: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree: ``tree``, ``run`` (its number), ``size``, ``nodes`` (by ``pos``), ``steps`` (levels to compute)."""
    run = F.floor(F.col("pos") / F.lit(arity**every)).cast("long").alias("run")
    nodes = F.array_sort(F.collect_list(F.struct("pos", "digest", *carried))).alias("nodes")
    subtrees = level.where("size > 1").groupBy("tree", run).agg(F.first("size").alias("size"), nodes)
    return subtrees.withColumn("steps", F.least(F.lit(every), _height(F.col("size"), arity)))


def build(leaves: DataFrame, arity: int = ARITY, every: int = EVERY) -> Manifest:
    """The stored levels above ``leaves`` (``tree``, ``size``, ``pos``, ``digest``; other columns stay with the leaves)."""
    levels = [leaves]
    while levels[-1].where("size > 1").limit(1).count():
        subtrees = _subtrees(levels[-1], arity, every)
        size = F.floor((F.col("size") + (arity**every - 1)) / F.lit(arity**every)).cast("long")
        top = let(_levels(F.col("nodes.digest"), F.col("steps"), arity), lambda rows: F.element_at(F.element_at(rows, -1), 1))
        above = subtrees.select("tree", size.alias("size"), F.col("run").alias("pos"), top.alias("digest"))
        levels.append(stage_table(above, "merkle-level"))
    return Manifest(levels, arity, every)


def proofs(manifest: Manifest, above: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Every leaf's ``path``, with its ``tree``, ``pos``, ``digest`` and the ``carried`` columns of the leaves.

    ``above`` has one row per tree: ``tree``, ``path`` of the tree's root and columns that all leaves of the tree get. Paths go from
    the bottom up, one step per level with what stands ``left`` and ``right`` of the node; an only node has two empty strings.
    """
    arity, every = manifest.arity, manifest.every
    given = [c for c in above.columns if c not in ("tree", "path")]
    upper = None
    for depth in reversed(range(len(manifest.levels))):
        level, kept = manifest.levels[depth], carried if depth == 0 else ()
        if depth:
            level = level.select("tree", "size", "pos", "digest")
        ended = level.where("size = 1").join(above, "tree").select("tree", "pos", "digest", *kept, "path", *given)
        if upper is None:
            upper = ended
            continue
        subtrees = _subtrees(level, arity, every, kept)
        roots = upper.select("tree", F.col("pos").alias("run"), F.col("path").alias("rest"), *given)

        def paths(nodes: Column, steps: Column) -> Column:
            def emitted(rows: Column) -> Column:
                return F.transform(
                    nodes,
                    lambda node, i: F.struct(
                        *[node[c].alias(c) for c in ("pos", "digest", *kept)], _siblings(rows, i.cast("long"), steps, arity).alias("local")
                    ),
                )

            return let(_levels(F.transform(nodes, lambda node: node["digest"]), steps, arity), emitted)

        opened = subtrees.join(roots, ["tree", "run"]).select("tree", "rest", *given, F.inline(paths(F.col("nodes"), F.col("steps"))))
        opened = opened.withColumn("path", F.concat("local", "rest")).select("tree", "pos", "digest", *kept, "path", *given)
        upper = opened.unionByName(ended)
        if depth:
            upper = stage_table(upper, "merkle-paths")
    return upper


def sealed(leaves: DataFrame, order: Sequence[str], carried: Sequence[str] = (), arity: int = ARITY, every: int = EVERY) -> DataFrame:
    """Number leaves (``tree``, ``digest`` and other columns), build their trees and the tree above, and extract all proofs.

    Returns ``tree``, ``pos``, ``digest``, ``subroot``, ``root``, ``path`` and the ``carried`` columns.
    """
    forest = build(numbered(leaves, order), arity, every)
    trees = forest.roots().select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    top = build(numbered(stage_table(trees, "merkle-roots"), ["name"]), arity, every)
    none = F.array().cast("array<struct<left:string,right:string>>")
    crown = top.roots().select("tree", none.alias("path"), F.col("digest").alias("root"))
    above = proofs(top, crown, ["name"]).select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return proofs(forest, stage_table(above, "merkle-crown"), carried)


def manifest_proofs(df: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", row_id: str = "doc_id", altered: Column | None = None) -> DataFrame:
    """``row_id``, ``leaf``, ``subroot``, ``root``, ``path`` of every row; with ``altered``, also ``claimed``, the leaf whose fields hold
    that struct's values instead (a struct with a value per field, NULL where the row is unchanged)."""
    values = [F.col(c) for c in fields]
    claimed = leaf_digest(*values)
    if altered is not None:
        claimed = F.when(altered.isNotNull(), leaf_digest(*[altered[c] for c in fields])).otherwise(claimed)
    leaves = bounded(df).select(
        tree_key(F.col(tree)).alias("tree"), F.col(row_id).alias("id"), leaf_digest(*values).alias("digest"), claimed.alias("claimed")
    )
    found = sealed(stage_table(leaves, "merkle-leaves"), ["id", "digest"], ["id", "claimed"])
    return found.select(F.col("id").alias(row_id), F.col("digest").alias("leaf"), "subroot", "root", "path", "claimed")


def op11_checkpoint_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(tampered, F.struct(*[(F.col(c) + 1 if c == "n_chars" else F.col(c)).alias(c) for c in FIELDS]))
    found = manifest_proofs(documents, altered=altered).withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLE = """
WITH RECURSIVE crc_steps AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY byte) AS t FROM crc_steps WHERE k = 8),
summed AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN NULL ELSE xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295::BIGINT) END AS crc
  FROM documents, crc_table
), shown AS (
  SELECT doc_id, lang, coalesce(crc % 7 = 0, false) AS tampered,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS front,
    n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS back
  FROM summed
), leaves AS (
  SELECT doc_id, lang, sha256(front || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || back) AS leaf,
    sha256(front || coalesce(length((n_chars + tampered::INT)::VARCHAR) || ':' || (n_chars + tampered::INT), '-') || back) AS claimed
  FROM shown
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM leaves
), low AS (
  SELECT lang, 0 AS level, pos, leaf AS node, size FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), any_value((size + 1) // 2) FROM low WHERE size > 1 GROUP BY lang, level, pos // 2
), subroots AS (
  SELECT lang, node AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS langs FROM low WHERE size = 1
), high AS (
  SELECT 0 AS level, place AS pos, subroot AS node, langs AS size FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), any_value((size + 1) // 2) FROM high WHERE size > 1 GROUP BY level, pos // 2
), crown AS (SELECT node AS root, level AS top FROM high WHERE size = 1),
steps AS (
  SELECT p.lang, p.pos, l.level, CASE WHEN s.node IS NULL THEN 'N' WHEN (p.pos >> l.level) % 2 = 1 THEN 'L' || s.node ELSE 'R' || s.node END AS step
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang JOIN range(64) l(level) ON l.level < r.height
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.lang, p.pos, r.height + l.level, CASE WHEN s.node IS NULL THEN 'N' WHEN (r.place >> l.level) % 2 = 1 THEN 'L' || s.node ELSE 'R' || s.node END
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang CROSS JOIN crown JOIN range(64) l(level) ON l.level < crown.top
  LEFT JOIN high s ON s.level = l.level AND s.pos = xor(r.place >> l.level, 1)
), paths AS (SELECT lang, pos, list(step ORDER BY level) AS path FROM steps GROUP BY lang, pos),
folded AS (
  SELECT p.doc_id, p.leaf, r.subroot, crown.root, coalesce(h.path, []) AS path,
    list_reduce(list_prepend(p.claimed, coalesce(h.path, [])),
      lambda node, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || node WHEN 'R' THEN node || s[2:] ELSE node END)) AS folded_root
  FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang CROSS JOIN crown
  LEFT JOIN paths h ON h.lang IS NOT DISTINCT FROM p.lang AND h.pos = p.pos
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified FROM folded
"""

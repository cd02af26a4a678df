"""Embedding near-duplicates by a robust-pruned flat graph.

1. Equal vectors are one node with a multiplicity. NULL and zero vectors, and those with NULL or non-finite components
   link with nothing. Vectors of different lengths never meet: each length has shards of its own.
2. Nodes go into the shards of their ``overlap`` nearest centres, so shards overlap. Centres are means of a bounded sample; shards
   of any size are split into blocks, and every two blocks of a shard meet, so a crowded shard is never in one task.
3. In each block every node gets candidates - its nearest, some random ones and the medoid - and keeps those that robust pruning
   leaves: the nearest candidate stays, and whatever is ``ALPHA`` times nearer to it than to the node goes. Links are kept both ways.
4. The adjacency lists that a node got in its shards are united. Each query then walks the graph of a block from the
   medoid: greedily to the best unexpanded node for ``steps`` steps, then over every node within range of it (and a margin)
   until no new one turns up, so the walk grows with the neighbourhood and finds groups of any size.
5. Pairs found are verified by cosine in double precision. Blocks return a spanning forest of their links, not the pairs.
6. Components of the forests are the classes. The links of a vector are counted inside its class, exactly and block by block:
   whichever shard found a link, it counts once, and links that no walk found count where their ends are connected.
7. Recall is audited. Planted queries - vectors near sampled ones, which are in no graph and change no result - ask like others,
   and a sample of nodes is compared with all nodes of its length. Below ``TARGET`` the work is done again with more overlap
   and longer walks. ``audit_recall`` is the lower of both shares, ``audit_links`` the number of true links it rests on.

Repeated rows are repeated vectors: they link with each other. Ids are integers; a NULL id is no vector of its own and gets no links.
An empty table gives an empty result. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table
from .common import bounded, read, seeded_hash
from .components import components
from .group_matrix import forest

THRESHOLD = 0.95
#: One centre for so many vectors; centres of all lengths and their bytes at most, as they are sent to every task.
PER_CENTRE = 450
CENTRES = 65_536
CENTRE_BYTES = 32 << 20
#: Sampled vectors per centre, for its mean, and bytes of the sample at most (but one vector for each centre).
SAMPLE, SAMPLE_BYTES = 8, 64 << 20
#: Cosines with centres that are held at a time.
AT_ONCE = 1 << 22
BLOCK = 1024
ALPHA = 1.2
NEAREST, RANDOM, DEGREE = 48, 24, 24
MARGIN = 0.05
AUDIT = 512
PLANTED = 256
TARGET = 0.98
#: (overlap, steps) of the attempts.
ATTEMPTS = ((3, 48), (5, 96), (8, 192))


def unit_rows(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """A list column as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def pruned(near: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Robust pruning of all nodes of a block at once.

    ``near``: cosines of all pairs. ``candidates``: rows of node numbers, -1 for none. Returns ``degree`` columns.
    """
    nodes = np.arange(len(candidates))
    far = 2 - 2 * near  # squared distances of unit vectors
    own = np.where(candidates >= 0, far[nodes[:, None], candidates], np.inf)
    own[candidates == nodes[:, None]] = np.inf
    kept = np.full((len(candidates), degree), -1, np.int32)
    for k in range(degree):
        at = own.argmin(axis=1)
        alive = own[nodes, at] < np.inf
        chosen = candidates[nodes, at]
        kept[alive, k] = chosen[alive]
        if not alive.any():
            break
        covered = alpha * alpha * far[chosen[:, None], candidates] <= own
        own[covered] = np.inf
        own[nodes, at] = np.inf
    return kept


def block_graph(vectors: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The links (from, to) of a block of unit vectors, by from."""
    n = len(vectors)
    low = vectors.astype(np.float32)
    near = low @ low.T
    medoid = int((low @ low.mean(axis=0)).argmax())
    if n == 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    width = min(n, NEAREST + 1)
    nearest = np.argpartition(-near, width - 1, axis=1)[:, :width]
    random = np.random.default_rng(seed).integers(0, n, (n, RANDOM))
    forward = pruned(near, np.hstack([nearest, random, np.full((n, 1), medoid)]))
    # Links both ways. A node that many choose keeps them all.
    a, b = np.repeat(np.arange(n), DEGREE), forward.ravel()
    a, b = a[b >= 0], b[b >= 0]
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return pairs // n, pairs % n


def walk(vectors: np.ndarray, links: tuple[np.ndarray, np.ndarray], medoid: int, queries: np.ndarray, threshold: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) that the search finds near the threshold; all queries move side by side."""
    counts = np.bincount(links[0], minlength=len(vectors))
    begins, to = np.cumsum(counts) - counts, links[1]
    low, asking = vectors.astype(np.float32), queries.astype(np.float32)
    n, m = len(low), len(asking)
    found = np.full((m, n), -2, np.float32)  # cosines of visited nodes
    spent = np.zeros((m, n), bool)  # expanded nodes
    found[:, medoid] = asking @ low[medoid]
    rows = np.arange(m)

    def expand(q: np.ndarray, node: np.ndarray) -> None:
        """Visit all nodes that the given ones lead to."""
        spent[q, node] = True
        sizes = counts[node]
        near = to[np.repeat(begins[node] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        asked = np.repeat(q, sizes)
        new = found[asked, near] == -2
        pairs = np.unique(asked[new] * n + near[new])
        for at in range(0, len(pairs), 1 << 17):
            q_, node_ = np.divmod(pairs[at : at + (1 << 17)], n)
            found[q_, node_] = np.einsum("ij,ij->i", asking[q_], low[node_])

    for _ in range(min(steps, n)):
        open_ = np.where(spent, -3, found)
        best = open_.argmax(axis=1)
        live = open_[rows, best] > -2
        if not live.any():
            break
        expand(rows[live], best[live])
    while True:
        q, node = np.nonzero((found >= threshold - MARGIN) & ~spent)
        if not len(q):
            break
        for at in range(0, len(q), 1 << 14):
            expand(q[at : at + (1 << 14)], node[at : at + (1 << 14)])
    return np.nonzero(found >= threshold - 1e-3)


def valid_vectors(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``vec_id`` (smallest of equal vectors), ``v``, ``copies`` of the vectors that can link."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(row_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    good = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return good.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).select("vec_id", "v", "copies")


def sampled(nodes: DataFrame, dimension: int, count: int, seed: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of ``count`` nodes of a length, as columns: no vector becomes a list of Python numbers."""
    rows = nodes.where(F.size("v") == dimension).orderBy(seeded_hash(seed, "vec_id")).limit(count).select("vec_id", "v").toArrow()
    return rows.column("vec_id").to_numpy(), unit_rows(matrix(rows.column("v"), dimension)).astype(np.float32)


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The best centre of each row, a bounded number of cosines at a time."""
    step = max(1, AT_ONCE // len(centres))
    return np.concatenate([(rows[at : at + step] @ centres.T).argmax(axis=1) for at in range(0, len(rows), step)])


def improved(sample: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Unit centres: a few rounds of means over the sample, from its first rows."""
    centres = sample[:count].copy()
    for _ in range(rounds):
        near = nearest_centre(sample, centres)
        order = np.argsort(near, kind="stable")
        used, begins = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(sample[order], begins, axis=0)
        sizes = np.linalg.norm(sums, axis=1)
        centres[used[sizes > 0]] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def find_centres(nodes: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """The centres of each length that has enough vectors (``sizes``: vectors by length), in proportion; other lengths are one shard."""
    total, out = sum(sizes.values()), {}
    for dimension, size in sorted(sizes.items()):
        share = size / total
        count = int(min(size // PER_CENTRE, CENTRES * share, CENTRE_BYTES * share / (4 * dimension)))
        if count > 1:
            drawn = max(count, min(count * SAMPLE, SAMPLE_BYTES // (4 * dimension)))
            out[dimension] = improved(sampled(nodes, dimension, drawn, "centres")[1], count)
    return out


def shard_rows(nodes: DataFrame, centres: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """One row per node and shard: ``shard`` (its length and centre), ``vec_id``, ``v``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            for dimension in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == dimension)
                ids, rows = batch.column(0).take(pa.array(here)), lists.take(pa.array(here))
                known = centres.get(dimension)
                if known is None:
                    chosen = np.zeros((len(here), 1), np.int64)
                else:
                    width, step = min(overlap, len(known)), max(1, AT_ONCE // len(known))
                    values = unit_rows(matrix(rows, dimension)).astype(np.float32)
                    near = [values[at : at + step] @ known.T for at in range(0, len(values), step)]
                    chosen = np.concatenate([np.argpartition(-part, width - 1, axis=1)[:, :width] for part in near])
                shards = (chosen.astype(np.int64) + (dimension << 32)).ravel()
                ends = pa.array(np.arange(0, len(shards) + 1, chosen.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([ids, rows, pa.ListArray.from_arrays(ends, pa.array(shards))], ["vec_id", "v", "shards"])

    dealt = nodes.select("vec_id", "v").mapInArrow(deal, "vec_id long, v array<double>, shards array<long>")
    return dealt.select(F.explode("shards").alias("shard"), "vec_id", "v")


def dealt_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Add ``i``, the block of the node in its shard, and ``blocks``, their number."""
    sizes = rows.groupBy("shard").agg(F.ceil(F.count("*") / block).alias("blocks"))
    return rows.join(sizes, "shard").withColumn("i", F.pmod(F.xxhash64("vec_id"), "blocks"))


def width_of(column: pa.ChunkedArray) -> int:
    """The length of a group's vectors; a shard's all have one."""
    return len(column[0])


def adjacency(rows: DataFrame) -> DataFrame:
    """``vec_id`` and ``nbrs``: the union of its lists in all its blocks."""

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        vectors = table.column("v")
        a, b = block_graph(unit_rows(matrix(vectors, width_of(vectors))[order]))
        ends = np.searchsorted(a, np.arange(len(ids) + 1))
        return pa.table({"vec_id": ids, "nbrs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[b]))})

    built = rows.select("shard", "i", "vec_id", "v").groupBy("shard", "i").applyInArrow(build, "vec_id long, nbrs array<long>")
    return built.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"))


def block_pairs(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows for every two blocks of a shard, ``i <= j``: block ``i`` holds the graph (``host``), block ``j`` asks."""
    spread = rows.withColumn("at", F.col("i")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return spread.select("shard", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), (F.col("at") <= F.col("other")).alias("host"), "vec_id", "v", *columns)


def planted_rows(planted: DataFrame, shards: DataFrame) -> DataFrame:
    """Planted queries (dealt into shards) as rows that ask every block of their shards; they are in no graph."""
    blocks = shards.groupBy(F.col("shard").alias("_shard")).agg(F.first("blocks").alias("blocks"))
    asked = planted.join(blocks, F.col("shard") == F.col("_shard")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return asked.select("shard", "i", F.col("i").alias("j"), F.lit(False).alias("host"), "vec_id", "v", F.array().cast("array<long>").alias("nbrs"))


def searched(pairs: DataFrame, threshold: float, steps: int) -> DataFrame:
    """Per unit: ``a``, ``b`` - linked vectors, as many as connect what is linked; and every hit ``b`` of a ``planted`` query ``a``."""

    def search(table: pa.Table) -> pa.Table:
        table = table.take(np.argsort(table.column("vec_id").to_numpy()))
        same = table.column("i")[0] == table.column("j")[0]
        ids, host = table.column("vec_id").to_numpy(), table.column("host").to_numpy()
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "planted": pa.array([], pa.bool_())})
        inside = np.flatnonzero(host)
        asking = np.arange(len(ids)) if same else np.flatnonzero(~host)
        if not len(inside) or not len(asking):
            return empty
        values = unit_rows(matrix(table.column("v"), width_of(table.column("v"))))
        lists = table.column("nbrs").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        owner, target = np.repeat(np.arange(len(ids)), sizes), lists.flatten().to_numpy()
        here = ids[inside]
        place = np.minimum(np.searchsorted(here, target), len(here) - 1)
        local = np.minimum(np.searchsorted(inside, owner), len(inside) - 1)
        ok = (here[place] == target) & host[owner]
        order = np.argsort(local[ok], kind="stable")
        edges = local[ok][order], place[ok][order]
        medoid = int((values[inside] @ values[inside].mean(axis=0)).argmax())
        q, m = walk(values[inside], edges, medoid, values[asking], threshold, steps)
        q, m = asking[q], inside[m]
        q, m = q[q != m], m[q != m]
        keep = np.concatenate([np.empty(0, bool), *(
            np.einsum("ij,ij->i", values[q[at : at + 65536]], values[m[at : at + 65536]]) >= threshold for at in range(0, len(q), 65536)
        )])
        real = host[q[keep]] if same else np.ones(keep.sum(), bool)  # in a block with itself only planted rows are no hosts
        q, m = ids[q[keep]], ids[m[keep]]
        edges_ = forest(list(zip(q[real].tolist(), m[real].tolist(), strict=True)), set(np.unique(np.concatenate([q[real], m[real]])).tolist()))
        a = np.concatenate([np.array([a for a, _ in edges_], np.int64), q[~real]])
        b = np.concatenate([np.array([b for _, b in edges_], np.int64), m[~real]])
        return pa.table({"a": a, "b": b, "planted": np.arange(len(a)) >= len(edges_)})

    return pairs.groupBy("shard", "i", "j").applyInArrow(search, "a long, b long, planted boolean")


def counted_links(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """``vec_id`` and ``links``, the vectors of the same class that it links with (copies counted), exactly. ``members``: ``shard`` (the class), ``vec_id``, ``v``, ``copies``."""

    def count(table: pa.Table) -> pa.Table:
        same = table.column("i")[0] == table.column("j")[0]
        host, ids, copies = (table.column(c).to_numpy() for c in ("host", "vec_id", "copies"))
        values = unit_rows(matrix(table.column("v"), width_of(table.column("v"))))
        one, other = (host, host) if same else (host, ~host)
        near = values[one] @ values[other].T >= threshold
        if same:
            np.fill_diagonal(near, False)
            return pa.table({"vec_id": ids, "links": near @ copies})
        return pa.table({"vec_id": np.r_[ids[one], ids[other]], "links": np.r_[near @ copies[other], copies[one] @ near]})

    pairs = block_pairs(dealt_blocks(members, block), "copies")
    counted = pairs.groupBy("shard", "i", "j").applyInArrow(count, "vec_id long, links long")
    return counted.groupBy("vec_id").agg(F.sum("links").alias("links"))


def planted_queries(nodes: DataFrame, dimension: int, threshold: float, count: int = PLANTED, seed: int = 5) -> tuple[DataFrame, dict[int, int]]:
    """Vectors with cosines between the threshold and 1 to sampled nodes, with negative ids; and the node of each."""
    ids, origins = sampled(nodes, dimension, count, "planted")
    draw = np.random.default_rng(seed)
    away = draw.normal(size=origins.shape)
    origins = origins.astype(np.float64)
    away -= (away * origins).sum(axis=1, keepdims=True) * origins
    sizes = np.linalg.norm(away, axis=1)
    cosine = draw.uniform(threshold + 0.1 * (1 - threshold), 1, len(ids))[:, None]
    near = cosine * origins + np.sqrt(1 - cosine**2) * away / np.maximum(sizes, 1e-300)[:, None]
    ok = np.flatnonzero(sizes > 1e-9)  # in one dimension nothing is near but not equal
    rows = [(-(k + 1), near[at].tolist()) for k, at in enumerate(ok.tolist())]
    planted = nodes.sparkSession.createDataFrame(rows, "vec_id long, v array<double>")
    return planted, {-(k + 1): int(ids[at]) for k, at in enumerate(ok.tolist())}


def true_links(nodes: DataFrame, dimension: int, threshold: float) -> DataFrame:
    """``vec_id`` and ``expected``, the links (copies counted) of ``AUDIT`` sampled nodes with all nodes of their length."""
    ids, low = sampled(nodes, dimension, AUDIT, "audit")
    sample = low.astype(np.float64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = sample @ unit_rows(matrix(batch.column(1), dimension)).T >= threshold + 1e-6  # the sample is rounded
            near[ids[:, None] == batch.column(0).to_numpy()[None, :]] = False
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((near @ batch.column(2).to_numpy()).astype(np.int64))], ["vec_id", "expected"])

    found = nodes.where(F.size("v") == dimension).select("vec_id", "v", "copies").mapInArrow(compare, "vec_id long, expected long")
    return found.groupBy("vec_id").agg(F.sum("expected").alias("expected")).where("expected > 0")


def near_vectors(df: DataFrame, row_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, block: int = BLOCK, attempts=ATTEMPTS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row; ``audit_recall`` and ``audit_links`` of the whole run."""
    all_rows = bounded(df).select(F.col(row_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    nodes = stage_table(valid_vectors(df, row_id, vector), "vectors")
    sizes = {r["size"]: r["n"] for r in nodes.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}
    classes = nodes.select(F.col("vec_id").alias("node"), F.col("vec_id").alias("component")).limit(0)
    links = nodes.select("vec_id", F.lit(0).cast("long").alias("links")).limit(0)
    recall, seen = None, 0
    if sum(sizes.values()) > 1:
        centres = find_centres(nodes, sizes)
        usual = max(sizes, key=lambda d: (sizes[d], -d))
        planted, origins = planted_queries(nodes, usual, threshold)
        truth = stage_table(true_links(nodes, usual, threshold), "audit-links")
        for overlap, steps in attempts:
            shards = stage_table(dealt_blocks(shard_rows(nodes, centres, overlap), block), "vector-shards")
            lists = stage_table(adjacency(shards), "vector-graph")
            asked = block_pairs(shards.join(lists, "vec_id"), "nbrs").unionByName(planted_rows(shard_rows(planted, centres, overlap), shards))
            found = stage_table(searched(asked, threshold, steps), "vector-links")
            classes = stage_table(components(found.where("NOT planted").select("a", "b")), "vector-classes")
            members = nodes.join(classes, F.col("vec_id") == F.col("node")).select(F.col("component").alias("shard"), "vec_id", "v", "copies")
            links = stage_table(counted_links(members, threshold, block), "vector-link-counts")
            hits = {(r.a, r.b) for r in found.where("planted").select("a", "b").distinct().collect()} if origins else set()
            shares = [len(hits.intersection(origins.items())) / len(origins)] if origins else []
            per_node = F.avg(F.least(F.coalesce("links", F.lit(0)), "expected") / F.col("expected")).alias("share")
            real = truth.join(links, "vec_id", "left").agg(per_node, F.sum("expected").alias("expected")).collect()[0]
            seen = len(origins) + (real.expected or 0)
            shares += [real.share] if real.expected else []
            recall = min(shares) if shares else None
            if recall is None or recall >= TARGET:
                break

    named = nodes.join(links, "vec_id", "left").join(classes, F.col("vec_id") == F.col("node"), "left")
    named = named.select(F.col("v").alias("_v"), "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "vec_id").alias("component"))
    joined = all_rows.join(named, (F.col("v") == F.col("_v")) & F.col("vec_id").isNotNull(), "left")
    component: Column = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
        F.lit(recall).cast("double").alias("audit_recall"),
        F.lit(seen).cast("long").alias("audit_links"),
    )


def op9_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))

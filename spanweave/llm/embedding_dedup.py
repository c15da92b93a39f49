"""Near-duplicate vectors by NN-descent.

Different vectors are the nodes of a graph in which each lists its nearest known others. The first lists
come from blocks of vectors that fall on the same sides of random hyperplanes. Then neighbours of one
node are compared with each other, which improves their lists, and again. A list that is full of links
is enlarged, and so is every list once only links matter. A list that is full even then lies in a dense group; in its
component links are counted exactly, block against block, without a row for each pair. Recall is audited
against a bounded uniform sample of queries compared with all vectors, each query counting alike. As long as it is
short of the target, twice as many sets of hyperplanes follow and add to the links found before; a target
that is missed in the end is a warning with the recall reached.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.components import connected_components
from spanweave.operators.lineage import materialize

THRESHOLD = 0.95
#: Sets of hyperplanes, vectors in a block on average, and neighbours that a block gives a vector.
TABLES, BLOCK, FROM_BLOCK = 8, 128, 8
#: A block larger than this is dealt at random over several.
MAX_BLOCK = 256
#: Neighbours listed, and listed where all of these are links.
NEIGHBOURS, MORE_NEIGHBOURS = 12, 48
ROUNDS = 2
#: Vectors audited, the recall to reach and how often the search is extended for it.
AUDITED, TARGET_RECALL, EXTENSIONS = 2048, 0.995, 3
#: Smallest block of the exact count; blocks grow with the root of the group, so that copies do too.
EXACT_BLOCK = 128


def _matrix(column) -> np.ndarray:
    """Unit vectors of a column of packed doubles."""
    values = list(column)
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def unit_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, unit``: packed double unit vectors, null where a vector links with nothing."""
    sizes = df.groupBy(F.size(embedding).alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    top = sizes.agg(F.max(F.struct("n", "d")).alias("top")).first().top
    dimension = top.d if top else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("e").to_pylist():
                unit = None
                if v is not None and len(v) == dimension and None not in v:
                    x = np.array(v, np.float64)
                    if np.isfinite(x).all() and x.any():
                        x = x / np.abs(x).max()  # neither too large nor too small to square
                        unit = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
                out.append(unit)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "unit"])

    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
    return rows.mapInArrow(run, "vec_id long, unit binary")


def block_candidates(nodes: DataFrame, n: int, seed: int, tables: int = TABLES) -> DataFrame:
    """``src, dst, sim`` between vectors on the same sides of hyperplanes, the best few of each."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / BLOCK))))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _matrix(batch.column("unit").to_pylist())
            if not len(units):
                continue
            for t in range(tables):
                planes = np.random.default_rng((seed, t)).standard_normal((units.shape[1], bits))
                side = ((units @ planes > 0) << np.arange(bits)).sum(axis=1).astype(np.int64)
                block = pa.array((side << 8) | t)
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("unit"), block], ["node", "unit", "block"])

    placed = nodes.select("node", "unit").mapInArrow(sides, "node long, unit binary, block long")
    large = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MAX_BLOCK)
    pieces = F.coalesce(F.ceil(F.col("n") / MAX_BLOCK), F.lit(1))
    dealt = placed.join(large, "block", "left").withColumn("piece", F.pmod(F.xxhash64(F.lit(seed), "block", "node"), pieces))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        units, ids = _matrix(block["unit"]), block["node"].to_numpy()
        k = min(FROM_BLOCK, len(ids) - 1)
        if k < 1:
            return pd.DataFrame({"src": [], "dst": [], "sim": []}).astype({"src": "int64", "dst": "int64", "sim": "float64"})
        sims = units @ units.T
        np.fill_diagonal(sims, -2)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        return pd.DataFrame({"src": np.repeat(ids, k), "dst": ids[best].ravel(), "sim": np.take_along_axis(sims, best, axis=1).ravel()})

    return dealt.groupBy("block", "piece").applyInPandas(compare, "src long, dst long, sim double")


def _entries(lists: DataFrame) -> DataFrame:
    """``src, dst, sim`` of all lists."""
    entries = lists.select(F.col("node").alias("src"), F.explode("near").alias("e"))
    return entries.select("src", F.col("e.dst").alias("dst"), F.col("e.sim").alias("sim"))


def merge_lists(graph: DataFrame | None, found: DataFrame, room: int = NEIGHBOURS) -> DataFrame:
    """``node, near, room``: the lists with new finds, cut to their room (``room`` where there was no list);
    most similar first."""
    if graph is not None:
        old = graph.select(F.col("node").alias("src"), "room", F.explode_outer("near").alias("e"))
        old = old.select("src", F.col("e.dst").alias("dst"), F.col("e.sim").alias("sim"), "room")
        found = old.unionByName(found.withColumn("room", F.lit(None).cast("int")))
    else:
        found = found.withColumn("room", F.lit(room))
    best = found.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.max("room").alias("room"))
    near = F.sort_array(F.collect_list(F.when(F.col("dst").isNotNull(), F.struct("sim", "dst"))), asc=False)
    lists = best.groupBy(F.col("src").alias("node")).agg(near.alias("near"), F.coalesce(F.max("room"), F.lit(room)).alias("room"))
    return lists.select("node", F.slice("near", 1, F.col("room")).alias("near"), "room")


def local_join(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``src, dst, sim``: what neighbours of one node find in each other, if it improves their lists."""
    full = F.size("near") >= F.col("room")
    floor = F.when(full, F.element_at("near", -1)["sim"]).when(F.col("room") > NEIGHBOURS, threshold).otherwise(-1.0)
    members = nodes.join(graph.select("node", floor.alias("floor"), "near"), "node")
    to_self = graph.select(F.col("node").alias("centre"), F.col("node"))
    to_near = graph.select(F.col("node").alias("centre"), F.explode("near.dst").alias("node"))
    gathered = (
        to_self.unionByName(to_near)
        .join(members.select("node", "unit", "floor"), "node")
        .groupBy("centre")
        .agg(F.collect_list(F.struct("node", "unit", "floor")).alias("m"))  # at most a list and its owner
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("m")
            flat, bounds = column.flatten(), np.append(0, np.cumsum(column.value_lengths().to_numpy()))
            if not len(flat):
                continue
            units = _matrix(flat.field("unit").to_pylist())
            ids, floors = flat.field("node").to_numpy(), flat.field("floor").to_numpy()
            out = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                sims = units[a:b] @ units[a:b].T
                np.fill_diagonal(sims, -2)
                at, to = np.nonzero(sims > floors[a:b, None])
                out.append((ids[a:b][at], ids[a:b][to], sims[at, to]))
            src, dst, sim = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst), pa.array(sim)], ["src", "dst", "sim"])

    return gathered.select("m").mapInArrow(run, "src long, dst long, sim double")


def exact_counts(dense: DataFrame, threshold: float) -> DataFrame:
    """``node, n``: vectors linked to each node of ``dense(node, unit, weight, component)`` in its component.

    Components are dealt into blocks and each pair of blocks is one group, so a component of any size is
    spread; a group gives one row per vector, not per pair.
    """
    sizes = dense.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    length = F.greatest(F.lit(EXACT_BLOCK), F.ceil(4 * F.sqrt("size")))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("size") / length)).select("component", "blocks")
    dealt = dense.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64(F.lit("exact"), "node"), "blocks"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.select(
        "component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "unit", "weight"
    )

    def count(group: pd.DataFrame) -> pd.DataFrame:
        first = (group["own"] == group["lo"]).to_numpy()
        same = bool((group["lo"] == group["hi"]).iloc[0])
        a = group[first]
        b = a if same else group[~first]
        totals = {True: np.zeros(len(a), np.int64), False: np.zeros(len(b), np.int64)}
        if len(a) and len(b):
            left, right = _matrix(a["unit"]), _matrix(b["unit"])
            for i in range(0, len(a), 512):
                linked = left[i : i + 512] @ right.T >= threshold
                if same:
                    rows = np.arange(linked.shape[0])
                    linked[rows, rows + i] = False
                totals[True][i : i + 512] += linked @ b["weight"].to_numpy()
                totals[False] += a["weight"].to_numpy()[i : i + 512] @ linked
        out = [pd.DataFrame({"node": a["node"], "n": totals[True]})]
        if not same:
            out.append(pd.DataFrame({"node": b["node"], "n": totals[False]}))
        return pd.concat(out)

    counted = paired.groupBy("component", "lo", "hi").applyInPandas(count, "node long, n long")
    return counted.groupBy("node").agg(F.sum("n").alias("n"))


def true_links(nodes: DataFrame, queries: DataFrame, threshold: float) -> DataFrame:
    """``node, n_true``: links of a bounded set of queries, by comparing them with all vectors."""
    rows = queries.select("node", "unit").collect()
    ids = np.array([r["node"] for r in rows], np.int64)
    shared = nodes.sparkSession.sparkContext.broadcast((ids, _matrix([bytes(r["unit"]) for r in rows])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        own, units = shared.value
        for batch in batches:
            others = _matrix(batch.column("unit").to_pylist())
            if not len(others):
                continue
            weight, node = batch.column("weight").to_numpy(), batch.column("node").to_numpy()
            total += ((units @ others.T >= threshold) & (own[:, None] != node[None, :])) @ weight
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total)], ["node", "n"])

    return nodes.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n_true"))


def near_duplicates(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``df``: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other vectors at a cosine of ``threshold`` or more, in doubles; equal vectors
    count each. ``component_id`` is the smallest id reachable over links, the own included. A vector that
    is null, zero, of another dimension than most, or holds a null or a number that is not finite has no
    links. A null id is passed over as a component's name; a component of such alone has a null name.
    Repeated rows are equal vectors. Other columns are left out. An empty table gives no rows.
    """
    rows = unit_vectors(df, vec_id, embedding).withColumn("digest", F.md5("unit")).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "vectors")
    name = F.struct(F.col("vec_id").isNull().alias("no_id"), F.col("vec_id").alias("id"), F.col("_row").alias("row"))
    # Equal vectors are one node, whatever their number.
    classes = rows.where("unit IS NOT NULL").groupBy("digest").agg(F.min(name).alias("first"), F.first("unit").alias("unit"), F.count(F.lit(1)).alias("weight"))
    nodes = materialize(classes.select(F.col("first.row").alias("node"), "first", "digest", "unit", "weight"), "vector-nodes")
    vectors = nodes.select("node", "unit", "weight")
    n = nodes.count()
    graph = links = None
    for seed in range(1 + EXTENSIONS):
        graph = materialize(merge_lists(graph, block_candidates(vectors, n, seed, TABLES << seed)), "vector-graph")
        for _ in range(ROUNDS):
            graph = materialize(merge_lists(graph, local_join(graph, vectors, threshold)), "vector-graph")
            # A list full of links has room for more in the next round.
            linked = F.size(F.filter("near", lambda e: e["sim"] >= threshold))
            graph = graph.withColumn("room", F.when(linked >= F.col("room"), MORE_NEIGHBOURS).otherwise(F.col("room")))
        # Only links matter from here on, and only nodes that have some; all of these lists are enlarged.
        fresh = graph.where(linked > 0).select("node", F.filter("near", lambda e: e["sim"] >= threshold).alias("near"))
        fresh = fresh.withColumn("room", F.lit(MORE_NEIGHBOURS))
        links = fresh if links is None else merge_lists(None, _entries(fresh).union(_entries(links)), MORE_NEIGHBOURS)
        for _ in range(ROUNDS):
            found = local_join(links, vectors, threshold).where(F.col("sim") >= threshold)
            links = materialize(merge_lists(links, found), "vector-links")
        counts, grouped = _count_links(links, nodes, threshold)
        recall = audit(vectors, counts, threshold)
        if recall >= TARGET_RECALL:
            break
        graph = graph.withColumn("room", F.lit(NEIGHBOURS)).withColumn("near", F.slice("near", 1, NEIGHBOURS))
    else:
        warnings.warn(f"{recall:.4f} of the links of audited vectors were found; the target is {TARGET_RECALL}", stacklevel=2)
    labelled = nodes.join(grouped, "node", "left").join(counts, "node", "left").select(
        "digest", "first", F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    # As plain tables, so that skewed joins can split the other side.
    heads = materialize(labelled.groupBy("component").agg(F.min("first").alias("head")), "vector-groups")
    by_digest = materialize(labelled.join(heads, "component").select("digest", "n_links", "head"), "vector-heads")
    return rows.join(by_digest, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("head").isNull(), F.col("vec_id")).otherwise(F.col("head.id")).alias("component_id"),
        (F.col("head").isNull() | (F.col("_row") == F.col("head.row"))).alias("kept"),
    )


def _count_links(lists: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The links of every node, counted in vectors, and the components."""
    listed = lists.select(F.col("node").alias("src"), F.explode("near").alias("e")).select("src", F.col("e.dst").alias("dst"))
    links = materialize(listed.union(listed.select("dst", "src")).distinct(), "vector-pairs")
    grouped = materialize(connected_components(links), "vector-components")
    full = lists.where(F.size("near") >= F.col("room")).select("node")
    crowded = full.join(grouped, "node").select("component").distinct()
    dense = materialize(grouped.join(crowded, "component", "left_semi").select("node", "component"), "vector-dense")
    weights = nodes.select("node", "unit", "weight")
    exact = exact_counts(dense.join(weights, "node"), threshold)
    rest = links.join(dense.select(F.col("node").alias("src")), "src", "left_anti")
    rest = rest.join(nodes.select(F.col("node").alias("dst"), "weight"), "dst").groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("n"))
    return materialize(rest.unionByName(exact), "vector-counts"), grouped


def audit(vectors: DataFrame, counts: DataFrame, threshold: float, n_queries: int = AUDITED) -> float:
    """Mean share of its links that a vector was given, over those of a uniform sample that have any."""
    some = vectors.select("node").orderBy(F.xxhash64(F.lit("audit"), "node"), "node").limit(n_queries)
    queries = materialize(vectors.join(F.broadcast(some), "node"), "vector-audit")
    if queries.isEmpty():
        return 1.0
    truth = true_links(vectors, queries, threshold).where("n_true > 0")
    share = F.least("n_true", F.coalesce("n", F.lit(0))) / F.col("n_true")
    recall = truth.join(counts, "node", "left").agg(F.avg(share)).first()[0]
    return 1.0 if recall is None else recall

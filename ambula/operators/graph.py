"""The walking graph: components, pruning, arcs with times, and catchments by shortest paths."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambula.functions.walk import haversine_m, segment_times_ds
from ambula.operators.components import connected_components
from ambula.stages import write_stage

#: Smaller components are left out of the graph.
MIN_COMPONENT = 30
#: Arcs of a city up to which its shortest paths run in one kernel for each type; beyond, as rounds over blocks of nodes.
KERNEL_ARCS = 20_000_000
#: Arcs of a block, about.
BLOCK_ARCS = 200_000
_FAR = 1 << 62


def component_sizes(segments: DataFrame) -> DataFrame:
    """(node, component, size) over segments(a, b)."""
    found = connected_components(segments)
    return found.join(found.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").select("node", "component", "size")


def prune(segments: DataFrame, least: int = MIN_COMPONENT) -> DataFrame:
    """The segments of components of at least that many nodes."""
    keep = component_sizes(segments).where(F.col("size") >= least).select(F.col("node").alias("a"))
    return segments.join(keep, "a", "left_semi").select(*segments.columns)


def weigh(segments: DataFrame, nodes: DataFrame) -> DataFrame:
    """segments with their length and the times there and back, in tenths of a second. nodes: node_id, lng, lat, elev."""
    a = nodes.select(F.col("node_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in ("lng", "lat", "elev")])
    b = nodes.select(F.col("node_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("lng", "lat", "elev")])
    met = segments.join(a, "a").join(b, "b").withColumn("d", haversine_m(F.col("a_lng"), F.col("a_lat"), F.col("b_lng"), F.col("b_lat")))
    there, back = segment_times_ds(F.col("d"), F.col("b_elev") - F.col("a_elev"), F.col("steps"), F.col("flat"))
    return met.withColumns({"t_ab": there, "t_ba": back}).select(*segments.columns, "d", "t_ab", "t_ba")


def reversed_arcs(weighed: DataFrame) -> DataFrame:
    """(src, dst, w): the arc b to a carries the time from a to b, so paths from a site give times to it."""
    there = weighed.select(F.col("b").alias("src"), F.col("a").alias("dst"), F.col("t_ab").alias("w"))
    return there.unionByName(weighed.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("t_ba").alias("w")))


def first_seeds(seeds: DataFrame) -> DataFrame:
    """(type_id, node_id, pid): of the sites at a node the one of the least pid."""
    return seeds.groupBy("type_id", "node_id").agg(F.min("pid").alias("pid"))


_RESULT = "type_id string, node_id long, pid long, dist_ds long, next_hop long"


def _kernel(arcs: pd.DataFrame, seeds: pd.DataFrame) -> pd.DataFrame:
    """Least times from all seeds of a type; of equal ways the one over the nearer, then smaller neighbour."""
    if not len(seeds):
        return pd.DataFrame({"type_id": pd.Series(dtype=str), **{c: pd.Series(dtype="int64") for c in ("node_id", "pid", "dist_ds", "next_hop")}})
    ids = np.unique(np.concatenate((arcs.src, arcs.dst, seeds.node_id)))
    src, dst, w = np.searchsorted(ids, arcs.src), np.searchsorted(ids, arcs.dst), arcs.w.to_numpy(np.int64)
    order = np.argsort(src, kind="stable")
    first = np.searchsorted(src[order], np.arange(len(ids) + 1)).tolist()
    dst, w = dst[order].tolist(), w[order].tolist()
    far = 1 << 62
    dist, hop, pid = [far] * len(ids), [-1] * len(ids), [-1] * len(ids)
    heap = []
    for node, p in zip(np.searchsorted(ids, seeds.node_id).tolist(), seeds.pid.tolist()):
        dist[node], pid[node] = 0, p
        heap.append((0, node))
    heapq.heapify(heap)
    while heap:
        d, u = heapq.heappop(heap)
        if d > dist[u]:
            continue
        for k in range(first[u], first[u + 1]):
            v = dst[k]
            if d + w[k] < dist[v]:
                dist[v], hop[v], pid[v] = d + w[k], u, pid[u]
                heapq.heappush(heap, (dist[v], v))
    reached = np.array([d < far for d in dist])
    hops = np.array(hop)
    out = pd.DataFrame({"type_id": seeds.type_id_.iloc[0], "node_id": ids, "pid": pid, "dist_ds": dist, "next_hop": pd.array(np.where(hops >= 0, ids[hops], 0), "Int64")})
    out.loc[hops < 0, "next_hop"] = pd.NA
    return out[reached]


_KEYS = ["type_id", "block"]
_GRAPH = "block int, nodes binary, first binary, dst binary, w binary, out_src binary, out_dst binary, out_block binary, out_w binary"
#: Of a type and block: what is known (ids with their times, and the best way in from other blocks), or what is told to it.
_STATE = "type_id string, block int, known boolean, ids binary, dist binary, over binary, over_dist binary, over_node binary"
_ARRAYS = _STATE.replace(" string", "").replace(" int", "").replace(" boolean", "").replace(" binary", "").split(", ")


def _read(row, name: str, dtype: str = "<i8") -> np.ndarray:
    """A packed column of a row; empty if there is none."""
    value = None if row is None else getattr(row, name)
    return np.frombuffer(value, dtype) if isinstance(value, (bytes, bytearray)) else np.zeros(0, dtype)


def _least(node: np.ndarray, *ways: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each node once, ascending, with its least way."""
    order = np.lexsort((*ways[::-1], node))
    node = node[order]
    first = np.flatnonzero(np.diff(node, prepend=node[0] - 1)) if len(node) else []
    return node[first], *(way[order][first] for way in ways)


def _in_blocks(cuts: np.ndarray):
    """arcs with the blocks of both ends."""

    def run(frames):
        for f in frames:
            yield f.assign(block=np.searchsorted(cuts, f.src, "right").astype("i4"), dst_block=np.searchsorted(cuts, f.dst, "right").astype("i4"))

    return run


def _packed_block(arcs: pd.DataFrame) -> pd.DataFrame:
    """A block's arcs as one row: those inside by source, and those that leave it."""
    block = int(arcs.block.iloc[0])
    inside = (arcs.dst_block == block).to_numpy()
    src, dst, w = (arcs[c].to_numpy(np.int64) for c in ("src", "dst", "w"))
    nodes = np.unique(np.concatenate((src, dst[inside])))
    at = np.searchsorted(nodes, src)
    order = np.flatnonzero(inside)[np.argsort(at[inside], kind="stable")]
    first = np.searchsorted(at[order], np.arange(len(nodes) + 1))
    row = [nodes, first, np.searchsorted(nodes, dst[order]), w[order], at[~inside], dst[~inside], arcs.dst_block.to_numpy(np.int64)[~inside], w[~inside]]
    return pd.DataFrame([[block, *[v.astype("<i8").tobytes() for v in row]]], columns=[c.split()[0] for c in _GRAPH.split(", ")])


def _packed_seeds(cuts: np.ndarray):
    """Seeds as what blocks are told: time 0, over no node, and the label in place of the node before."""

    def run(frames):
        for f in frames:
            f = f.assign(block=np.searchsorted(cuts, f.node_id, "right").astype("i4"))
            rows = [_told(kind, block, g.node_id.to_numpy(), *(np.full(len(g), v) for v in (0, -1)), g.pid.to_numpy()) for (kind, block), g in f.groupby(["type_id", "block"])]
            yield pd.DataFrame(rows, columns=_ARRAYS)

    return run


def _told(kind: str, block: int, node: np.ndarray, *ways: np.ndarray) -> tuple:
    """A row of what a block is told: nodes, and for each the time, the time of the node before and that node."""
    return (kind, int(block), False, node.astype("<i8").tobytes(), None, *(way.astype("<i8").tobytes() for way in ways))


def _settled(kept: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
    """A round of a type's block: times fall from what it is told on, by a heap; neighbours are told of those that fell."""
    if not len(told):
        return pd.DataFrame(columns=_ARRAYS)
    row = next(kept.itertuples())
    node, over, over_dist, over_node = _least(*(np.concatenate([_read(r, c) for r in told.itertuples()]) for c in ("ids", "over", "over_dist", "over_node")))
    nodes, known = _read(row, "nodes"), _read(row, "ids")
    ids = np.unique(np.concatenate((nodes, known, node)))
    best = np.full((4, len(ids)), _FAR)  # the time, and the least way in from other blocks
    for k, c in enumerate(("dist", "over", "over_dist", "over_node")):
        best[k, np.searchsorted(ids, known)] = _read(row, c)
    at = np.searchsorted(ids, node)
    _, *ways = _least(np.concatenate((at, at)), *(np.concatenate((best[k, at], way)) for k, way in ((1, over), (2, over_dist), (3, over_node))))
    best[1:, at] = ways
    # the graph's nodes may be a part of all that are known: the others have no arcs that start there
    place = np.full(len(ids), -1)
    place[np.searchsorted(ids, nodes)] = np.arange(len(nodes))
    first, place, inner = _read(row, "first").tolist(), place.tolist(), np.searchsorted(ids, nodes)
    dst, w = inner[_read(row, "dst")].tolist(), _read(row, "w").tolist()
    fell = at[over < best[0, at]]
    dist, heap, fallen = best[0].tolist(), [], set(fell.tolist())
    for u, d in zip(fell.tolist(), best[1, fell].tolist()):
        dist[u] = d
        heap.append((d, u))
    heapq.heapify(heap)
    while heap:
        d, u = heapq.heappop(heap)
        if d > dist[u] or (p := place[u]) < 0:
            continue
        for k in range(first[p], first[p + 1]):
            v = dst[k]
            if d + w[k] < dist[v]:
                dist[v] = d + w[k]
                fallen.add(v)
                heapq.heappush(heap, (dist[v], v))
    best[0] = dist
    kind, block = row.type_id, int(row.block)
    reached = best[0] < _FAR
    rows = [(kind, block, True, ids[reached].tobytes(), *(v[reached].tobytes() for v in best))]
    new = np.zeros(len(ids), bool)
    new[list(fallen)] = True
    src = inner[_read(row, "out_src")]
    tell = new[src]
    src, out, blocks, more = src[tell], *(_read(row, c)[tell] for c in ("out_dst", "out_block", "out_w"))
    for b in np.unique(blocks):
        one = blocks == b
        rows.append(_told(kind, b, *_least(out[one], best[0, src[one]] + more[one], best[0, src[one]], ids[src[one]])))
    return pd.DataFrame(rows, columns=_ARRAYS)


def _followed(frames):
    """Of settled blocks each node's hop, and the label or the node of another block that its hops lead to."""
    for f in frames:
        for row in f.itertuples():
            ids, dist, over, over_dist, over_node = (_read(row, c) for c in ("ids", "dist", "over", "over_dist", "over_node"))
            n = len(ids)
            nodes, first = _read(row, "nodes"), _read(row, "first")
            src, dst, w = np.repeat(nodes, np.diff(first)), nodes[_read(row, "dst")], _read(row, "w")
            a, b = (np.minimum(np.searchsorted(ids, v), max(n - 1, 0)) for v in (src, dst))
            step = (ids[a] == src) & (ids[b] == dst)
            step &= (dist[a] + w == dist[b]) & (dist[b] > 0)
            start = dist == 0
            outer = (over == dist) & ~start
            # places and nodes are in the same order; -1 for ways in from other blocks
            to, d, hop, at = _least(np.concatenate((b[step], np.flatnonzero(outer))), np.concatenate((dist[a[step]], over_dist[outer])), np.concatenate((ids[a[step]], over_node[outer])), np.concatenate((a[step], np.full(outer.sum(), -1))))
            hops = np.zeros(n, np.int64)
            hops[to] = hop
            lead = np.arange(n)
            lead[to] = np.where(at >= 0, at, to)
            while (further := lead[lead]).tolist() != lead.tolist():
                lead = further
            own = start[lead]
            yield pd.DataFrame({
                "type_id": row.type_id, "node_id": ids, "dist_ds": dist, "next_hop": pd.array(hops, "Int64"),
                "pid": pd.array(over_node[lead], "Int64"), "at": pd.array(hops[lead], "Int64"),
            }).assign(next_hop=lambda x: x.next_hop.mask(start), pid=lambda x: x.pid.mask(~own), at=lambda x: x["at"].mask(own))


def _by_rounds(arcs: DataFrame, seeds: DataFrame, block_arcs: int) -> DataFrame:
    """The same by rounds over blocks of nodes, ranges of ids with about so many arcs each.

    In a round every block that is told of less times settles its own nodes, and tells the blocks that its arcs lead to. So
    there are about as many rounds as a shortest path changes blocks, not as it has arcs. Then hops are found in each block,
    and labels follow them: inside of blocks at once, between them by rounds that double their length.
    """
    arcs = write_stage(arcs.select("src", "dst", F.col("w").cast("long").alias("w")), "arcs")
    parts = -(-arcs.count() // block_arcs)
    cuts = np.unique(np.array(arcs.approxQuantile("src", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else [], np.int64))
    graph = arcs.mapInPandas(_in_blocks(cuts), "src long, dst long, w long, block int, dst_block int")
    graph = write_stage(graph.groupBy("block").applyInPandas(_packed_block, _GRAPH), "graph")
    told = write_stage(seeds.mapInPandas(_packed_seeds(cuts), _STATE), "dist")
    spark = arcs.sparkSession
    # blocks are few rows, but much work: their number of partitions is given
    tasks = max(1, min((len(cuts) + 1) * seeds.select("type_id").distinct().count(), 4 * spark.sparkContext.defaultParallelism))
    state = spark.createDataFrame([], _STATE)
    while not told.isEmpty():
        active = told.select(*_KEYS).distinct()
        kept = active.join(graph, "block", "left").join(state.drop("known"), _KEYS, "left").repartition(tasks, *_KEYS)
        tidings = told.withColumnsRenamed({c: c + "_" for c in _KEYS}).repartition(tasks, *[c + "_" for c in _KEYS])
        run = kept.groupBy(*_KEYS).cogroup(tidings.groupBy(*[c + "_" for c in _KEYS])).applyInPandas(_settled, _STATE)
        both = write_stage(run.unionByName(state.join(active, _KEYS, "left_anti")), "dist")
        state, told = both.where("known"), both.where("not known")
    labels = state.join(graph, "block", "left").repartition(tasks, *_KEYS)
    labels = write_stage(labels.mapInPandas(_followed, "type_id string, node_id long, dist_ds long, next_hop long, pid long, at long"), "labels")
    # only nodes that other blocks' hops lead to need a label from further and further along
    ends = labels.where("at is not null").select("type_id", F.col("at").alias("node_id")).distinct()
    ends = write_stage(labels.join(ends, ["type_id", "node_id"], "left_semi").select("type_id", "node_id", "pid", "at"), "ends")
    while not ends.where("pid is null").isEmpty():
        ahead = ends.select("type_id", F.col("node_id").alias("at"), F.col("pid").alias("pid_"), F.col("at").alias("at_"))
        ends = ends.join(ahead, ["type_id", "at"], "left").select("type_id", "node_id", F.coalesce("pid", "pid_").alias("pid"), F.coalesce("at_", "at").alias("at"))
        ends = write_stage(ends, "ends")
    last = ends.select("type_id", F.col("node_id").alias("at"), F.col("pid").alias("pid_"))
    return labels.join(last, ["type_id", "at"], "left").select("type_id", "node_id", F.coalesce("pid", "pid_").alias("pid"), "dist_ds", "next_hop")


def shortest_paths(arcs: DataFrame, seeds: DataFrame, method: str | None = None, block_arcs: int = BLOCK_ARCS) -> DataFrame:
    """(type_id, node_id, pid, dist_ds, next_hop) of every node that a site of the type is reached from.

    arcs(src, dst, w), reversed as above, w at least 1; seeds(type_id, node_id, pid), one for each node and type. method is
    "kernel" (a heap for each type), "rounds" (a heap for each type and block of about block_arcs arcs, until no block tells
    another of a less time), or None to choose by the number of arcs. Both give the same.
    """
    seeds = seeds.select(F.col("type_id").cast("string").alias("type_id"), "node_id", F.col("pid").cast("long").alias("pid"))
    if method is None:
        method = "kernel" if arcs.count() <= KERNEL_ARCS else "rounds"
    if method == "rounds":
        return _by_rounds(arcs, seeds, block_arcs)
    types = seeds.select("type_id").distinct()
    each = arcs.select("src", "dst", F.col("w").cast("long").alias("w")).crossJoin(F.broadcast(types))  # a row for each type of a run: tens
    left, right = each.groupBy("type_id"), seeds.toDF("type_id_", "node_id", "pid").groupBy("type_id_")
    return left.cogroup(right).applyInPandas(_kernel, _RESULT)


def longest_times(labels: DataFrame, seeds: DataFrame) -> DataFrame:
    """(type_id, pid, t_max): seconds of the farthest node of each site; 0 if it has none."""
    far = labels.groupBy("type_id", "pid").agg(F.max(F.floor(F.col("dist_ds") / 10)).alias("t_max"))
    sites = seeds.select(F.col("type_id").cast("string").alias("type_id"), F.col("pid").cast("long").alias("pid")).distinct()
    return sites.join(far, ["type_id", "pid"], "left").select("type_id", "pid", F.coalesce("t_max", F.lit(0)).cast("int").alias("t_max"))

"""Parent–child links to full hierarchies by leaf peeling (problem 5).

Bottom-up, every round peels the nodes whose children are all peeled; a peeled node sends its
subtree size and its descendant list to its parent. In reverse order of the rounds each node
then takes depth and root from its parent. Nodes that are never peeled lie on a cycle.

The rounds are joins over all links until what is left of a group has at most ``GROUP_EDGES`` links;
then a task peels it to the end, many groups at once with array operations. Most groups are that
small before the first round. A round also contracts chains, so that a deep tree takes
rounds in proportion to the logarithm of its depth: a node with one child and a parent that keeps
its place in the round (by a hash of node and round) is spliced out, its child becomes
its parent's with the sum of the distances. A peeled or spliced node keeps the parent it had then, and
its depth is that parent's depth and the distance.

Paths and descendant lists are made only where they are asked for. A task emits them in batches of
BATCH_ELEMENTS; of groups that do not fit a task paths grow by doubling, in log of the depth rounds.

Defined results: links with a null or blank end and null groups are left out by the caller or
dropped here when null; repeated links count once; of several parents of one child the
smallest is followed and ``n_parents`` tells their number, and with ``all_nodes`` a parent that is
not followed and has no other link is a root of its own; a self link is a cycle; a node on a
cycle or below one has root '' , depth -1 and an empty path; the descendants of a node on a
cycle are those hanging below it outside the cycle; an empty table gives empty tables; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.session import cut, partitions

GROUP_EDGES = 100_000
BATCH_ELEMENTS = 1_000_000
#: A link that is left: distance to the parent, size of what was peeled into the node, and of what was spliced out above it.
LINK_SCHEMA = "group_id string, node string, parent string, gap bigint, held bigint, passed bigint"
STATE_SCHEMA = "group_id string, node string, root string, depth int, n_descendants bigint, on_cycle boolean"
PAIR_SCHEMA = "group_id string, ancestor string, descendant string, distance int"
LISTS_SCHEMA = "group_id string, node string, above array<string>"
KEY = ["group_id", "node"]


def peel(parent: np.ndarray) -> tuple[np.ndarray, int]:
    """The peel round of each node (-1: on a cycle) and the number of rounds."""
    n = len(parent)
    waiting = np.bincount(parent[parent >= 0], minlength=n)
    rounds = np.full(n, -1, dtype=np.int64)
    leaves, r = np.flatnonzero(waiting == 0), 0
    while len(leaves):
        rounds[leaves] = r
        above = parent[leaves]
        above, sent = np.unique(above[above >= 0], return_counts=True)
        waiting[above] -= sent
        leaves, r = above[waiting[above] == 0], r + 1
    return rounds, r


def _by_round(rounds: np.ndarray, n_rounds: int) -> list[np.ndarray]:
    order = np.argsort(rounds, kind="stable")
    cuts = np.searchsorted(rounds[order], np.arange(n_rounds + 1))
    return [order[cuts[r] : cuts[r + 1]] for r in range(n_rounds)]


def resolve(parent: np.ndarray, gap: np.ndarray, held: np.ndarray, passed: np.ndarray) -> dict[str, np.ndarray]:
    """Depth, root, subtree size and cycle of all nodes, from their parents' numbers."""
    n = len(parent)
    rounds, n_rounds = peel(parent)
    peeled = _by_round(rounds, n_rounds)
    size = held.copy()
    for nodes in peeled:
        above = parent[nodes]
        send = nodes[above >= 0]
        np.add.at(size, parent[send], size[send] + passed[send])
    depth, root = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    for nodes in reversed(peeled):
        above = parent[nodes]
        top = above < 0
        up = np.where(top, 0, above)
        depth[nodes] = np.where(top, 0, np.where(depth[up] >= 0, depth[up] + gap[nodes], -1))
        root[nodes] = np.where(top, nodes, root[up])
    return {"depth": depth, "root": root, "size": size, "on_cycle": rounds < 0}


def ancestors(parent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, offsets, ancestors from the nearest on) in batches; the lists below a cycle end with its first node."""
    on_cycle = peel(parent)[0] < 0
    up = np.where(on_cycle, -1, parent)
    length = np.zeros(len(parent), dtype=np.int64)
    for nodes in reversed(_by_round(*peel(up))):
        above = up[nodes]
        length[nodes] = np.where(above < 0, 0, length[np.where(above < 0, 0, above)] + 1)
    ends = np.cumsum(length + 1)
    start = 0
    while start < len(parent):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BATCH_ELEMENTS, side="right")))
        nodes = np.arange(start, stop)
        offsets = np.concatenate(([0], np.cumsum(length[nodes])))
        flat = np.empty(offsets[-1], dtype=np.int64)
        at, cur = offsets[:-1].copy(), up[nodes]
        while len(at := at[cur >= 0]):
            cur = cur[cur >= 0]
            flat[at] = cur
            at, cur = at + 1, up[cur]
        yield nodes, offsets, flat
        start = stop


def descendants(parent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ancestor, descendant, distance), sent upwards round by round; a list is held only until it is sent on."""
    rounds, n_rounds = peel(parent)
    inbox: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(n_rounds + 1)]
    for r, nodes in enumerate(_by_round(rounds, n_rounds)):
        got = [np.concatenate(x) for x in zip(*inbox[r])] if inbox[r] else [np.empty(0, dtype=np.int64)] * 3
        inbox[r] = []
        yield tuple(got)
        sent = [np.concatenate(x) for x in zip((nodes, nodes, np.zeros(len(nodes), dtype=np.int64)), got)]
        above = parent[sent[0]]
        keep = above >= 0
        message = (above[keep], sent[1][keep], sent[2][keep] + 1)
        due = np.where(rounds[message[0]] < 0, n_rounds, rounds[message[0]])
        for k in np.unique(due):
            inbox[k].append(tuple(x[due == k] for x in message))
    if inbox[n_rounds]:
        yield tuple(np.concatenate(x) for x in zip(*inbox[n_rounds]))


class Links:
    """The links of whole groups with their nodes numbered."""

    def __init__(self, links: pd.DataFrame) -> None:
        g, groups = pd.factorize(links["group_id"])
        n = len(links)
        above = links["parent"].notna().to_numpy()
        code, names = pd.factorize(pd.concat([links["node"], links["parent"][above]], ignore_index=True))
        key = np.concatenate([g, g[above]]).astype(np.int64) * max(1, len(names)) + code
        nodes, number = np.unique(key, return_inverse=True)
        self.parent = np.full(len(nodes), -1, dtype=np.int64)
        self.parent[number[:n][above]] = number[n:]
        given = {}
        for c, default in (("gap", 1), ("held", 1), ("passed", 0)):
            given[c] = np.full(len(nodes), default, dtype=np.int64)
            if c in links:
                given[c][number[:n]] = links[c].to_numpy()
        self.given = given
        self.groups = pa.array(groups.take(nodes // max(1, len(names))), pa.string())
        self.names = pa.array(names.take(nodes % max(1, len(names))), pa.string())

    def states(self) -> Iterator[pa.RecordBatch]:
        got = resolve(self.parent, **self.given)
        root = self.names.take(pa.array(np.where(got["root"] < 0, 0, got["root"]), mask=got["root"] < 0))
        good = pa.array(got["depth"] >= 0)
        columns = [self.groups, self.names, pa.compute.if_else(good, root, ""), pa.array(got["depth"].astype(np.int32)), pa.array(got["size"] - 1), pa.array(got["on_cycle"])]
        yield pa.RecordBatch.from_arrays(columns, names=["group_id", "node", "root", "depth", "n_descendants", "on_cycle"])

    def lists(self) -> Iterator[pa.RecordBatch]:
        for nodes, offsets, flat in ancestors(self.parent):
            above = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), self.names.take(pa.array(flat)))
            yield pa.RecordBatch.from_arrays([self.groups.take(pa.array(nodes)), self.names.take(pa.array(nodes)), above], names=["group_id", "node", "above"])

    def pairs(self) -> Iterator[pa.RecordBatch]:
        for up, down, distance in descendants(self.parent):
            for k in range(0, len(up), BATCH_ELEMENTS):
                u, d = pa.array(up[k : k + BATCH_ELEMENTS]), pa.array(down[k : k + BATCH_ELEMENTS])
                columns = [self.groups.take(u), self.names.take(u), self.names.take(d), pa.array(distance[k : k + BATCH_ELEMENTS].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["group_id", "ancestor", "descendant", "distance"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by group_id, in frames that hold whole groups."""
    kept: list[pd.DataFrame] = []
    for batch in batches:
        pdf = batch.to_pandas()
        if pdf.empty:
            continue
        last = pdf["group_id"].iloc[-1]
        done = pdf["group_id"] != last
        if kept and kept[-1]["group_id"].iloc[-1] == last:
            kept.append(pdf)
            continue
        kept.append(pdf[done])
        ready = pd.concat(kept, ignore_index=True)
        if len(ready):
            yield ready
        kept = [pdf[~done]]
    if kept and len(ready := pd.concat(kept, ignore_index=True)):
        yield ready


def _in_tasks(links: DataFrame, make: Callable[[Links], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _whole_groups(batches):
            yield from make(Links(frame))

    # By a hash of its own: the planner drops a repartitioning that a join below it seems to give, and may split that one.
    return links.repartition(partitions(links), F.xxhash64("group_id")).sortWithinPartitions("group_id").mapInArrow(run, schema)


def _links(edges: DataFrame) -> DataFrame:
    edges = edges.where(F.col("group_id").isNotNull() & F.col("child").isNotNull() & F.col("parent").isNotNull())
    return edges.groupBy("group_id", F.col("child").alias("node")).agg(F.min("parent").alias("parent"), F.countDistinct("parent").alias("n_parents"))


def _fitting(links: DataFrame, group_edges: int) -> tuple[DataFrame, DataFrame | None]:
    """Links of the groups that fit a task, and of the others if there are any."""
    size = links.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    large = cut(size.where(F.col("n") > group_edges).select("group_id"))
    if large.isEmpty():
        return links, None
    return links.join(large, "group_id", "left_anti"), links.join(large, "group_id", "left_semi")


def _with_roots(links: DataFrame) -> DataFrame:
    """Links and, without a parent, the nodes that are nobody's child."""
    tops = links.select("group_id", F.col("parent").alias("node")).where("node is not null").dropDuplicates().join(links, KEY, "left_anti")
    out = links.select(*KEY, "parent").unionByName(tops.withColumn("parent", F.lit(None).cast("string")))
    return out.select("*", F.lit(1).cast("bigint").alias("gap"), F.lit(1).cast("bigint").alias("held"), F.lit(0).cast("bigint").alias("passed"))


def _round(left: DataFrame, no: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a round of peeling leaves, peels (leaves) and splices out (chain nodes)."""
    heads = lambda c: F.pmod(F.xxhash64("group_id", c, F.lit(no)), F.lit(2)) == 0
    children = left.where("parent is not null").groupBy("group_id", F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.max("node").alias("child"))
    chain = (F.col("n") == 1) & F.col("parent").isNotNull() & (F.col("parent") != F.col("node")) & (F.col("child") != F.col("node")) & heads("node") & ~heads("parent")
    known = cut(left.join(children, KEY, "left").withColumn("fate", F.when(F.col("n").isNull(), "leaf").when(chain, "chain").otherwise("stay")))
    spliced = known.where("fate = 'chain'").drop("fate", "n")
    skip = spliced.select("group_id", F.col("node").alias("parent"), F.col("parent").alias("p"), F.col("gap").alias("g"), F.col("held").alias("h"), F.col("passed").alias("q"))
    moved = known.where("fate <> 'chain'").drop("n", "child").join(skip, ["group_id", "parent"], "left")
    more = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    moved = moved.select(
        *KEY, F.coalesce("p", "parent").alias("parent"), (F.col("gap") + more("g")).alias("gap"), "held", (F.col("passed") + more("h") + more("q")).alias("passed"), F.col("passed").alias("below"), "fate",
    )
    moved = cut(moved)
    leaves = moved.where("fate = 'leaf'").drop("fate")
    sent = leaves.where("parent is not null").groupBy("group_id", F.col("parent").alias("node")).agg(F.sum(F.col("held") + F.col("passed")).alias("more"))
    stay = moved.where("fate = 'stay'").join(sent, KEY, "left")
    stay = cut(stay.select(*KEY, "parent", "gap", (F.col("held") + more("more")).alias("held"), "passed"))
    below = moved.select("group_id", F.col("node").alias("child"), "below")
    return stay, leaves.drop("below"), spliced.join(below, ["group_id", "child"])


def _states(links: DataFrame, group_edges: int) -> DataFrame:
    """Root, depth, number of descendants and cycle of every node of the links."""
    small, large = _fitting(links.select(*KEY, "parent"), group_edges)
    done = _in_tasks(small, Links.states, STATE_SCHEMA)
    if large is None:
        return done
    rounds = []
    left = cut(_with_roots(large))
    done_large: DataFrame | None = None
    while True:
        small, large = _fitting(left, group_edges)
        ended = cut(_in_tasks(small, Links.states, STATE_SCHEMA))
        done_large = ended if done_large is None else done_large.unionByName(ended)
        if large is None:
            break
        left, leaves, spliced = _round(large, len(rounds))
        rounds.append((leaves, spliced))
        loops = left.where("parent = node")
        if left.where("parent is null or parent <> node").isEmpty():
            done_large = done_large.unionByName(cut(loops.select(*KEY, F.lit("").alias("root"), F.lit(-1).alias("depth"), (F.col("held") - 1).alias("n_descendants"), F.lit(True).alias("on_cycle"))))
            break
    for leaves, spliced in reversed(rounds):
        for nodes, is_leaf in ((leaves, True), (spliced, False)):
            above = done_large.select("group_id", F.col("node").alias("parent"), F.col("root").alias("r"), F.col("depth").alias("d"))
            got = nodes.join(above, ["group_id", "parent"], "left")
            top = F.col("parent").isNull()
            root = F.when(top, F.col("node")).otherwise(F.col("r"))
            depth = F.when(top, 0).when(F.col("d") < 0, -1).otherwise(F.col("d") + F.col("gap")).cast("int")
            if is_leaf:
                size, cycle = F.col("held") - 1, F.lit(False)
            else:
                child = done_large.select("group_id", F.col("node").alias("child"), F.col("n_descendants").alias("m"), F.col("on_cycle").alias("c"))
                got = got.join(child, ["group_id", "child"])
                # The subtree of the child counts unless both lie on the cycle.
                size, cycle = F.col("held") - 1 + F.when(F.col("c"), 0).otherwise(F.col("m") + 1 + F.col("below")), F.col("c")
            done_large = done_large.unionByName(cut(got.select(*KEY, root.alias("root"), depth.alias("depth"), size.cast("bigint").alias("n_descendants"), cycle.alias("on_cycle"))))
    return done.unionByName(done_large)


def _lists(links: DataFrame, states: DataFrame, group_edges: int) -> DataFrame:
    """The ancestors of every node from the nearest on; below a cycle they end with its first node."""
    small, large = _fitting(links.select(*KEY, "parent"), group_edges)
    done = _in_tasks(small, Links.lists, LISTS_SCHEMA)
    if large is None:
        return done
    on_cycle = states.where("on_cycle").select(*KEY)
    grown = _with_roots(large).select(*KEY, F.col("parent").alias("next"))
    ringed = grown.join(on_cycle, KEY, "left_semi").withColumn("next", F.lit(None).cast("string"))
    grown = grown.join(on_cycle, KEY, "left_anti").unionByName(ringed)
    grown = cut(grown.withColumn("above", F.when(F.col("next").isNotNull(), F.array("next")).otherwise(F.array().cast("array<string>"))))
    while not grown.where("next is not null").isEmpty():
        step = grown.select("group_id", F.col("node").alias("next"), F.col("next").alias("n2"), F.col("above").alias("a2"))
        going = grown.where("next is not null").join(step, ["group_id", "next"]).select(*KEY, F.col("n2").alias("next"), F.concat("above", "a2").alias("above"))
        grown = cut(going.unionByName(grown.where("next is null")))
    return done.unionByName(grown.select(*KEY, "above"))


def _not_followed(edges: DataFrame, links: DataFrame) -> DataFrame:
    """The parents that occur in no followed link, as roots."""
    several = links.where("n_parents > 1").select("group_id", F.col("node").alias("child"))
    parents = edges.join(several, ["group_id", "child"], "left_semi").where("parent is not null").select("group_id", F.col("parent").alias("node")).dropDuplicates()
    for end in ("node", "parent"):
        parents = parents.join(links.select("group_id", F.col(end).alias("node")), KEY, "left_anti")
    return parents.select(*KEY, F.col("node").alias("root"), F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("n_descendants"), F.lit(False).alias("on_cycle"))


def hierarchy(edges: DataFrame, group_edges: int = GROUP_EDGES, all_nodes: bool = False) -> DataFrame:
    """group_id, node, root, depth, n_descendants and on_cycle of every node of the followed links of ``edges``
    (group_id, child, parent); with ``all_nodes`` of every endpoint of ``edges``."""
    links = cut(_links(edges))
    nodes = _states(links, group_edges)
    if all_nodes and not links.where("n_parents > 1").isEmpty():
        nodes = nodes.unionByName(_not_followed(edges, links))
    return nodes


def paths(edges: DataFrame, group_edges: int = GROUP_EDGES, all_nodes: bool = False) -> DataFrame:
    """``hierarchy`` with parent, n_parents and path, the nodes from the root to the node."""
    links = cut(_links(edges))
    states = cut(hierarchy(edges, group_edges, all_nodes))
    out = states.join(_lists(links, states, group_edges), KEY, "left").join(links, KEY, "left")
    path: Column = F.when(F.col("depth") < 0, F.array().cast("array<string>")).otherwise(F.concat(F.reverse(F.coalesce("above", F.array().cast("array<string>"))), F.array("node")))
    return out.select(*KEY, "parent", "root", "depth", path.alias("path"), "n_descendants", "on_cycle", F.coalesce("n_parents", F.lit(0).cast("bigint")).alias("n_parents"))


def descendant_pairs(edges: DataFrame, group_edges: int = GROUP_EDGES) -> DataFrame:
    """All (ancestor, descendant, distance) of each group."""
    links = cut(_links(edges))
    small, large = _fitting(links, group_edges)
    pairs = _in_tasks(small.select(*KEY, "parent"), Links.pairs, PAIR_SCHEMA)
    if large is None:
        return pairs
    lists = _lists(large, _states(large, group_edges), group_edges)
    far = lists.select("group_id", F.col("node").alias("descendant"), F.posexplode("above").alias("at", "ancestor"))
    return pairs.unionByName(far.select("group_id", "ancestor", "descendant", (F.col("at") + 1).cast("int").alias("distance")))

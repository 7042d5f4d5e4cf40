"""Near-duplicate vectors by NN-descent.

Equal vectors are one node. The search works on sketches (a byte a component), whose cosines
are off by a slack that is taken from the data; what it finds is verified on the vectors in double precision.

A first neighbour graph comes from stretches of the nodes in the order of the sides they lie on
of random planes. Then each round joins the neighbours of every node with one another and keeps
the best of each node's old and new neighbours, down to REACH below the threshold: a farther one
leads to no link. Points whose lists overlap are joined in one task, which gets each sketch once.
Rounds go on until they find no more pairs over the threshold and hardly change a list; an audit
against brute force, on a sample with enough true links, then decides whether a larger graph is
needed. A node whose list is full of such pairs may have more: lists like that are enlarged to
their whole component and to all other such components that a bound from centres and radii does
not keep apart, which are compared exactly in blocks. Only lists that are full can lack a link for
want of room, and a link lacks room at both its ends, so no other components need this.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, compact, table
from .components import connected_components

THRESHOLD = 0.95
#: Neighbours of a node; orders of a first graph; nodes of a stretch; rounds at most.
NEIGHBOURS, ORDERS, STRETCH, ROUNDS = 8, 4, 256, 16
#: An order is cut into parts of so many nodes, at places taken from a sample of so many nodes at most.
PART_NODES, SAMPLE_NODES = 16_384, 8192
#: More orders are taken, up to so many, until a pair at the threshold is split by all of them with this chance at most; rounds end when fewer of the entries change.
SEED_MISS, SETTLED, ORDERS_MOST = 0.1, 0.01, 64
#: Lists hold neighbours whose cosine is at most so far below the threshold.
REACH = 0.3
#: The audit: nodes of a step, the share of a node's true links that must be found on average, graphs tried at most.
AUDIT_NODES, AUDIT_RECALL, GRAPHS = 1024, 0.98, 4
#: Steps are taken until so many true links are seen, or so many nodes.
AUDIT_LINKS, AUDIT_MOST = 1000, 4096
#: Nodes of a block when a component is compared exactly; of a task when neighbours are joined; rows that one product of vectors covers.
BLOCK_NODES, TASK_NODES, _TILE = 4096, 1024, 1024
_EDGES = "src long, dst long, sim float"


def _edge_batch(src, dst, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64()), pa.array(sim, pa.float32())], ["src", "dst", "sim"])


def _rows(raw, kind: str) -> np.ndarray:
    """The vectors of a binary column, as they are."""
    if isinstance(raw, pa.ChunkedArray):
        raw = raw.combine_chunks()
    if not len(raw):
        return np.zeros((0, 1), kind)
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(raw), -1)


def _unit(raw, kind: str) -> np.ndarray:
    """Rows of unit length, in double precision, of a binary column."""
    x = _rows(raw, kind).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _near(raw) -> np.ndarray:
    """Rows of unit length of a column of sketches."""
    x = _rows(raw, "i1").astype(np.float32)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sketch(x: np.ndarray) -> np.ndarray:
    return np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype("i1")


def _binary(kind: str):
    """The vector and its sketch; null where it links with nothing. ``off``: the angle between the two."""

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(at))
            vecs, codes, offs = ([None] * len(lists) for _ in range(3))
            for size in np.unique(sizes[sizes > 0]).tolist():
                some = np.flatnonzero(sizes == size)
                x = flat[at[some][:, None] + np.arange(size)].astype(kind) + np.array(0, kind)  # nulls are nan here, -0 is 0
                y = x.astype(np.float64)
                with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                    norm = (y * y).sum(axis=1)
                ok = np.isfinite(y).all(axis=1) & np.isfinite(norm) & (norm > 0)
                some, x, y, norm = some[ok], x[ok], y[ok], norm[ok]
                code = _sketch(y)
                z = code.astype(np.float64)
                off = np.arccos(np.minimum(1.0, (y * z).sum(axis=1) / np.sqrt(norm * (z * z).sum(axis=1))))
                for k, i in enumerate(some.tolist()):
                    vecs[i], codes[i], offs[i] = x[k].tobytes(), code[k].tobytes(), off[k]
            columns = [batch.column("row_id"), batch.column("vec_id"), pa.array(vecs, pa.binary()), pa.array(codes, pa.binary()), pa.array(offs, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["row_id", "vec_id", "vec", "code", "off"])

    return run


def _places(x: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Which sides of all planes but the last the vectors lie on, as bits, and then how they lie to the last."""
    side = x @ normals.T.astype(np.float32)
    bits = (side[:, :-1] > 0) @ (1 << np.arange(len(normals) - 1, dtype=np.int64))
    return bits + np.arctan(side[:, -1].astype(np.float64)) / 3.2 + 0.5


def _project(planes: np.ndarray, cuts: np.ndarray):
    """Per order: the place of each vector, and which part of the order that is."""

    def run(batches):
        for batch in batches:
            x = _near(batch.column("code"))
            for r, (normals, cut) in enumerate(zip(planes, cuts, strict=True)):
                place = _places(x, normals)
                part = r * (len(cut) + 1) + np.searchsorted(cut, place)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(place), batch.column("node"), batch.column("code")], ["part", "place", "node", "code"])

    return run


def _pick(m: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what is at least ``least``, the k largest of a row at most (of equal ones the first)."""
    i, j = np.nonzero(m >= least)
    if len(i) and np.bincount(i).max() > k:
        order = np.lexsort((j, -m[i, j], i))
        i, j = i[order], j[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j = i[rank < k], j[rank < k]
    return i, j


def _stretches(k: int, least: float):
    """Best pairs within overlapping stretches of rows of one part of an order."""

    def run(batches):
        last = None
        for batch in batches:
            now = pa.Table.from_batches([batch.select(["part", "node", "code"])])
            full = pa.concat_tables([last, now]) if last is not None else now
            part, node = full.column("part").to_numpy(), full.column("node").to_numpy()
            x = _near(full.column("code"))
            src, dst, sim = [], [], []
            ends = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
            for lo, hi in zip(ends[:-1], ends[1:], strict=True):
                for s in range(lo, max(lo + 1, hi - STRETCH // 2), STRETCH // 2):
                    e = min(s + STRETCH, hi)
                    m = x[s:e] @ x[s:e].T
                    np.fill_diagonal(m, -2.0)
                    i, j = _pick(m, least, k)
                    if len(i):
                        src.append(node[s:e][i])
                        dst.append(node[s:e][j])
                        sim.append(m[i, j])
            last = full.slice(max(ends[-2], full.num_rows - STRETCH // 2))
            if src:
                yield _edge_batch(np.concatenate(src), np.concatenate(dst), np.concatenate(sim))

    return run


def _local_join(k: int, least: float):
    def run(lists, known):
        """The best pairs of nodes u that stand in one list (of v), of all lists of one task."""
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        src, dst, sim = [], [], []
        if lists.num_rows:
            lists = lists.sort_by([("v", "ascending"), ("u", "ascending")])
            v, u = lists.column("v").to_numpy(), lists.column("u").to_numpy()
            known = known.sort_by("w")
            x = _near(known.column("code"))
            at = np.searchsorted(known.column("w").to_numpy(), u)
            cuts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1], [True]]))
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if e - s > 1:
                    y = x[at[s:e]]
                    m = y @ y.T
                    np.fill_diagonal(m, -2.0)
                    i, j = _pick(m, least, k)
                    src.append(u[s:e][i])
                    dst.append(u[s:e][j])
                    sim.append(m[i, j])
        src, dst, sim = join(src, np.int64), join(dst, np.int64), join(sim, np.float32)
        order = np.lexsort((dst, src))  # a pair that several lists hold is told once
        src, dst, sim = src[order], dst[order], sim[order]
        new = np.flatnonzero(np.concatenate([[True], (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])])) if len(src) else np.zeros(0, np.int64)
        return pa.Table.from_batches([_edge_batch(src[new], dst[new], sim[new])])

    return run


def _verify(kind: str, threshold: float):
    def run(pairs, known):
        """Which pairs of one task are links."""
        known = known.sort_by("w")
        x, ids = _unit(known.column("vec"), kind), known.column("w").to_numpy()
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        i, j = np.searchsorted(ids, a), np.searchsorted(ids, b)
        ok = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", x[i[s : s + 65536]], x[j[s : s + 65536]]) >= threshold for s in range(0, len(a), 65536))])
        return pa.table({"a": a[ok], "b": b[ok]})

    return run


def _balls(kind: str):
    def run(key, rows):
        """Centre of the vectors of a part of a component, and the largest angle from it."""
        x = _unit(rows.column("vec"), kind)
        centre = x.mean(axis=0)
        centre = centre / np.sqrt(centre @ centre) if (centre @ centre) > 1e-12 else x[0]
        radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pa.table({"component": [key[0].as_py()], "part": pa.array([key[1].as_py()], pa.int32()), "vec": pa.array([centre.astype("<f8").tobytes()], pa.binary()), "radius": [radius]})

    return run


def _near_balls(threshold: float):
    def run(key, rows):
        """Pairs of components that can hold a link, of one pair of groups of balls."""
        i, j = key[0].as_py(), key[1].as_py()
        group, component, radius = (rows.column(c).to_numpy() for c in ("group", "component", "radius"))
        x = _unit(rows.column("vec"), "<f8")
        a, b = np.flatnonzero(group == i), np.flatnonzero(group == j)
        apart = np.arccos(np.clip(x[a] @ x[b].T, -1, 1)) - radius[a][:, None] - radius[b][None, :]
        p, q = np.nonzero((apart <= math.acos(threshold) + 1e-6) & (component[a][:, None] < component[b][None, :]))
        back_p, back_q = np.nonzero((apart <= math.acos(threshold) + 1e-6) & (component[a][:, None] > component[b][None, :]))
        return pa.table({"a": np.concatenate([component[a][p], component[b][back_q]]), "b": np.concatenate([component[b][q], component[a][back_p]])})

    return run


def _compare_blocks(kind: str, threshold: float):
    def run(key, rows):
        """Links of each node of one pair of blocks, weighted by copies; a block with itself counts each pair twice, as it should.
        Rows without a node are pairs of components with a link."""
        i, j = key[1].as_py(), key[2].as_py()
        block, node, n = rows.column("block").to_numpy(), rows.column("node").to_numpy(), rows.column("n").to_numpy().astype(np.float64)
        x = _unit(rows.column("vec"), kind)
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        comps, at = np.unique(rows.column("component").to_numpy(), return_inverse=True)
        links_a, links_b, pairs = np.zeros(len(a)), np.zeros(len(b)), [np.zeros(0, np.int64)]
        for s in range(0, len(a), _TILE):
            part = a[s : s + _TILE]
            hit = x[part] @ x[b].T >= threshold
            if len(comps) > 1:
                pairs.append(np.unique((at[part][:, None] * len(comps) + at[b][None, :])[hit]))
            if i == j:
                hit[np.arange(len(part)), np.arange(s, s + len(part))] = False
            else:
                links_b += n[part] @ hit
            links_a[s : s + _TILE] = hit @ n[b]
        joined = np.array(np.divmod(np.unique(np.concatenate(pairs)), len(comps)))
        joined = comps[joined[:, joined[0] != joined[1]]]
        ids, links = (node[a], links_a) if i == j else (np.concatenate([node[a], node[b]]), np.concatenate([links_a, links_b]))
        none = pa.nulls(joined.shape[1], pa.int64())
        side = [pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(c, pa.int64())]) for c in joined]
        return pa.table({"node": pa.concat_arrays([pa.array(ids, pa.int64()), none]), "links": pa.concat_arrays([pa.array(links.astype(np.int64)), none]), "a": side[0], "b": side[1]})

    return run


def _top(edges: DataFrame, k: int) -> DataFrame:
    best = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    w = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return best.withColumn("k", F.row_number().over(w)).where(F.col("k") <= k).drop("k")


class Audit(NamedTuple):
    """Average share of true links found (none seen: None), true links seen, nodes looked at, whether these are all."""

    recall: float | None
    links: int
    nodes: int
    whole: bool


class _Graph:
    """A neighbour graph over nodes (node, code, n) with ``vectors`` (node, vec); ``off`` is the widest angle between a vector and its sketch."""

    def __init__(self, nodes: DataFrame, vectors: DataFrame, count: int, dim: int, kind: str, threshold: float, off: float):
        self.nodes, self.vectors, self.count, self.dim, self.kind, self.threshold = nodes, vectors, count, dim, kind, threshold
        self.slack = threshold - math.cos(math.acos(min(1.0, max(-1.0, threshold))) + 2 * off) + 1e-5
        self.least = threshold - REACH
        self.edges: DataFrame | None = None
        self.entries = 0

    def _some(self, step: int, upto: int, steps: int) -> pa.Table:
        """(node, code) of the nodes whose hashes fall into these of so many steps."""
        return self.nodes.where(F.pmod(F.xxhash64("node"), F.lit(steps)).between(step, upto - 1)).select("node", "code").toArrow()

    def _keep(self, found: DataFrame, k: int) -> None:
        kept = _top(found if self.edges is None else found.unionByName(self.edges), k)
        self.edges = checkpoint(kept)
        self.entries = self.edges.count()

    def seed(self, orders: int, k: int, seed: int) -> None:
        """So many planes that their cells hold about half a stretch each."""
        planes = max(1, math.ceil(math.log2(max(self.count, 1) * 2 / STRETCH)))
        same = (1 - math.acos(min(1.0, max(-1.0, self.threshold))) / math.pi) ** planes  # a pair at the threshold in one cell
        orders = max(orders, min(ORDERS_MOST, math.ceil(math.log(SEED_MISS) / math.log1p(-same)) if same < 1 else 1)) if self.count > STRETCH else 1
        normals = np.random.default_rng(seed).standard_normal((orders, planes + 1, self.dim))
        parts = math.ceil(self.count / PART_NODES)
        cuts = np.zeros((orders, 0))
        if parts > 1:  # an order's places are not known before, nor how many vectors share one
            x = _near(self._some(0, 1, math.ceil(self.count / SAMPLE_NODES)).column("code"))
            cuts = np.stack([np.quantile(_places(x, n), np.arange(1, parts) / parts) for n in normals])
        placed = self.nodes.select("node", "code").mapInArrow(_project(normals, cuts), "part int, place double, node long, code binary")
        self._keep(placed.repartition("part").sortWithinPartitions("part", "place", "node").mapInArrow(_stretches(k, self.least), _EDGES), k)

    def _homes(self, pairs: DataFrame, v: str, u: str) -> DataFrame:
        """Add ``g`` to pairs: the task of v. Those with a smallest neighbour in common go together, too many of them in parts."""
        of = pairs.groupBy(v).agg(F.least(F.first(v), F.min(u)).alias("__key"))
        per = of.groupBy("__key").agg(F.ceil(F.count("*") / TASK_NODES).alias("__parts"))
        tasks = max(1, math.ceil(min(self.count, self.entries) / TASK_NODES))
        part = F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(v), F.col("__parts"))).otherwise(0)
        return pairs.join(of.join(per, "__key").select(v, F.pmod(F.xxhash64("__key", part), F.lit(tasks)).alias("g")), v)

    def refine(self, k: int) -> bool:
        """One round: neighbours of each node, in either direction, are joined with one another. Whether lists changed."""
        back = self.edges.select(F.col("dst").alias("v"), F.col("src").alias("u"), "sim")
        w = Window.partitionBy("v").orderBy(F.desc("sim"), "u")
        back = back.withColumn("k", F.row_number().over(w)).where(F.col("k") <= k).select("v", "u")
        around = self.edges.select(F.col("src").alias("v"), F.col("dst").alias("u")).unionByName(back).distinct()
        lists = checkpoint(compact(self._homes(around, "v", "u").select("g", "v", "u"), self.entries))
        known = lists.select(F.col("g").alias("h"), F.col("u").alias("w")).distinct().join(self.nodes.select(F.col("node").alias("w"), "code"), "w")
        found = lists.groupBy("g").cogroup(known.groupBy("h")).applyInArrow(_local_join(max(2, k // 2), self.least), _EDGES)
        old = self.edges
        self._keep(found, k)
        changed = self.edges.join(old.select("src", "dst"), ["src", "dst"], "left_anti").count()
        return changed > SETTLED * self.entries

    def near(self, slack: float = 0.0) -> DataFrame:
        """(a, b) whose sketches reach the threshold, less ``slack``."""
        found = self.edges.where(F.col("sim") >= self.threshold - slack)
        return found.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()

    def links(self) -> DataFrame:
        """The links among the graph's pairs."""
        return self.verified(self.near(self.slack), self.entries)

    def verified(self, pairs: DataFrame, n: int) -> DataFrame:
        """Which of about ``n`` pairs (a, b) are links, by their vectors."""
        pairs = checkpoint(compact(self._homes(pairs, "a", "b").select("g", "a", "b"), n))
        ends = pairs.select(F.col("g").alias("h"), F.col("a").alias("w")).unionByName(pairs.select(F.col("g").alias("h"), F.col("b").alias("w"))).distinct()
        known = ends.join(self.vectors.select(F.col("node").alias("w"), "vec"), "w")
        return checkpoint(pairs.groupBy("g").cogroup(known.groupBy("h")).applyInArrow(_verify(self.kind, self.threshold), "a long, b long"))

    def reach(self, comp: DataFrame, dense: DataFrame) -> DataFrame:
        """(component, reach) of dense components: those of one reach may hold links with each other, those of two cannot."""
        dense = checkpoint(dense)
        member = comp.join(dense, "component")
        parts = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_NODES).alias("parts"))
        dealt = member.join(parts, "component").join(self.vectors, "node").select("component", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "vec")
        balls = checkpoint(dealt.groupBy("component", "part").applyInArrow(_balls(self.kind), "component long, part int, vec binary, radius double"))
        groups = max(1, math.ceil(balls.count() / BLOCK_NODES))
        balls = balls.withColumn("group", F.pmod(F.xxhash64("component", "part"), F.lit(groups)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        balls = balls.select(F.least("group", "other").alias("i"), F.greatest("group", "other").alias("j"), "group", "component", "radius", "vec")
        near = connected_components(balls.groupBy("i", "j").applyInArrow(_near_balls(self.threshold), "a long, b long"))
        near = near.select(F.col("node").alias("component"), F.col("component").alias("reach"))
        return checkpoint(dense.join(near, "component", "left").withColumn("reach", F.coalesce("reach", "component")))

    def true_links(self) -> tuple[DataFrame, Audit]:
        """All links (q, node) of nodes chosen by their hashes, by brute force, until AUDIT_LINKS are seen; what was looked at."""
        steps, step, seen, looked, found = max(1, self.count // AUDIT_NODES), 0, 0, 0, None
        while step < steps and (step == 0 or (seen < AUDIT_LINKS and looked < AUDIT_MOST)):
            upto = min(steps, step + 1)
            sample = self._some(step, upto, steps)
            part = self.verified(self._may_link(sample), sample.num_rows).withColumnsRenamed({"a": "q", "b": "node"})
            found = part if found is None else found.unionByName(part)
            seen, looked, step = seen + part.count(), looked + sample.num_rows, upto
        return found, Audit(None, seen, looked, step >= steps)

    def _may_link(self, sample: pa.Table) -> DataFrame:
        """(a, b): what of all nodes b the sketches do not keep apart from the sample's nodes a."""
        held, least = self.nodes.sparkSession.sparkContext.broadcast((sample.column("node").to_numpy(), _near(sample.column("code")))), self.threshold - self.slack

        def run(batches):
            ids, x = held.value
            for batch in batches:
                node = batch.column("node").to_numpy()
                y = _near(batch.column("code"))
                for s in range(0, len(ids), AUDIT_NODES):
                    i, j = np.nonzero(y @ x[s : s + AUDIT_NODES].T >= least)
                    other = node[i] != ids[s + j]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[s + j][other]), pa.array(node[i][other])], ["a", "b"])

        return self.nodes.select("node", "code").mapInArrow(run, "a long, b long")


def neighbours(nodes: DataFrame, vectors: DataFrame, dim: int, kind: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame, Audit]:
    """(links, component of each linked node, dense components with their reach, audit) of nodes (node, code, off, n) with ``vectors`` (node, vec).

    Where the audit saw few true links of a larger table, graphs are added until one brings no more links.
    """
    count, off = nodes.agg(F.count("*"), F.max("off")).first()
    graph = _Graph(nodes, vectors, count, dim, kind, threshold, off or 0.0)
    (truth, audit), k, last = graph.true_links(), NEIGHBOURS, -1
    for attempt in range(GRAPHS):
        graph.seed(ORDERS, k, seed=attempt)
        before = graph.near().count()
        for _ in range(ROUNDS if graph.entries else 0):
            changed = graph.refine(k)
            now = graph.near().count()
            if now <= before and not changed:
                break
            before = now
        links = graph.links()
        now = links.count()
        comp = connected_components(links)
        full = graph.edges.groupBy("src").agg(F.count("*").alias("n"), F.min("sim").alias("worst")).where((F.col("n") >= k) & (F.col("worst") >= threshold - graph.slack))
        dense = graph.reach(comp, comp.join(full.select(F.col("src").alias("node")), "node").select("component").distinct())
        # found: a link of the graph, or both ends among components that are compared exactly with each other
        ends = truth.withColumns({"a": F.least("q", "node"), "b": F.greatest("q", "node")})
        inside = comp.join(dense, "component")
        ends = ends.join(links.withColumn("linked", F.lit(True)), ["a", "b"], "left")
        for end in ("a", "b"):
            ends = ends.join(inside.select(F.col("node").alias(end), F.col("reach").alias(f"c{end}")), end, "left")
        found = F.coalesce(F.col("linked"), F.lit(False)) | F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))
        recall = ends.groupBy("q").agg(F.avg(found.cast("double")).alias("share")).agg(F.avg("share")).first()[0]
        audit = audit._replace(recall=recall)
        low = recall is not None and recall < AUDIT_RECALL
        if not low and (audit.whole or audit.links >= AUDIT_LINKS or now <= last):
            break
        last = now
        if low:
            k *= 2
    return links, comp, dense, audit


def _joint(audits: list[Audit]) -> Audit:
    """The audits of several lengths as one: the share found of all true links that they saw."""
    told = [a for a in audits if a.recall is not None]
    seen = sum(a.links for a in told)
    recall = sum(a.recall * a.links for a in told) / seen if seen else None
    return Audit(recall, sum(a.links for a in audits), sum(a.nodes for a in audits), all(a.whole for a in audits))


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept, valid``, and the audit: ``recall`` (null: no true
    link seen) on ``audited_links`` true links.

    Vectors that are null, empty, zero, too large or small to have a norm, or hold a null or
    non-finite component link with nothing. Vectors of different lengths have no cosine; those of
    each length are searched among themselves, one length after the other, and the audit is that of all
    lengths. Rows with equal vectors are linked with each other and share all links. Repeated ids are rows of their own; a null id never names
    a component that has another id and is never kept. An empty table stays empty. Raises a
    RuntimeError where the audit finds too few of the true links after all graphs.
    """
    kind = "<f8" if "double" in vectors.schema[vector].dataType.simpleString() else "<f4"
    raw = vectors.select(F.monotonically_increasing_id().alias("row_id"), vectors[f"`{vec_id}`"].alias("vec_id"), vectors[f"`{vector}`"].alias("vector"))
    rows = table(raw.mapInArrow(_binary(kind), f"row_id long, vec_id {raw.schema['vec_id'].dataType.simpleString()}, vec binary, code binary, off double"), "vectors")
    keyed = rows.withColumn("key", F.when(F.length("vec") > 0, F.md5("vec")))
    classes = checkpoint(keyed.where("key is not null").groupBy("key").agg(F.min("row_id").alias("node"), F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first(F.length("vec")).alias("size")))
    nodes = table(rows.select(F.col("row_id").alias("node"), "code", "off").join(classes.select("node", "n", "size"), "node"), "sketches")
    known = rows.select(F.col("row_id").alias("node"), "vec")
    sizes = [r["size"] for r in classes.groupBy("size").count().where("count > 1").orderBy("size").collect()] or [0]
    found = []
    for size in sizes:
        own = (nodes, known) if len(sizes) == 1 else (nodes.where(F.col("size") == size), known.where(F.length("vec") == size))
        found.append(neighbours(own[0].where(F.col("size") == size).drop("size"), own[1], size // int(kind[-1]), kind, threshold))
    links, comp, dense = (reduce(DataFrame.unionByName, [f[k] for f in found]) for k in range(3))
    audit = _joint([f[3] for f in found])
    if audit.recall is not None and audit.recall < AUDIT_RECALL:
        raise RuntimeError(f"of the true links of {audit.nodes} nodes, {audit.links}, a share of only {audit.recall:.4f} was found; {AUDIT_RECALL} is needed")

    sparse = links.join(comp.withColumnRenamed("node", "a"), "a").join(dense, "component", "left_anti").select("a", "b")
    both = sparse.unionByName(sparse.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = classes.select(F.col("node").alias("b"), "n")
    counts = both.join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    member = comp.join(dense, "component")
    blocks = member.groupBy("reach").agg(F.ceil(F.count("*") / BLOCK_NODES).alias("blocks"))
    dealt = member.join(blocks, "reach").join(nodes.select("node", "n"), "node").join(known, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    paired = paired.select("reach", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "component", "node", "n", "vec")
    exact = checkpoint(paired.groupBy("reach", "i", "j").applyInArrow(_compare_blocks(kind, threshold), "node long, links long, a long, b long"))
    counts = counts.unionByName(exact.where("node is not null").groupBy("node").agg(F.sum("links").alias("links")))
    joined = connected_components(exact.where("node is null").select("a", "b")).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    comp = comp.join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))

    named = classes.join(comp, "node", "left").join(counts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = checkpoint(named.join(ids, "component").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    out = keyed.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.col("key").isNotNull().alias("valid"), F.lit(audit.recall).cast("double").alias("recall"), F.lit(audit.links).cast("long").alias("audited_links"))

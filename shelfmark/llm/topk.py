"""Exact top-k search by inner product over an inverted index of vectors, with MaxScore.

The terms are the dimensions: a term's postings are a column of integer weights, held in blocks
of rows that lie close together, with the least and the largest weight of every few rows. A query's
own block gives it a first threshold; then every shard of the index is searched with it, and the
shards' results are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table
from .vectors import finite_vectors, floored

SCALE, TOP = 64, 20
#: Rows of a shard, and of a block if their weights take no more than BLOCK_BYTES; rows that share one pair of bounds.
SHARD_ROWS, BLOCK_BYTES, BOUND_ROWS = 8192, 16 << 20, 256
#: Queries that one task holds against a shard, and that are searched at once.
GROUP_QUERIES, BATCH = 4096, 128
#: The non-essential terms are those of the least bounds that sum to at most this share of the threshold:
#: with more of them, probing single rows costs more than traversing a whole list.
PROBED = 0.2
STEP = 8
PLANES = 24


def _near_key(m: np.ndarray) -> np.ndarray:
    """Bits of fixed random planes' sides: vectors that lie close share the leading ones."""
    sides = m @ np.random.default_rng(7).normal(size=(m.shape[1], PLANES)) > 0
    return (sides * (1 << np.arange(PLANES)[::-1])).sum(axis=1)


def _pack(m: np.ndarray) -> bytes:
    kind = np.int32 if np.abs(m).max(initial=0) < 1 << 31 else np.int64
    return bytes([np.dtype(kind).itemsize]) + np.ascontiguousarray(m, kind).tobytes()


def _unpack(data: bytes, rows: int) -> np.ndarray:
    flat = np.frombuffer(data, np.int32 if data[0] == 4 else np.int64, offset=1)
    return flat.reshape(rows, -1) if rows and len(flat) else np.zeros((rows, 0), np.int64)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Write the index of all vectors; returns (shard, start, ids, postings, dims), one row per block.

    Left out are vectors that are null or hold nulls or non-finite entries. Rows are dealt to shards by
    range of a key of their place in space, and of their id, so that many copies of one vector spread.
    """
    clean = finite_vectors(vectors, id_col, vector_col)
    kind = clean.schema["id"].dataType.simpleString()
    shards = max(1, -(-clean.count() // SHARD_ROWS))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_near_key(floored(b.column("v"), scale)), pa.int64()), b.column("id"), b.column("v")], ["near", "id", "v"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start, held, ids = TaskContext.get().partitionId(), 0, [], []

        def block() -> pa.RecordBatch:
            dims = max(m.shape[1] for m in held)
            m = np.concatenate([np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for m in held])
            cols = [pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(m)], pa.int32()), pa.concat_arrays(ids)), pa.array([_pack(m.T)]), pa.array([dims], pa.int32())]
            return pa.RecordBatch.from_arrays(cols, ["shard", "start", "ids", "postings", "dims"])

        for b in batches:
            m = floored(b.column("v"), scale)
            rows = max(BOUND_ROWS, min(SHARD_ROWS, BLOCK_BYTES // (8 * max(1, m.shape[1]))))
            for at in range(0, len(m), rows):
                if sum(map(len, held)) + len(m[at : at + rows]) > rows and held:
                    yield block()
                    start, held, ids = start + sum(map(len, held)), [], []
                held.append(m[at : at + rows])
                ids.append(b.column("id")[at : at + rows])
        if held:
            yield block()

    near = clean.mapInArrow(keyed, f"near long, id {kind}, v array<double>").repartitionByRange(shards, "near", "id").sortWithinPartitions("near", "id")
    return table(near.select("id", "v").mapInArrow(blocks, f"shard int, start long, ids array<{kind}>, postings binary, dims int"), "postings")


def _exact_type(bound: int) -> type:
    """The fastest number type in which all sums up to ``bound`` are exact."""
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def max_score(queries: np.ndarray, postings: np.ndarray, thresholds: np.ndarray, ranks: np.ndarray, own: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the ``top`` best rows of each query that reach its threshold, ties to the smaller rank.

    ``postings``: a term's weights by row. ``own``: the row of each query itself, which is no candidate,
    or -1. Rows whose bounds lie below the threshold are skipped by the block; the others get the sum of their
    essential terms; those that can still reach the threshold are probed for the other terms, those of the
    largest bounds first, as long as they can. Sums are exact.
    """
    dims = min(queries.shape[1], postings.shape[0])
    queries, postings = queries[:, :dims], postings[:dims]
    n = postings.shape[1]
    biggest = sum(int(a) * int(b) for a, b in zip(np.abs(queries).max(axis=0, initial=0), np.abs(postings).max(axis=1, initial=0), strict=True))
    kind = _exact_type(biggest)
    lists, exact = postings.astype(kind), np.int64 if kind is not object else object
    edges = np.arange(0, n, BOUND_ROWS)
    high, low = (f.reduceat(postings, edges, axis=1) if dims else np.zeros((0, len(edges)), np.int64) for f in (np.maximum, np.minimum))
    out = []
    for first in range(0, len(queries), BATCH):
        q = queries[first : first + BATCH]
        weights, none = q.astype(kind), -biggest - 1
        floor = np.maximum(np.array(thresholds[first : first + BATCH], exact), none)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, exact))
        bound = np.maximum(0, np.maximum(q.astype(exact) * high.max(axis=1, initial=0), q.astype(exact) * low.min(axis=1, initial=0))) if n else np.zeros_like(q, exact)
        order = np.argsort(-bound, axis=1, kind="stable")
        falling = np.take_along_axis(bound, order, 1)
        rest = np.concatenate([np.cumsum(falling[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1), exact)], axis=1)  # bounds of the terms from a place on
        block_bound = np.maximum(q, 0).astype(kind) @ high.astype(kind) + np.minimum(q, 0).astype(kind) @ low.astype(kind)
        turn = np.argsort(-block_bound.max(axis=0), kind="stable")  # the most promising blocks raise thresholds first
        for s in turn:
            live = np.flatnonzero(block_bound[:, s] >= floor)
            if not len(live):
                continue
            rows = slice(edges[s], min(n, edges[s] + BOUND_ROWS))
            # the others' bounds sum to too little to reach the threshold: a row needs an essential term
            split = np.argmax(rest[live] <= np.maximum(0, floor[live] * PROBED).astype(exact)[:, None], axis=1)
            essential = np.zeros((len(live), dims), bool)
            np.put_along_axis(essential, order[live], np.arange(dims) < split[:, None], 1)
            got = (weights[live] * essential) @ lists[:, rows]
            at, row = np.nonzero(got >= (floor[live] - rest[live, split])[:, None])
            score, row = got[at, row].astype(exact), row + edges[s]
            k = split[at]
            while len(at) and (k < dims).any():
                for _ in range(STEP):
                    open_ = np.flatnonzero(k < dims)
                    term = order[live[at[open_]], k[open_]]
                    score[open_] += (weights[live[at[open_]], term] * lists[term, row[open_]]).astype(exact)
                    k[open_] += 1
                can = score + rest[live[at], k] >= floor[live[at]]
                at, row, score, k = at[can], row[can], score[can], k[can]
            at = live[at]
            ok = (score >= floor[at]) & (row != own[first + at])
            at, row, score = (np.concatenate([b, x[ok]]) for b, x in zip(best, (at, row, score), strict=True))
            by = np.lexsort((ranks[row], -score, at))
            at, row, score = at[by], row[by], score[by]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            best = tuple(x[place < top] for x in (at, row, score))
            full = place == top - 1
            floor[at[full]] = np.maximum(floor[at[full]], score[full])
        out.append((best[0] + first, *best[1:]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _ranks(ids: pa.Array) -> np.ndarray:
    """The place of each id in their order, nulls last."""
    import pyarrow.compute as pc

    out = np.empty(len(ids), np.int64)
    out[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    return out


_NONE = -(1 << 63)


def search(index: DataFrame, chosen: Callable[[Column], Column], top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of each chosen row of the index: the ``top`` highest inner products with the others.

    ``chosen`` says of an id whether its row is a query; a null id never is one. All rows but the query's own are
    candidates, so copies of it and rows that share its id are. Ties go to the smaller id, null last. With
    fewer than ``top`` candidates all have a row; an empty index gives none. Scores are exact; one that no long
    holds is an error.
    """
    kind = index.schema["ids"].dataType.elementType.simpleString()
    marked = index.withColumn("chosen", F.transform("ids", lambda i: F.coalesce(chosen(i), F.lit(False))))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                ids, start, shard = b.column("ids")[i].values, b.column("start")[i].as_py(), b.column("shard")[i].as_py()
                posts = _unpack(b.column("postings")[i].as_py(), b.column("dims")[i].as_py())
                own = np.flatnonzero(b.column("chosen")[i].values.to_numpy(zero_copy_only=False))
                if not len(own):
                    continue
                posts = posts if posts.shape[0] else np.zeros((0, len(ids)), np.int64)
                q = posts[:, own].T
                at, row, score = max_score(q, posts, np.full(len(q), _NONE, object), _ranks(ids), own, top)
                least = np.full(len(q), _NONE, object)
                last = np.flatnonzero(np.arange(len(at)) - np.searchsorted(at, at) == top - 1)
                least[at[last]] = score[last]
                base = (shard << 32) + start
                listed = lambda a, n: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), a)
                hits = (pa.array(base + own[at]), ids.take(pa.array(own[at])), pa.array(base + row), ids.take(pa.array(row)), pa.array(score, pa.int64()))
                cols = [pa.array([shard], pa.int32()), pa.array([start], pa.int64()), listed(pa.array(base + own), len(own)), listed(ids.take(pa.array(own)), len(own)), pa.array([_pack(q)]), listed(pa.array(least, pa.int64()), len(own))]
                yield pa.RecordBatch.from_arrays([*cols, *[listed(h, len(at)) for h in hits]], ["home", "home_start", "places", "query_ids", "weights", "least", *_HIT])

    listed = f"place array<long>, query_id array<{kind}>, row array<long>, vec_id array<{kind}>, score array<long>"
    slabs = table(marked.mapInArrow(home, f"home int, home_start long, places array<long>, query_ids array<{kind}>, weights binary, least array<long>, {listed}"), "queries")
    most = marked.groupBy("shard").agg(F.sum(F.size(F.filter("chosen", lambda c: c))).alias("n")).agg(F.max("n").alias("n"), F.max("shard").alias("shard")).first()
    if most["n"] is None:
        return index.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    per = max(1, GROUP_QUERIES // max(1, most["n"]))
    groups = most["shard"] // per
    left = index.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(groups))))
    right = slabs.withColumn("slab", (F.col("home") / per).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(most["shard"])))).drop(*_HIT)

    def cell(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        out = [pa.table({c: pa.array([], t) for c, t in zip(_HIT, (pa.int64(), blocks.schema.field("ids").type.value_type, pa.int64(), blocks.schema.field("ids").type.value_type, pa.int64()), strict=True)})]
        for b in blocks.to_batches():
            for i in range(len(b)):
                ids, start, shard = b.column("ids")[i].values, b.column("start")[i].as_py(), b.column("shard")[i].as_py()
                posts = _unpack(b.column("postings")[i].as_py(), b.column("dims")[i].as_py())
                posts = posts if posts.shape[0] else np.zeros((0, len(ids)), np.int64)
                ranks = _ranks(ids)
                for s in queries.to_pylist():
                    if (s["home"], s["home_start"]) == (shard, start):
                        continue  # searched at home
                    q = _unpack(s["weights"], len(s["places"]))
                    at, row, score = max_score(q, posts, np.array(s["least"], object), ranks, np.full(len(q), -1), top)
                    own = pa.array(s["query_ids"], ids.type)
                    out.append(pa.table({"place": np.array(s["places"], np.int64)[at], "query_id": own.take(pa.array(at)), "row": (shard << 32) + start + row, "vec_id": ids.take(pa.array(row)), "score": pa.array(score, pa.int64())}))
        return pa.concat_tables(out)

    flat = f"place long, query_id {kind}, row long, vec_id {kind}, score long"
    found = left.groupBy("shard", "slab").cogroup(right.groupBy("shard", "slab")).applyInArrow(cell, flat)
    homes = slabs.select(F.explode(F.arrays_zip(*_HIT)).alias("h")).select("h.*")
    best = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    merged = found.unionByName(homes).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return merged.select("query_id", "rank", "vec_id", "score")


_HIT = ["place", "query_id", "row", "vec_id", "score"]

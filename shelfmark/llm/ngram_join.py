"""Exact Jaccard self-join of documents on word shingles.

1. Documents are packed into compressed blocks of bounded size, dealt by a hash.
2. Each block tells the shards which shingles it holds (a few bytes of each shingle's hash),
   and the shards answer how many documents hold it. Only these bytes are shuffled.
3. A document's shingles are ordered from the rarest to the most frequent. Those that no
   other document holds match nothing, so its prefix is mostly empty.
4. Documents that share a prefix shingle meet in its bucket, under the length and positional
   filters. A bucket's first document is compared with all others; only buckets that still
   hold more than one component go on, with more such leaders each round. So the work of a
   group of copies grows with its size and not with its square, and no link between
   components is missed.
5. A pair passes the suffix filter or is dropped, and is verified once.
6. All links lie within components. Each component's different sets are dealt into blocks, small
   components together, and each pair of blocks counts all links between them, so that every
   document has its number of links. A set goes to as many tasks as its component has blocks.

``jaccard_join`` lists the links themselves: there each pair that the filters leave is verified, so
that a group of different near copies costs the square of its size, as its links are so many.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpoint, compact, drop_table, give_back_memory, table, text_column
from .components import connected_components
from .words import NON_SPACE, chunks, hash_words, mix, text_bytes

WIDTH, PERCENT = 5, 75
BLOCK_CHARS = 4 << 20
#: So many times more leaders in each next round: few rounds, and pairs in proportion to the rows left.
LEADER_GROWTH = 32
SHARDS = 512
#: Different sets of one component in a block when its links are counted; shingles in more pairs of a block than this are counted by a product.
LINK_BLOCK, _COMMON = 2048, 40_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle."""
    words, at = hash_words(data, offsets, NON_SPACE)
    n = np.diff(at)
    full = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        full += words[k : k + len(full)] * _ODD[k]
    full = mix(full)
    out = []
    for a, m in zip(at[:-1].tolist(), n.tolist(), strict=True):
        if m >= width:
            s = np.sort(full[a : a + m - width + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif m:
            out.append(mix((words[a : a + m] * _ODD[:m]).sum(keepdims=True) + np.uint64(m)))
        else:
            out.append(full[:0])
    return out


def _pack(batches):
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        block = batch.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        groups = [g for g in np.split(order, cuts) if len(g)]
        texts = [squeeze(np.concatenate([data[offsets[i] : offsets[i + 1]] for i in g]).tobytes()) for g in groups]
        sizes = [(offsets[g + 1] - offsets[g]) for g in groups]
        at = np.cumsum([0, *map(len, groups)]).astype(np.int32)
        flat = pa.array(order)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block[g[0]] for g in groups], pa.int32()), pa.ListArray.from_arrays(at, batch.column("row_id").take(flat)), pa.ListArray.from_arrays(at, batch.column("doc_id").take(flat)),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate(sizes) if sizes else [], pa.int64())), pa.array(texts, pa.binary())],
            ["block", "row_ids", "doc_ids", "sizes", "texts"],
        )


def _block_sets(rows: pa.Table, width: int) -> list[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    out = []
    for sizes, text in zip(rows.column("sizes"), rows.column("texts"), strict=True):
        offsets = np.concatenate([[0], np.cumsum(sizes.values.to_numpy())]).astype(np.int64)
        data = np.frombuffer(expand(text.as_py(), max_output_size=int(offsets[-1]) + 1), np.uint8)
        for i, j in chunks(offsets):
            out += shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
    return out


def _keys(sets: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - bits), return_counts=True)


def _rank_code(df: np.ndarray) -> np.ndarray:
    """A document frequency as one byte: exact up to 127, then in steps of an eighth of a doubling."""
    return np.where(df < 128, df, np.minimum(127 + 8 * np.log2(np.maximum(df, 128) / 127), 255)).astype(np.uint8)


class _Layout:
    """How shingle hashes are cut: ``bits`` leading bits are compared, of which the first choose the shard."""

    def __init__(self, shingles: int, shards: int, width: int):
        self.width, self.shard_bits = width, int(math.log2(shards))
        wanted = math.ceil(math.log2(max(shingles, 1))) + 6  # so that few shingles share their bits by chance
        self.low_bytes = max(2, math.ceil((wanted - self.shard_bits) / 8))
        self.bits = self.shard_bits + 8 * self.low_bytes

    def tell(self):
        def run(key, rows):
            keys, counts = _keys(_block_sets(rows, self.width), self.bits)
            shard = (keys >> np.uint64(8 * self.low_bytes)).astype(np.int64)
            low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.low_bytes]
            cuts = np.flatnonzero(np.diff(shard)) + 1
            at = np.concatenate([[0], cuts]) if len(keys) else np.zeros(0, int)
            end = np.append(cuts, len(keys))[: len(at)]
            seen = np.minimum(counts, 65535).astype("<u2")
            give_back_memory()
            return pa.table(
                {"shard": pa.array(shard[at], pa.int32()), "block": pa.array(np.full(len(at), key[0].as_py()), pa.int32()),
                 "keys": pa.array([low[a:b].tobytes() for a, b in zip(at, end, strict=True)], pa.binary()), "counts": pa.array([seen[a:b].tobytes() for a, b in zip(at, end, strict=True)], pa.binary())}
            )

        return run

    def answer(self):
        def run(rows):
            raw = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, self.low_bytes) for x in rows.column("keys")]
            wide = np.zeros((sum(map(len, raw)), 8), np.uint8)
            wide[:, : self.low_bytes] = np.concatenate(raw)
            counts = np.concatenate([np.frombuffer(x.as_py(), "<u2") for x in rows.column("counts")])
            _, inverse = np.unique(wide.view("<u8").ravel(), return_inverse=True)
            code = _rank_code(np.bincount(inverse, counts).astype(np.int64))[inverse]
            at = np.cumsum([0, *map(len, raw)])
            del wide, inverse
            give_back_memory()
            return pa.table({"block": rows.column("block"), "shard": rows.column("shard"), "codes": pa.array([code[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())})

        return run

    def prefixes(self, percent: int):
        def run(rows, told):
            sets = _block_sets(rows, self.width)
            keys, _ = _keys(sets, self.bits)
            told = told.sort_by("shard") if told.num_rows else told
            codes = np.frombuffer(b"".join(x.as_py() for x in told.column("codes")), np.uint8)
            assert len(codes) == len(keys), "each shingle of a block has one answer"
            out: dict[str, list] = {k: [] for k in ("n", "sig1", "sig2", "n_single", "n_prefix", "tokens")}
            for s in sets:
                n = len(s)
                code = codes[np.searchsorted(keys, s >> np.uint64(64 - self.bits))]
                shared = s[code > 1]
                single, prefix = n - len(shared), n - -(-percent * n // 100) + 1
                n_prefix = max(0, prefix - (n - len(shared))) if n else 0
                tokens = shared[np.lexsort((shared, code[code > 1]))] if n_prefix and len(shared) else shared[:0]
                with np.errstate(over="ignore"):
                    sigs = int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ _ODD[0]).sum(dtype=np.uint64))
                for k, v in zip(out, (n, sigs[0], sigs[1], single, min(n_prefix, len(tokens)), tokens.view(np.int64)), strict=True):
                    out[k].append(v)
            ids, docs = rows.column("row_ids").combine_chunks().flatten(), rows.column("doc_ids").combine_chunks().flatten()
            at = np.cumsum([0, *map(len, out["tokens"])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *out["tokens"]])
            sig = [pa.array(np.array(out[k], np.uint64).view(np.int64)) for k in ("sig1", "sig2")]
            del sets, keys, codes
            out["tokens"] = []
            give_back_memory()
            return pa.table(
                {"row_id": ids, "doc_id": docs, "n": pa.array(out["n"], pa.int64()), "sig1": sig[0], "sig2": sig[1], "n_single": pa.array(out["n_single"], pa.int32()),
                 "n_prefix": pa.array(out["n_prefix"], pa.int32()), "tokens": pa.ListArray.from_arrays(pa.array(at), pa.array(flat))}
            )

        return run


def document_sets(docs: DataFrame, doc_id: str, text: str, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: size and signature of its set; shared shingles, rarest first, and how many are its prefix."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), docs[f"`{doc_id}`"].alias("doc_id"), text_column(docs, text).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, chars // BLOCK_CHARS)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int"))
    id_type = rows.schema["doc_id"].dataType
    packed = rows.mapInArrow(_pack, f"block int, row_ids array<long>, doc_ids array<{id_type.simpleString()}>, sizes array<long>, texts binary")
    packed = packed.repartition("block")
    layout = _Layout(max(chars // 5, 1), SHARDS, width)
    told = packed.groupBy("block").applyInArrow(layout.tell(), "shard int, block int, keys binary, counts binary")
    answers = told.groupBy("shard").applyInArrow(layout.answer(), "block int, shard int, codes binary")
    schema = f"row_id long, doc_id {id_type.simpleString()}, n long, sig1 long, sig2 long, n_single int, n_prefix int, tokens array<long>"
    made = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(layout.prefixes(percent), schema)
    return table(made, "shingle-sets")


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            xs, ys = batch.column("x"), batch.column("y")
            xv, yv = (c.flatten().to_numpy(zero_copy_only=False) for c in (xs, ys))
            xo, yo = (c.offsets.to_numpy() - c.offsets[0].as_py() for c in (xs, ys))
            total = (batch.column("nx").to_numpy() + batch.column("ny").to_numpy()).tolist()
            linked = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = np.sort(xv[xo[k] : xo[k + 1]]), np.sort(yv[yo[k] : yo[k + 1]])
                need = -(-percent * total[k] // (100 + percent))
                # suffix filter: shingles can only match within the same stretch between two pivots
                pivots = y[:: max(1, len(y) // 16)]
                cx, cy = (np.diff(np.concatenate([[0], np.searchsorted(v, pivots), [len(v)]])) for v in (x, y))
                if np.minimum(cx, cy).sum() >= need:
                    both = np.concatenate([x, y])
                    both.sort()
                    linked[k] = np.count_nonzero(both[1:] == both[:-1]) >= need
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(linked)), batch.column("b").filter(pa.array(linked))], ["a", "b"])

    return run


def _prefixes(sets: DataFrame) -> DataFrame:
    prefix = sets.select("row_id", "n", F.posexplode(F.slice("tokens", 1, F.col("n_prefix"))).alias("pos", "token"), "n_single")
    return table(prefix.select("token", "row_id", "n", (F.col("pos") + F.col("n_single")).alias("pos")), "prefixes")


def _may_link(percent: int):
    """The length and positional filters of rows a and b of one bucket, each pair once."""
    need = F.ceil(F.lit(percent) * (F.col("a.n") + F.col("b.n")) / (percent + 100))
    return (
        (F.col("a.token") == F.col("b.token")) & (F.col("a.row_id") < F.col("b.row_id"))
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
        & (F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= need)
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    for end, tokens, size in (("a", "x", "nx"), ("b", "y", "ny")):
        pairs = pairs.join(sets.select(F.col("row_id").alias(end), F.col("tokens").alias(tokens), F.col("n").alias(size)), end)
    return checkpoint(pairs.mapInArrow(_verify(percent), "a long, b long"))


def link_pairs(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All links (a, b), a < b, over ``row_id`` of rows with distinct sets."""
    rows = _prefixes(sets)
    pairs = rows.alias("a").join(rows.alias("b"), _may_link(percent)).select(F.col("a.row_id").alias("a"), F.col("b.row_id").alias("b")).distinct()
    links = _verified(pairs, sets, percent)
    drop_table(rows)
    return links


def link_components(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) over ``row_id`` of rows with distinct sets: the exact components of the join's links."""
    rows = _prefixes(sets)
    tables, comp, seen, leaders_per_bucket, n = [rows], None, None, 1, rows.count()
    while True:
        cur = rows.withColumn("comp", F.col("row_id")) if comp is None else rows.join(comp.withColumnsRenamed({"node": "row_id", "component": "comp"}), "row_id", "left").withColumn("comp", F.coalesce("comp", "row_id"))
        mixed = cur.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
        cur = checkpoint(compact(cur.join(mixed, "token"), n))
        n = cur.count()
        if not n:
            break
        ranked = cur.withColumn("k", F.row_number().over(Window.partitionBy("token").orderBy("row_id", "pos")))
        leaders = checkpoint(compact(ranked.where(F.col("k") <= leaders_per_bucket).drop("k"), n))
        a, b = leaders.alias("a"), cur.alias("b")
        pairs = a.join(b, _may_link(percent) & (F.col("a.comp") != F.col("b.comp")))
        pairs = pairs.select(F.col("a.row_id").alias("a"), F.col("b.row_id").alias("b")).distinct()
        pairs = checkpoint(compact(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), n))
        seen = pairs if seen is None else seen.unionByName(pairs)
        links = _verified(pairs, sets, percent)
        if comp is not None:  # links between the components found so far
            for end in ("a", "b"):
                links = links.join(comp.withColumnsRenamed({"node": end, "component": "c"}), end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
        found = connected_components(links)
        if comp is None:
            comp = found
        else:
            up = found.select(F.col("node").alias("component"), F.col("component").alias("up"))
            old = comp.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            comp = checkpoint(compact(old.unionByName(found.join(comp, "node", "left_anti")), comp.count() + found.count()))
        rows = table(compact(cur.join(leaders.select("token", "row_id"), ["token", "row_id"], "left_anti").drop("comp"), n), "prefixes")
        tables.append(rows)
        leaders_per_bucket *= LEADER_GROWTH
    for t in tables:
        drop_table(t)
    return comp if comp is not None else sets.select(F.col("row_id").alias("node"), F.col("row_id").alias("component")).limit(0)


def _overlaps(x: tuple[np.ndarray, np.ndarray, int], y: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Sizes of the intersections of the sets of two blocks, each given as its tokens, the row of each, and its rows."""
    (tx, rx, nx), (ty, ry, ny) = ((t[o], r[o], n) for t, r, n in (x, y) for o in [np.argsort(t, kind="stable")])
    both = np.intersect1d(tx, ty)
    ax, ay = np.searchsorted(tx, both), np.searchsorted(ty, both)
    cx, cy = np.searchsorted(tx, both, "right") - ax, np.searchsorted(ty, both, "right") - ay
    out = np.zeros(nx * ny, dtype=np.int64)
    many = cx * cy > _COMMON
    common = np.flatnonzero(many)
    for s in range(0, len(common), 256):
        mx, my = np.zeros((nx, 256), np.float32), np.zeros((ny, 256), np.float32)
        for k, t in enumerate(common[s : s + 256].tolist()):
            mx[rx[ax[t] : ax[t] + cx[t]], k] = 1
            my[ry[ay[t] : ay[t] + cy[t]], k] = 1
        out += (mx @ my.T).ravel().astype(np.int64)
    ax, ay, cx, cy = ax[~many], ay[~many], cx[~many], cy[~many]
    ends = np.cumsum(cx * cy)
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 21), "right")))
        per = cx[a:b] * cy[a:b]
        k = np.repeat(np.arange(a, b), per)
        within = np.arange(len(k)) - np.repeat(np.cumsum(per) - per, per)
        i, j = rx[ax[k] + within // cy[k]], ry[ay[k] + within % cy[k]]
        out += np.bincount(i * ny + j, minlength=nx * ny)
        a = b
    return out.reshape(nx, ny)


def _count_links(percent: int):
    def run(key, rows):
        """(row_id, links) of one pair of blocks; other rows of a block count with their copies."""
        i, j = key[1].as_py(), key[2].as_py()
        part, ids, n, copies = (rows.column(c).to_numpy() for c in ("part", "row_id", "n", "copies"))
        lists = rows.column("tokens").combine_chunks()
        values, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        block = lambda some: (np.concatenate([np.zeros(0, np.int64), *(values[at[k] : at[k + 1]] for k in some.tolist())]), np.repeat(np.arange(len(some)), at[some + 1] - at[some]), len(some))
        a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
        both = _overlaps(block(a), block(b))
        linked = (100 * both >= percent * (n[a][:, None] + n[b][None, :] - both)) & (both > 0)
        if i == j:
            np.fill_diagonal(linked, False)
            out, links = ids[a], linked @ copies[b]
        else:
            out, links = np.concatenate([ids[a], ids[b]]), np.concatenate([linked @ copies[b], copies[a] @ linked])
        del both, linked
        give_back_memory()
        return pa.table({"row_id": pa.array(out, pa.int64()), "links": pa.array(links, pa.int64())})

    return run


def link_counts(sets: DataFrame, copies: DataFrame, comp: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(rep, n_other): with how many documents of other sets each set is linked. ``copies``: (rep, n_equal); ``comp``: (node, component)."""
    sizes = checkpoint(comp.groupBy("component").agg(F.count("*").alias("size")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    small = F.col("size") <= LINK_BLOCK
    shared = max(1, math.ceil(total / LINK_BLOCK) * 2)
    parts = F.ceil(F.col("size") / LINK_BLOCK).cast("int")
    member = comp.join(sizes, "component").select(
        F.col("node").alias("row_id"), F.when(small, F.pmod(F.xxhash64("component"), F.lit(shared))).otherwise(-1 - F.col("component")).alias("task"),
        F.when(small, 0).otherwise(F.pmod(F.xxhash64("node"), parts)).cast("int").alias("part"), F.when(small, 1).otherwise(parts).alias("parts"),
    )
    rows = member.join(copies.select(F.col("rep").alias("row_id"), F.col("n_equal").alias("copies")), "row_id").join(sets.select("row_id", "n", "tokens"), "row_id")
    paired = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    paired = paired.select("task", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "row_id", "n", "copies", "tokens")
    counted = paired.groupBy("task", "i", "j").applyInArrow(_count_links(percent), "row_id long, links long")
    return checkpoint(counted.groupBy(F.col("row_id").alias("rep")).agg(F.sum("links").alias("n_other")))


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links), ``n_equal``, ``n_links``.

    Words are split at white space, A-Z lower-cased. A text of fewer than ``width`` words is one
    shingle; null, empty and blank texts have none, link with nothing and are their own component.
    Repeated rows are documents of their own, with the same set and so linked; ``n_equal`` counts
    documents with the same set, ``n_links`` all other documents that this one is linked with. A null id is a document like others but never names a component
    that has another id. An empty table stays empty. Only the two named columns are read.
    Shingles are compared by 64-bit hashes.
    """
    sets, classes, reps = _distinct(docs, doc_id, text, width, percent)
    comp = checkpoint(link_components(reps, percent))
    others = link_counts(reps, classes, comp, percent)
    drop_table(reps)
    return _documents(sets, classes, comp, others)


_SIG = ["sig1", "sig2", "n"]


def _distinct(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The set of each document; classes of equal ones; of each class one set with a prefix."""
    sets = document_sets(docs, doc_id, text, width, percent)
    classes = sets.where("n > 0").groupBy(*_SIG).agg(F.min("row_id").alias("rep"), F.min("doc_id").alias("first_doc"), F.count("*").alias("n_equal"))
    classes = checkpoint(classes)
    reps = sets.where("n_prefix > 0").join(classes.select(F.col("rep").alias("row_id")), "row_id", "left_semi").select("row_id", "n", "n_single", "n_prefix", "tokens")
    return sets, classes, table(reps, "distinct-sets")


def _documents(sets: DataFrame, classes: DataFrame, comp: DataFrame, others: DataFrame) -> DataFrame:
    named = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = named.join(others, "rep", "left").withColumn("n_links", F.coalesce("n_other", F.lit(0)) + F.col("n_equal") - 1)
    ids = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = checkpoint(named.join(ids, "component").select(*_SIG, "component_id", "n_equal", "n_links"))
    out = sets.select("doc_id", *_SIG).join(named, _SIG, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("n_equal", F.lit(1)).alias("n_equal"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(links, counts): the whole join, with equal sets collapsed.

    ``links``: each pair of linked different sets once, as ``a, b`` (the smallest id of the documents
    with either set) and ``n_a, n_b`` (documents with it). ``counts``, per document: ``doc_id, n_links``,
    the other documents that it is linked with, those with the same set included. Null, empty and blank texts link with
    nothing; repeated rows are documents of their own; very long texts are compared whole; an empty table gives no rows;
    columns of other names do not matter.
    """
    sets, classes, reps = _distinct(docs, doc_id, text, width, percent)
    found = link_pairs(reps, percent)
    drop_table(reps)
    side = lambda end: classes.select(F.col("rep").alias(f"rep_{end}"), F.col("first_doc").alias(end), F.col("n_equal").alias(f"n_{end}"))
    links = checkpoint(found.withColumnsRenamed({"a": "rep_a", "b": "rep_b"}).join(side("a"), "rep_a").join(side("b"), "rep_b"))
    ends = links.select(F.col("rep_a").alias("rep"), F.col("n_b").alias("n_other")).unionAll(links.select("rep_b", "n_a"))
    others = classes.join(ends.groupBy("rep").agg(F.sum("n_other").alias("n_other")), "rep", "left").select(*_SIG, (F.coalesce("n_other", F.lit(0)) + F.col("n_equal") - 1).alias("n_links"))
    counts = sets.select("doc_id", *_SIG).join(others, _SIG, "left").select("doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return links.select("a", "b", "n_a", "n_b"), counts

"""Quality classifier: an interpolated modified Kneser-Ney model over character n-grams.

1. Documents are stored in compressed blocks of bounded size, bucketed by block, so that they are
   never shuffled.
2. Each block tells its distinct n-grams, numbered, and how often trusted texts hold each.
   Sums by n-gram are the counts of all trusted text.
3. The probability of every n-gram told is worked out by joins with the counts, from the
   shortest order to the longest.
4. The told n-grams are joined with the probabilities, shard by shard of their hash, and come
   back to their blocks by number; a block adds up what its documents hold.

Only n-grams are shuffled, texts are read twice whatever the size of the model, and the driver
sees counts of counts. Documents beyond their language's quantiles
of held-out trusted text are rejected.

Characters, not words: a document's word n-grams are nearly all different, so that joining
them would move several times the input. All code points are told apart; digits count as 0.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import checkpoint, compact, drop_table, give_back_memory, shared_dir, table, text_column

ORDER = 5
#: The lowest order falls back on equal shares of all code points.
SYMBOLS = 0x110000
#: Characters and documents of a block, in which n-grams are told once. A task holds it compressed, and one piece of it as it is.
BLOCK_CHARS, BLOCK_DOCS = 48 << 20, 100_000
#: Up to so many trusted ids are held by every task.
BROADCAST_IDS = 5_000_000
#: Documents whose perplexity lies beyond these quantiles of held-out trusted text in their language are rejected,
QUANTILES = (0.01, 0.98)
#: and by more than this in log perplexity, so that one like the trusted text at the bound stays.
MARGIN = 0.15
#: A language with fewer held-out trusted documents is held to the bounds of all of them.
LEAST_HELD_OUT = 50
#: One trusted document in so many is not trained on; the bounds are taken from these.
HELD_OUT = 5
#: Spark allows so many buckets of a table.
MOST_BUCKETS = 100_000
_BINS = 1000  # bins per unit of log perplexity
_CHUNK = 1 << 18  # characters of a piece
_EMIT, _HELD = 1 << 16, 1 << 19  # n-grams that are sent, and that are gathered before they are merged


def _symbols(texts: list[str]) -> np.ndarray:
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    cp[(cp >= 48) & (cp < 58)] = 48
    return np.maximum(cp, 1)


class BlockGrams:
    """The n-grams that end at each character of a block's texts; texts begin with empty symbols.

    Symbols that the block holds are numbered, so that an n-gram is one integer. Where there are too
    many different ones for that (blocks of Chinese, say), n-grams are numbered within each piece instead.
    """

    def __init__(self, parts: list[tuple[np.ndarray, bytes]], order: int = ORDER):
        """``parts``: (bytes of each text, compressed texts) of each piece."""
        self.parts, self.order = parts, order
        seen = np.zeros(SYMBOLS, dtype=bool)
        for part in parts:
            seen[_symbols(_texts(*part))] = True
        self.alphabet = np.concatenate([[0], np.flatnonzero(seen)])
        self.number = np.cumsum(seen, dtype=np.int32)  # of each symbol; 0 is the empty one
        self.bits = max(1, (len(self.alphabet) - 1).bit_length())
        self.whole = self.bits * order <= 63

    def pieces(self):
        """(key of the n-gram at each character, text of each, n-grams by key or None) of each piece; texts count on over pieces."""
        begun = 0
        for part in self.parts:
            texts = _texts(*part)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            symbol = self.number[_symbols(texts)].astype(np.int64)
            place = np.arange(len(symbol)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            back = lambda k: np.concatenate([np.zeros(min(k, len(symbol)), np.int64), np.where(place[k:] >= k, symbol[: max(len(symbol) - k, 0)], 0)])  # noqa: E731, B023
            key, width = back(self.order - 1), self.bits
            for k in range(self.order - 2, -1, -1):
                if width + self.bits > 63:
                    key = np.unique(key, return_inverse=True)[1]
                    width = max(1, int(key.max(initial=0)).bit_length())
                key = (key << self.bits) | back(k)
                width += self.bits
            text = np.repeat(np.arange(begun, begun + len(texts)), sizes)
            begun += len(texts)
            if self.whole:
                yield key, text, None
            else:
                _, first, key = np.unique(key, return_index=True, return_inverse=True)
                yield key, text, np.stack([back(k)[first] for k in range(self.order - 1, -1, -1)])

    def spelled(self, keys: np.ndarray) -> np.ndarray:
        """The strings of keys (of ``pieces`` without n-grams of their own)."""
        return self._strings(np.stack([(keys >> (self.bits * k)) & ((1 << self.bits) - 1) for k in range(self.order - 1, -1, -1)]))

    def _strings(self, grams: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.alphabet[grams].T.astype("<u4")).view(f"<U{self.order}").ravel()

    def told(self, trusted: np.ndarray):
        """(n-grams, how often trusted texts hold each) in the order of their numbers in the block."""
        if not self.whole:
            for key, text, grams in self.pieces():
                yield self._strings(grams), np.bincount(key[trusted[text]], minlength=grams.shape[1])
            return
        parts, held = [], 0
        for key, text, _ in self.pieces():
            mine = trusted[text]
            other = np.unique(key)
            counts = np.zeros(len(other), np.int64)
            if mine.any():
                seen, n = np.unique(key[mine], return_counts=True)
                counts[np.searchsorted(other, seen)] = n
            parts.append((other, counts))
            held += len(other)
            if held > _HELD:
                parts = [_merge(parts)]
                held = 0
        keys, counts = _merge(parts)
        for a in range(0, len(keys), _EMIT):
            yield self.spelled(keys[a : a + _EMIT]), counts[a : a + _EMIT]

    def sums(self, logs: np.ndarray) -> np.ndarray:
        """Per text the sum of ``logs``, which has one number for each n-gram of ``told``."""
        total = np.zeros(sum(len(sizes) for sizes, _ in self.parts))
        base = 0
        if self.whole:
            keys = np.zeros(0, np.int64)
            for key, _, _ in self.pieces():
                new = np.unique(key)
                at = np.minimum(np.searchsorted(keys, new), max(len(keys) - 1, 0))
                new = new[keys[at] != new] if len(keys) else new
                keys = np.sort(np.concatenate([keys, new])) if len(new) else keys
            find = _finder(keys)
        for key, text, grams in self.pieces():
            if grams is None:
                at = find(key)
            else:
                at, base = key + base, base + grams.shape[1]
            total += np.bincount(text, logs[at], len(total))
        return total


def _finder(keys: np.ndarray):
    """Where a key stands among sorted ``keys`` that hold it: most are found where their hash says."""
    bits = max(4, int(len(keys)).bit_length() + 1)
    factor, down = np.int64(-7046029254386353131), np.int64(64 - bits)
    spread = lambda k: ((k * factor) >> down) & np.int64((1 << bits) - 1)
    first = np.zeros(1 << bits, dtype=np.int32)
    first[spread(keys)] = np.arange(len(keys))

    def find(key: np.ndarray) -> np.ndarray:
        at = first[spread(key)]
        miss = np.flatnonzero(keys[at] != key)
        at[miss] = np.searchsorted(keys, key[miss])
        return at

    return find


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


def store_blocks(rows: DataFrame) -> DataFrame:
    """Write ``rows`` (text, trusted, info) as blocks: (block, infos, trusted, sizes, ends, texts). Texts are compressed
    by pieces; a piece ends before the document of the number that ``ends`` has. Drop it with ``drop_blocks``."""
    info = rows.schema["info"].dataType
    kinds = [("infos", info), ("trusted", T.BooleanType()), ("sizes", T.LongType()), ("ends", T.IntegerType()), ("texts", T.BinaryType())]
    schema = T.StructType([T.StructField(name, T.ArrayType(kind)) for name, kind in kinds])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        held, sizes, ends, texts, chars = [], [], [], [], 0

        def block():
            whole = pa.Table.from_batches(held).combine_chunks()
            columns = [*(whole.column(c).chunk(0) for c in ("info", "trusted")), pa.array(sizes, pa.int64()), pa.array(ends, pa.int32()), pa.array(texts, pa.binary())]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], schema.names)

        for batch in batches:
            column, length = batch.column("text"), np.cumsum(batch.column("n_symbols").to_numpy())
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(length, (length[a - 1] if a else 0) + _CHUNK, "right")))
                b = min(b, a + BLOCK_DOCS - len(sizes))
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in column.slice(a, b - a).to_pylist()]
                held.append(batch.slice(a, b - a).select(["info", "trusted"]))
                sizes += map(len, raw)
                ends.append(len(sizes))
                texts.append(squeeze(b"".join(raw)))
                chars += int(length[b - 1] - (length[a - 1] if a else 0))
                a = b
                if chars >= BLOCK_CHARS or len(sizes) >= BLOCK_DOCS:
                    yield block()
                    held, sizes, ends, texts, chars = [], [], [], [], 0
        if held:
            yield block()

    spark = rows.sparkSession
    rows = rows.withColumn("n_symbols", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    chars = rows.agg(F.sum("n_symbols")).first()[0] or 0
    buckets = min(MOST_BUCKETS, 8 + 2 * (chars // BLOCK_CHARS))
    name = f"text_blocks_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    made = rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())
    # the texts are compressed already; a codec would take memory of the size of a block outside the heap, for each block
    made.write.format("parquet").option("compression", "uncompressed").option("path", path).bucketBy(buckets, "block").saveAsTable(name)
    out = spark.table(name)
    out.table_name, out.table_path = name, path
    return out


def drop_blocks(blocks: DataFrame) -> None:
    blocks.sparkSession.sql(f"DROP TABLE {blocks.table_name}")
    drop_table(blocks)


def _texts(sizes: np.ndarray, packed: bytes) -> list[str]:
    data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(sizes.sum()) + 1)
    ends = np.cumsum(sizes)
    return [data[e - n : e].decode("utf-8", "surrogatepass") for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def _parts(row) -> list[tuple[np.ndarray, bytes]]:
    """The pieces of one block (sizes, ends, texts)."""
    sizes, ends = (row[c].values.to_numpy() for c in ("sizes", "ends"))
    return [(sizes[a:b], texts.as_py()) for a, b, texts in zip([0, *ends[:-1].tolist()], ends.tolist(), row["texts"].values, strict=True)]


def tell_grams(blocks: DataFrame, order: int = ORDER) -> DataFrame:
    """(block, place, gram, c): every n-gram of each block, its number there, and how often it occurs in trusted texts."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                grams = BlockGrams(_parts({c: batch.column(c)[k] for c in ("sizes", "ends", "texts")}), order)
                trusted = batch.column("trusted")[k].values.to_numpy(zero_copy_only=False).astype(bool)
                place = 0
                for strings, counts in grams.told(trusted):
                    n = len(strings)
                    arrays = [pa.array(np.full(n, batch.column("block")[k].as_py())), pa.array(np.arange(place, place + n), pa.int32()), pa.array(strings.tolist(), pa.string()), pa.array(counts, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["block", "place", "gram", "c"])
                    place += n
                del grams, trusted
                give_back_memory()

    return table(blocks.select("block", "trusted", "sizes", "ends", "texts").mapInArrow(run, "block long, place int, gram string, c long"), "told-grams")


def gram_scores(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, p) of ``counts`` (gram, c): the smoothed probability of the last symbol of each n-gram after the others.

    Lower orders count distinct left neighbours. The discounts of each order come from its
    counts of counts, and are 0 where there are none. The lowest order falls back on equal
    shares of all symbols, so that p is never 0.
    """
    n = counts.count()
    # n-grams that are only looked up have the count 0 at every order
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        shorter = levels[k + 1].groupBy(F.expr(f"substring(gram, 2, {k})").alias("gram")).agg(F.count_if(F.col("c") > 0).alias("c"))
        levels[k] = table(compact(shorter, n), f"grams-{k}")
    stats = None
    for k, level in levels.items():
        one = level.agg(F.lit(k).alias("k"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        stats = one if stats is None else stats.unionAll(one)
    discounts = {}
    for r in stats.collect():
        n1, n2, n3, n4 = r["n1"], r["n2"], r["n3"], r["n4"]
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        raw = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
        discounts[r["k"]] = [min(max(d, 0.0), float(i)) for i, d in enumerate(raw, 1)]
    below = None
    for k in range(1, order + 1):
        d1, d2, d3 = discounts[k]
        c = F.col("c")
        off = F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        before = F.expr(f"substring(gram, 1, {k - 1})")
        ctx = levels[k].where("c > 0").groupBy(before.alias("ctx")).agg(F.sum("c").alias("total"), (F.sum(off) / F.sum("c")).alias("gamma"))
        got = levels[k].withColumn("ctx", before).join(ctx, "ctx", "left")
        if below is None:
            got = got.withColumn("q", F.lit(1.0 / SYMBOLS))
        else:
            got = got.withColumn("low", F.expr(f"substring(gram, 2, {k - 1})")).join(below.withColumnRenamed("gram", "low"), "low")
        p = F.when(F.col("total").isNull(), F.col("q")).otherwise((c - off) / F.col("total") + F.col("gamma") * F.col("q"))
        got = table(compact(got.select("gram", p.alias("q")), n), f"scores-{k}")
        for done in (below, levels[k] if k < order else None):
            if done is not None:
                drop_table(done)
        below = got
    out = below.withColumnRenamed("q", "p")
    out.table_path = below.table_path
    return out


def score_documents(blocks: DataFrame, told: DataFrame, scores: DataFrame, order: int = ORDER, with_text: bool = False) -> DataFrame:
    """``info, text, n_symbols, log_p`` of every document of the blocks, by a join of the told n-grams with their scores.
    Without ``with_text`` the texts are null."""
    found = told.select("block", "place", "gram").join(scores.select("gram", F.ln("p").cast("float").alias("log_p")), "gram").select("block", "place", "log_p")
    info = blocks.schema["infos"].dataType.elementType
    schema = T.StructType([T.StructField("info", info), T.StructField("text", T.StringType()), T.StructField("n_symbols", T.LongType()), T.StructField("log_p", T.DoubleType())])

    def run(rows, answers):
        parts = _parts({c: rows.column(c)[0] for c in ("sizes", "ends", "texts")})
        logs = np.empty(answers.num_rows)
        logs[answers.column("place").to_numpy()] = answers.column("log_p").to_numpy()
        total = BlockGrams(parts, order).sums(logs)
        infos = rows.column("infos").combine_chunks().flatten()
        texts, chars = [], []
        for part in parts:
            own = _texts(*part)
            chars += map(len, own)
            if with_text:
                texts.append(pa.array(own, pa.string()))
        del logs
        give_back_memory()
        told = pa.chunked_array(texts, pa.string()) if with_text else pa.nulls(len(chars), pa.string())
        return pa.table({"info": infos, "text": told, "n_symbols": pa.array(chars, pa.int64()), "log_p": pa.array(total)})

    whole = blocks.select("block", "infos", "sizes", "ends", "texts")
    return whole.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(run, schema)


def thresholds(scored: DataFrame, quantiles: tuple[float, float] = QUANTILES, margin: float = MARGIN) -> DataFrame:
    """(lang, low, high): bounds of log perplexity from held-out trusted documents, by language; lang null holds for all others.

    Exact to 1/1000: perplexities are counted in bins, which any number of tasks can add up.
    """
    bins = scored.where("held_out and n_symbols > 0").select("lang", F.floor(F.col("log_perplexity") * _BINS).alias("bin"))
    counts = bins.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    counts = checkpoint(counts.where("lang is not null").unionAll(counts.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "bin", "n")))
    w = Window.partitionBy("lang").orderBy("bin")
    run = counts.withColumns({"upto": F.sum("n").over(w), "of": F.sum("n").over(Window.partitionBy("lang"))})
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("of"), F.col("bin")))
    found = run.groupBy("lang").agg((at(quantiles[0]) / _BINS - margin).alias("low"), ((at(quantiles[1]) + 1) / _BINS + margin).alias("high"), F.max("of").alias("of"))
    return found.where((F.col("of") >= LEAST_HELD_OUT) | F.col("lang").isNull()).select("lang", "low", "high")


def classify(
    docs: DataFrame, trusted_ids: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
    quantiles: tuple[float, float] = QUANTILES, margin: float = MARGIN, keep: tuple[str, ...] = (), with_text: bool = False,
) -> DataFrame:
    """Per document: ``doc_id, lang, trusted, held_out, n_symbols, log_perplexity, perplexity, accepted``.

    ``trusted_ids`` has one column, the ids of trusted documents; repeated and null ids there do
    not count. Null and empty texts have no perplexity and are rejected. A language with fewer than
    LEAST_HELD_OUT held-out trusted documents, or null, is held to the bounds of all trusted text;
    without any every document with text is accepted. Repeated rows are judged alike, each in a row
    of its own; very long texts are read whole, each in one task; an empty table stays empty. Only the
    named columns are read, and those of ``keep``, which come back in a struct ``kept`` (so any name
    will do); ``with_text`` returns the ``text`` too, a null one as empty.
    """
    kept = F.struct(*[docs[f"`{c}`"].alias(c) for c in keep]) if keep else F.lit(None).cast("string")
    rows = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), text_column(docs, lang).alias("lang"), text_column(docs, text).alias("text"), kept.alias("kept"))
    ids = checkpoint(trusted_ids.select(trusted_ids[trusted_ids.columns[0]].alias("doc_id")).dropna().distinct().withColumn("trusted", F.lit(True)))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    rows = rows.join(ids, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    rows = rows.withColumn("held_out", F.col("trusted") & (F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0))
    blocks = store_blocks(rows.select("text", F.expr("trusted and not held_out").alias("trusted"), F.struct("doc_id", "lang", "trusted", "held_out", "kept").alias("info")))
    told = tell_grams(blocks, order)
    counts = table(told.groupBy("gram").agg(F.sum("c").alias("c")), "gram-counts")
    scores = gram_scores(counts, order)
    drop_table(counts)
    scored = score_documents(blocks, told, scores, order, with_text)
    scored = scored.select("info.*", *["text"] * with_text, "n_symbols", "log_p")
    scored = table(scored.withColumn("log_perplexity", F.when(F.col("n_symbols") > 0, -F.col("log_p") / F.col("n_symbols"))), "perplexity")
    drop_blocks(blocks)
    for t in (told, scores):
        drop_table(t)
    bounds = checkpoint(thresholds(scored, quantiles, margin))
    own = bounds.where("lang is not null")
    own = F.broadcast(own) if bounds.count() <= 10_000 else own
    rest = bounds.where("lang is null").select(F.col("low").alias("low0"), F.col("high").alias("high0")).first()
    low, high = (F.coalesce(F.col(c), F.lit(rest[k] if rest else None).cast("double")) for k, c in enumerate(("low", "high")))
    inside = F.coalesce(F.col("log_perplexity").between(low, high), low.isNull())
    return scored.join(own, "lang", "left").select(
        "doc_id", "lang", "trusted", "held_out", "n_symbols", "log_perplexity", F.exp("log_perplexity").alias("perplexity"), ((F.col("n_symbols") > 0) & inside).alias("accepted"), *["text"] * with_text, *["kept"] * bool(keep)
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good (doc_id, quality 0/1); one that is labelled bad too is not trusted."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")

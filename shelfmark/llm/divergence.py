"""How far the sources of a language differ in their words: an audit of a corpus by single-pass indexing.

Tasks read the texts once and count words in memory; when it is full, what is there goes out as runs
sorted by term, one for each hash shard. A shard's runs are merged into frequencies, and these are streamed
once more for the terms that a source uses most and for the distances between all sources of a language.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Distinct (language, source, term) entries that a task holds before it spills; bytes of text that it splits at once.
HELD_TERMS, SLICE = 400_000, 1 << 20
LEAST_DOCUMENTS, TERM_RANKS = 30, 50
SMOOTHING, UNIT = 5, 1_000_000_000
#: Sources of a block; two blocks of a language meet in a task for each shard. Terms that it lays out at once.
BLOCK_SOURCES, CHUNK_TERMS = 128, 1024
#: Up to so many groups go to every task; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000

#: Letters a-z (A-Z become these) and everything beyond ASCII stay, all other bytes separate words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about a slice each."""
    text, at = text.translate(_WORD_BYTES), 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _run_rows(held: dict, shards: int) -> Iterator[pa.RecordBatch]:
    """What is held as one run a shard: keys (language, term) sorted by bytes, each with its documents, and with its count by source."""
    names = sorted({source for _, source in held})
    code = {source: i for i, source in enumerate(names)}
    by_lang = defaultdict(list)
    for (lang, source), pair in held.items():
        by_lang[lang].append((code[source], *pair))
    langs, terms, lang_of, shard_of, entries, base = sorted(by_lang), [], [], [], [], 0
    for k, lang in enumerate(langs):
        own = sorted(set().union(*(counts for _, counts, _ in by_lang[lang])))
        rank, seed = dict(zip(own, range(base, base + len(own)), strict=True)), crc32(lang)
        for source, counts, docs in by_lang[lang]:
            size = len(counts)
            entries.append((np.fromiter(map(rank.__getitem__, counts), np.int64, size), np.full(size, source, np.int32), np.fromiter(counts.values(), np.int64, size), np.fromiter(map(docs.__getitem__, counts), np.int64, size)))
        terms += own
        lang_of.append(np.full(len(own), k, np.int32))
        shard_of += [crc32(t, seed) % shards for t in own]
        base += len(own)
    if not terms:
        return
    key, source, n, docs = (np.concatenate(c) for c in zip(*entries, strict=True))
    lang_of, shard_of = np.concatenate(lang_of), np.array(shard_of)
    order = np.lexsort((source, key, shard_of[key]))
    key, source, n, docs = key[order], source[order], n[order], docs[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    keys, key_docs, ends = key[heads], np.add.reduceat(docs, heads), np.append(heads[1:], len(key))
    cuts = np.append(np.flatnonzero(np.diff(shard_of[keys], prepend=-1)), len(keys))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        first, last = heads[a], ends[b - 1]
        # terms hold no line feed
        cols = [pa.array([shard_of[keys[a]]], pa.int32()), pa.array([langs], pa.list_(pa.binary())), pa.array([names], pa.list_(pa.binary())), pa.array([b"\n".join([terms[k] for k in keys[a:b]])])]
        cols += [pa.array([v.tobytes()]) for v in (lang_of[keys[a:b]], key_docs[a:b], (ends[a:b] - first).astype(np.int32), source[first:last], n[first:last])]
        yield pa.RecordBatch.from_arrays(cols, _RUN)


_RUN = ["shard", "langs", "names", "terms", "lang_of", "docs", "ends", "sources", "counts"]
_RUN_SCHEMA = "shard int, langs array<binary>, names array<binary>, terms binary, lang_of binary, docs binary, ends binary, sources binary, counts binary"


def _index(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for b in batches:
            langs, sources, texts = (b.column(c).cast(pa.binary()) for c in ("lang", "source", "text"))
            for i in range(len(b)):
                key = langs[i].as_py(), sources[i].as_py()
                if key not in held:
                    # the empty term stands for the group, so that groups without any term are known
                    held[key], size = (Counter({b"": 0}), Counter()), size + 1
                counts, docs = held[key]
                before, seen = len(counts), set()
                for words in _words(texts[i].as_py()):
                    counts.update(words)
                    seen.update(words)
                docs.update(seen)
                size += len(counts) - before
                if size >= HELD_TERMS:
                    yield from _run_rows(held, shards)
                    held, size = {}, 0
        yield from _run_rows(held, shards)

    return run


class _Run:
    """A run as its merge reads it: keys in order, and what belongs to the one with a number."""

    def __init__(self, row: dict, number: int):
        self.row, self.number = row, number
        self.docs, self.counts = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["counts"], np.int64)
        self.ends, self.sources = np.frombuffer(row["ends"], np.int32), np.frombuffer(row["sources"], np.int32)

    def keys(self) -> Iterator[tuple]:
        langs = self.row["langs"]
        for k, (lang, term, docs) in enumerate(zip(np.frombuffer(self.row["lang_of"], np.int32).tolist(), self.row["terms"].split(b"\n"), self.docs.tolist(), strict=True)):
            yield langs[lang], term, docs, self.number, k

    def by_source(self, k: int) -> Iterator[tuple[bytes, int]]:
        for i in range(self.ends[k - 1] if k else 0, self.ends[k]):
            yield self.row["names"][self.sources[i]], int(self.counts[i])


def _merge(least: int):
    def run(rows: pa.Table) -> pa.Table:
        out = [[] for _ in _FREQUENCY]
        runs = [_Run({c: rows.column(c)[i].as_py() for c in _RUN}, i) for i in range(len(rows))]
        for (lang, term), same in groupby(heapq.merge(*(r.keys() for r in runs)), key=itemgetter(0, 1)):
            same = list(same)
            if term and sum(s[2] for s in same) < least:
                continue
            by_source = Counter()
            for _, _, _, number, k in same:
                for source, n in runs[number].by_source(k):
                    by_source[source] += n
            total = sum(by_source.values())
            for k, source in enumerate(sorted(by_source)):
                for col, v in zip(out, (lang, term, source, by_source[source], total, int(k == 0 and term != b"")), strict=True):
                    col.append(v)
        shard = pa.array([rows.column("shard")[0].as_py()] * len(out[0]), pa.int32())
        strings = [pa.array(c, pa.binary()).cast(pa.string()) for c in out[:3]]
        return pa.table([shard, *strings, *[pa.array(c, pa.int64()) for c in out[3:]]], names=["shard", *_FREQUENCY])

    return run


_FREQUENCY = ["lang", "term", "source", "n", "total", "first"]


def term_frequencies(docs: DataFrame, least: int = LEAST_DOCUMENTS, shards: int | None = None) -> DataFrame:
    """(shard, lang, term, source, n, total, first): how often a source has each kept term, and its language has.

    Kept are the terms in at least ``least`` documents of their language. A row with the empty term stands for
    each group of language and source. ``first`` is 1 on one row of each kept term. Shards are as many as the
    session's shuffle partitions unless told; all runs of a term meet in its shard. Words are runs of ASCII letters, in lower
    case, and of all characters beyond ASCII; null texts and names are empty; very long texts are counted whole, by slices.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = docs.select(*[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = whole.mapInArrow(_index(shards), _RUN_SCHEMA)
    return table(runs.groupBy("shard").applyInArrow(_merge(least), "shard int, lang string, term string, source string, n long, total long, first long"), "frequencies")


def _probability(n: Column, size: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + SMOOTHING) / (size + SMOOTHING * terms)), by integers; 0 without terms."""
    share = F.call_function("div", (n + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), F.nullif(size + SMOOTHING * terms, F.lit(0)).cast("decimal(20,0)"))
    return F.coalesce(share + 1, F.lit(0))


def _corrections(rows: pa.Table) -> pa.Table:
    """By pair of sources of two blocks, what the terms of one shard add to the distance that base probabilities give."""
    side = rows.column("block").to_numpy()
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    term = rows.column("term").combine_chunks().dictionary_encode()
    code, p, base = term.indices.to_numpy(), rows.column("p").to_numpy(), rows.column("base").to_numpy()
    name = np.array(rows.column("source").to_pylist(), object)
    is_term = np.array([t != "" for t in term.dictionary.to_pylist()])[code]
    members, bases, at = [], [], []
    for block in (low, high):
        own, first, where = np.unique(name[side == block].astype(str), return_index=True, return_inverse=True)
        members.append(own)
        bases.append(base[side == block][first])
        full = np.full(len(rows), -1)
        full[side == block] = where
        at.append(full)
    order = np.argsort(code, kind="stable")
    order = order[is_term[order]]
    kept, place = np.unique(code[order], return_inverse=True)
    gap = np.abs(bases[0][:, None] - bases[1][None, :])
    out = np.zeros(gap.shape, np.int64)
    for begin in range(0, len(kept), CHUNK_TERMS):
        rows_of = order[np.searchsorted(place, begin) : np.searchsorted(place, begin + CHUNK_TERMS)]
        line = np.searchsorted(kept, code[rows_of]) - begin
        a, b = (np.tile(x, (min(CHUNK_TERMS, len(kept) - begin), 1)) for x in bases)
        for m, where in ((a, at[0]), (b, at[1])):
            own = where[rows_of] >= 0
            m[line[own], where[rows_of][own]] = p[rows_of][own]
        for k in range(a.shape[1]):
            out[k] += np.abs(a[:, k : k + 1] - b).sum(axis=0)
        out -= len(a) * gap
    i, j = np.nonzero(np.ones(gap.shape, bool) if low != high else np.triu(np.ones(gap.shape, bool), 1))
    lang = pa.array([rows.column("lang")[0].as_py()] * len(i), pa.string())
    return pa.table({"lang": lang, "a": pa.array(members[0][i].tolist(), pa.string()), "b": pa.array(members[1][j].tolist(), pa.string()), "more": out[i, j], "gap": gap[i, j]})


def source_distances(rows: DataFrame, shards: int) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, both ways round.

    ``rows``: (shard, lang, term, source, p, base, terms, blocks), where ``base`` is the probability of a term that the
    source does not have. A distance is ``terms`` times the difference of the bases, and for the terms that occur a
    correction, summed by shard. Sources go by blocks, so that no task holds more than two blocks' matrix.
    """
    marks = rows.where("term = ''").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    dealt = rows.where("term <> ''").unionByName(marks).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    parts = dealt.groupBy("lang", "shard", "low", "high").applyInArrow(_corrections, "lang string, a string, b string, more long, gap long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("more").alias("more"), F.max("gap").alias("gap"))
    sums = sums.join(_small(rows.select("lang", "terms").distinct()), "lang").withColumn("value", F.col("terms") * F.col("gap") + F.col("more"))
    return sums.select("lang", "value", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("lang", "x.a", "x.b", "value")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_GROUPS else df


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS, shards: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language stands out.

    Part ``pair``: the other sources by the sum of the differences of all kept terms' smoothed probabilities, in
    units of 10**-9. Part ``term``: up to ``ranks`` terms that the source has and that are more probable in it than in its language. Ties go
    to the smaller item by bytes. A language whose terms are all rare has distances of 0 and no terms; one with a single
    source has no pairs; repeated documents count each; no documents give no rows. Arithmetic is exact
    for counts that fit a long.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = term_frequencies(docs, least, shards)
    langs = counted.groupBy("lang").agg(F.sum("n").alias("lang_size"), F.sum("first").alias("terms"), F.ceil(F.sum((F.col("term") == "").cast("long")) / BLOCK_SOURCES).alias("blocks"))
    groups = counted.groupBy("lang", "source").agg(F.sum("n").alias("size")).join(_small(langs), "lang")
    groups = table(groups.withColumn("base", _probability(F.lit(0), F.col("size"), F.col("terms"))), "groups")
    rows = counted.join(_small(groups), ["lang", "source"]).withColumn("p", _probability(F.col("n"), F.col("size"), F.col("terms")))
    told = rows.where("term <> '' and n > 0").withColumn("value", F.col("p") - _probability(F.col("total"), F.col("lang_size"), F.col("terms"))).where("value > 0")
    parts = told.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    pairs = source_distances(rows.select("shard", "lang", "term", "source", "p", "base", "terms", "blocks"), shards)
    parts = parts.unionByName(pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    few, all_ = (parts.where(F.col("part") == p).withColumn("rank", F.row_number().over(best)) for p in ("term", "pair"))
    return few.where(F.col("rank") <= ranks).unionByName(all_)

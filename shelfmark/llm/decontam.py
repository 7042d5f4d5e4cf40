"""Benchmark decontamination over a distributed positional inverted index.

The index is divided by documents: each row holds one document's postings (its terms, and
for each the sorted list of its positions), so that storing and searching it moves no
postings between machines. A search takes phrases in blocks of bounded size to all of the
index: for each phrase, the lists of its terms are shifted by the term's place in the
phrase and intersected, beginning with the term that is rarest in the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, table, text_column
from .words import ALNUM, chunks, hash_words, text_bytes

WINDOW = 10
#: Phrases that one pass over the index searches for; more go in further passes.
BLOCK_PHRASES = 100_000
#: Up to so many terms the index can be restricted to a vocabulary that tasks hold (8 bytes each).
VOCABULARY_TERMS = 1_000_000
_STEP = 1 << 21  # candidates that are intersected at a time
_SLICE_WORDS = 1 << 19  # words of the documents that are searched at a time
_INDEX = "row_id long, doc_id {}, n_words long, terms array<long>, counts array<int>, positions array<int>"


def _tokenize(batches):
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j in chunks(offsets):
            h, at = hash_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM)
            words = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(i, j - i), words], ["item_id", "words"])


def phrases(items: DataFrame, item_id: str, text: str, width: int = WINDOW) -> DataFrame:
    """The distinct (phrase, item_id) of all items; a phrase is ``width`` consecutive words, as hashes.

    An item of fewer words is one phrase; one without words (or null) has none. Item ids are
    strings, a null one is empty.
    """
    rows = items.select(F.coalesce(text_column(items, item_id), F.lit("")).alias("item_id"), text_column(items, text).alias("text"))
    words = rows.mapInArrow(_tokenize, "item_id string, words array<long>").where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, width))).alias("phrase")).distinct()


def build_index(docs: DataFrame, doc_id: str, text: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """Store the postings of all documents as a table in the shared folder.

    One row per document, repeated ids included (``row_id`` tells them apart); null and empty
    texts have no postings. With a ``vocabulary`` (one column of word hashes), only its
    terms' postings are stored, which changes no answer to phrases made of them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), docs[f"`{doc_id}`"].alias("doc_id"), text_column(docs, text).alias("text"))
    known = None
    if vocabulary is not None and vocabulary.count() <= VOCABULARY_TERMS:
        known = spark.sparkContext.broadcast(np.unique(vocabulary.toArrow().column(0).to_numpy().view(np.uint64)))

    def postings(batches):
        vocab = known.value if known else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in chunks(offsets):
                h, at = hash_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM)
                n_words = np.diff(at)
                doc = np.repeat(np.arange(j - i), n_words)
                pos = np.arange(len(h)) - np.repeat(at[:-1], n_words)
                terms = np.unique(h) if vocab is None else vocab
                t = np.minimum(np.searchsorted(terms, h), max(len(terms) - 1, 0))
                keep = terms[t] == h if len(terms) else np.zeros(len(h), bool)
                doc, pos, t = doc[keep], pos[keep], t[keep]
                order = np.lexsort((pos, t, doc)) if j - i > 1 << 14 or len(h) > 1 << 26 or len(terms) > 1 << 24 else None
                if order is None:  # the three numbers fit one integer, which sorts faster
                    packed = np.sort((doc.astype(np.uint64) << np.uint64(50)) | (t.astype(np.uint64) << np.uint64(26)) | pos.astype(np.uint64))
                    doc, t, pos = packed >> np.uint64(50), (packed >> np.uint64(26)) & np.uint64((1 << 24) - 1), packed & np.uint64((1 << 26) - 1)
                else:
                    doc, t, pos = doc[order], t[order], pos[order]
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])]) if len(doc) else np.zeros(0, np.int64)
                lists = np.searchsorted(doc[new], np.arange(j - i + 1, dtype=doc.dtype))
                arrays = [
                    batch.column("row_id").slice(i, j - i),
                    batch.column("doc_id").slice(i, j - i),
                    pa.array(n_words, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(terms[t[new].astype(np.int64)].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(np.diff(np.append(new, len(doc))), pa.int32())),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(j - i + 1, dtype=doc.dtype)), pa.int32()), pa.array(pos, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["row_id", "doc_id", "n_words", "terms", "counts", "positions"])

    return table(rows.mapInArrow(postings, _INDEX.format(rows.schema["doc_id"].dataType.simpleString())), "postings")


class _Block:
    """A bounded set of phrases, ready to be intersected: rarest terms first."""

    def __init__(self, phrase_lists: list, items: list, frequency: dict[int, int]):
        distinct = {}
        owner = [distinct.setdefault(tuple(p), len(distinct)) for p in phrase_lists]
        order = np.argsort(owner, kind="stable")
        self.items = np.array(items, dtype=object)[order]
        self.item_at = np.searchsorted(np.array(owner)[order], np.arange(len(distinct) + 1))
        self.width = max(map(len, distinct))
        self.terms = np.unique(np.array([t for p in distinct for t in p], dtype=np.int64))
        self.length = np.array([len(p) for p in distinct])
        self.phrase = np.full((len(distinct), self.width), -1, dtype=np.int64)
        for k, p in enumerate(distinct):
            self.phrase[k, : len(p)] = np.searchsorted(self.terms, p)
        seen = np.array([frequency.get(int(t), 0) for t in self.terms])
        rarity = np.where(self.phrase >= 0, seen[self.phrase], np.iinfo(np.int64).max)
        self.order = np.argsort(rarity, axis=1, kind="stable")
        anchor = self.phrase[np.arange(len(distinct)), self.order[:, 0]]
        self.by_anchor = np.argsort(anchor, kind="stable")
        self.anchor_at = np.searchsorted(anchor[self.by_anchor], np.arange(len(self.terms) + 1))

    def search(self, doc: np.ndarray, term: np.ndarray, pos: np.ndarray, n_words: np.ndarray, slop: int):
        """Yield (kind, document, phrase, start) of the matches in postings (document, term, position)."""
        base = np.cumsum(np.append(0, n_words))
        spot = np.full(base[-1] + 1, -2, dtype=np.int32)  # which term's list holds the position
        spot[base[doc] + pos] = term
        per = np.diff(self.anchor_at)[term]
        doc, term, pos, per = doc[per > 0], term[per > 0], pos[per > 0], per[per > 0]
        ends = np.cumsum(per)
        a = 0
        while a < len(per):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _STEP, "right")))
            k = per[a:b]
            within = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            w = self.by_anchor[np.repeat(self.anchor_at[term[a:b]], k) + within]
            d = np.repeat(doc[a:b], k)
            start = np.repeat(pos[a:b], k) - self.order[w, 0]
            yield from self._intersect(d, w, start, spot, base, n_words, slop)
            a = b

    def _intersect(self, d, w, start, spot, base, n_words, slop):
        fits = (start >= 0) & (start + self.length[w] <= n_words[d])
        x, y, s = d[fits], w[fits], start[fits]
        for k in range(1, self.width):
            j = self.order[y, k]
            want = self.phrase[y, j]
            ok = (want < 0) | (spot[base[x] + np.minimum(s + j, n_words[x] - 1)] == want)
            x, y, s = x[ok], y[ok], s[ok]
        yield "exact", x, y, s
        if slop:
            x, y, s = d, w, start
            for k in range(1, self.width):
                j = self.order[y, k]
                want = self.phrase[y, j]
                ok = want < 0
                for shift in range(-slop, slop + 1):
                    p = s + j + shift
                    ok |= (p >= 0) & (p < n_words[x]) & (spot[base[x] + np.clip(p, 0, np.maximum(n_words[x] - 1, 0))] == want)
                x, y, s = x[ok], y[ok], s[ok]
            yield "near", x, y, s


_HITS = "row_id long, spans array<struct<start:int,end:int>>, items array<string>, near_items array<string>"


def _hits(block, slop: int):
    def run(batches):
        b = block.value
        for whole, i, j in ((w, i, j) for w in batches for i, j in chunks(np.cumsum(np.append(0, w.column("n_words").to_numpy())), _SLICE_WORDS)):
            batch = whole.slice(i, j - i)
            n = batch.num_rows
            n_words = batch.column("n_words").to_numpy(zero_copy_only=False)
            flat = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "counts", "positions")}
            lists = np.diff(batch.column("terms").offsets.to_numpy())
            term = np.minimum(np.searchsorted(b.terms, flat["terms"]), len(b.terms) - 1)
            known = b.terms[term] == flat["terms"]
            keep = np.repeat(known, flat["counts"])
            doc = np.repeat(np.repeat(np.arange(n), lists), flat["counts"])[keep]
            term = np.repeat(term, flat["counts"])[keep]
            found: dict[int, tuple[list, set, set]] = {}
            for kind, x, y, s in b.search(doc, term, flat["positions"][keep], n_words, slop):
                e = s + b.length[y]
                for d, w, p, q in zip(x.tolist(), y.tolist(), s.tolist(), e.tolist(), strict=True):
                    spans, items, near = found.setdefault(d, ([], set(), set()))
                    if kind == "exact":
                        spans.append((p, q))
                        items.update(b.items[b.item_at[w] : b.item_at[w + 1]])
                    else:
                        near.update(b.items[b.item_at[w] : b.item_at[w + 1]])
            if found:
                at = sorted(found)
                ids = batch.column("row_id").to_numpy()
                spans = [[{"start": p, "end": q} for p, q in sorted(set(found[d][0]))] for d in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array([sorted(found[d][1]) for d in at], pa.list_(pa.string())), pa.array([sorted(found[d][2]) for d in at], pa.list_(pa.string()))],
                    ["row_id", "spans", "items", "near_items"],
                )

    return run


def search(index: DataFrame, wanted: DataFrame, slop: int = 0, block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """Exact and near matches of phrases in an index of ``build_index``.

    ``wanted``: (phrase, item_id) of ``phrases``. Returns the index's rows as ``row_id, doc_id,
    n_words, spans, items, near_items``: the word ranges of exact matches (they may overlap),
    the items that have one, and, if ``slop`` > 0, the items with a phrase each of whose words
    stands at most ``slop`` words from its place. Documents without a match have empty arrays.
    """
    spark = index.sparkSession
    wanted = checkpoint(wanted.select("phrase", "item_id"))
    blocks = -(-wanted.count() // block_phrases)
    frequency = checkpoint(index.select(F.explode("terms").alias("term")).groupBy("term").count()) if blocks else None
    hits = None
    for k in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("phrase", "item_id"), F.lit(blocks)) == k)
        got = part.toArrow().to_pydict()
        if not got["phrase"]:
            continue
        terms = part.select(F.explode("phrase").alias("term")).distinct()
        seen = frequency.join(terms, "term", "left_semi").toArrow().to_pydict()
        block = spark.sparkContext.broadcast(_Block(got["phrase"], got["item_id"], dict(zip(seen["term"], seen["count"], strict=True))))
        # stored at once, so that neither the driver nor a task holds more than one block
        found = table(index.select("row_id", "n_words", "terms", "counts", "positions").mapInArrow(_hits(block, slop), _HITS), "hits")
        block.destroy()
        hits = found if hits is None else hits.unionByName(found)
    rows = index.select("row_id", "doc_id", "n_words")
    if hits is None:
        hits = spark.createDataFrame([], _HITS)
    merged = hits.groupBy("row_id").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near_items")])
    out = rows.join(merged, "row_id", "left")
    strings = F.array().cast("array<string>")
    return out.select(
        "row_id", "doc_id", "n_words",
        F.coalesce(F.array_sort("spans"), F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce(F.array_sort(F.array_distinct("items")), strings).alias("items"),
        F.coalesce(F.array_sort(F.array_distinct("near_items")), strings).alias("near_items"),
    )


def covered(spans: Column) -> Column:
    """How many words sorted spans cover, overlaps counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("last"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["last"]), F.lit(0))).alias("n"), F.greatest(a["last"], s["end"]).alias("last")
    )
    return F.aggregate(spans, zero, step, lambda a: a["n"])


def find_contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", width: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` (words inside matched phrases), the ``items``, ``contaminated``.

    Null and empty texts have no words; repeated rows each get a row; without items nothing
    is contaminated; an empty table stays empty; very long texts are indexed and searched whole. Only the named columns are read, so others
    may have any name.
    """
    wanted = checkpoint(phrases(items, item_id, "text", width))
    vocabulary = wanted.select(F.explode("phrase").alias("term")).distinct()
    found = search(build_index(docs, doc_id, text, vocabulary), wanted, slop)
    return found.withColumn("n_hit", covered(F.col("spans"))).withColumn("contaminated", F.col("n_hit") > 0)

"""A stored inverted index over record texts: segments of postings, bucketed and sorted by term.

A posting list is cut into blocks of neighbouring records, so that no term is gathered whole. Record numbers
within a block and word positions rise, and the files keep them as differences, and the sorted terms by what
each adds to the one before (Parquet's delta encodings). A lookup reads the buckets of its terms only. New
records are a new segment, and records that come again supersede what earlier segments hold of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.sources import tables

#: Records of a block; buckets of a segment. The usual constants of the ranking.
BLOCK_RECORDS, BUCKETS = 4096, 64
#: Bytes of text that a task inverts at once (a longer text alone), and records that share a file of a bucket.
CUT_BYTES, FILE_RECORDS = 4 << 20, 1 << 16
K1, B = 1.2, 0.75
#: Up to so many superseded records go to every task of a lookup; more are joined by a shuffle.
BROADCAST_RECORDS = 1_000_000
NAME = "segments"
DELTA_CODED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"}
_INTS = pa.list_(pa.int32())
_INVERTED = {"number": pa.int64(), "record_id": pa.string(), "length": pa.int64(), "term": pa.string(), "block": pa.int64(), "at": _INTS, "ends": _INTS, "places": _INTS}
_INVERTED_DDL = "number long, record_id string, length long, term string, block long, at array<int>, ends array<int>, places array<int>"


def words(text: Column) -> Column:
    """A word is a run of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _spaced(text: Column) -> Column:
    """The words of ``words`` with one space between them, and perhaps one before and after."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")


def _rows(n: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(n, t) for c, t in _INVERTED.items()], list(_INVERTED))


def _cuts(numbers: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of records of one block each, of CUT_BYTES of text if they are more than one."""
    first, held = 0, 0
    for k, (block, n) in enumerate(zip((numbers // BLOCK_RECORDS).tolist(), size.tolist(), strict=True)):
        if k > first and (block != numbers[first] // BLOCK_RECORDS or held + n > CUT_BYTES):
            yield first, k
            first, held = k, 0
        held += n
    if first < len(numbers):
        yield first, len(numbers)


def _lists(numbers: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    """A row for each term of records of one block, none of them without words: the records and, up to each one's end, its places."""
    held = pc.split_pattern(texts, " ")
    lengths, flat = pc.list_value_length(held).to_numpy(), held.flatten().dictionary_encode()
    codes, total = flat.indices.to_numpy(), len(flat)
    order = np.argsort(codes, kind="stable")  # by term, within it by record and place
    record = np.repeat(np.arange(len(lengths)), lengths)
    place = (np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths))[order]
    code, record = codes[order], record[order]
    pair = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (record[1:] != record[:-1])])
    term = np.flatnonzero(np.r_[True, code[pair][1:] != code[pair][:-1]])
    firsts, block = pair[term], int(numbers[0]) // BLOCK_RECORDS
    ends = np.r_[pair[1:], total] - np.repeat(firsts, np.diff(np.r_[term, len(pair)]))
    ints = lambda offsets, end, values: pa.ListArray.from_arrays(pa.array(np.r_[offsets, end], pa.int32()), pa.array(values, pa.int32()))
    at = ints(term, len(pair), numbers[record[pair]] - block * BLOCK_RECORDS)
    return _rows(len(term), term=flat.dictionary, block=pa.repeat(pa.scalar(block, pa.int64()), len(term)), at=at, ends=ints(term, len(pair), ends), places=ints(firsts, total, place))


def _invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, record_id, spaced words) as rows of records with their lengths, and rows of terms."""
    for batch in batches:
        numbers = batch.column("number").to_numpy()
        size = pc.binary_length(batch.column("t")).to_numpy()
        for first, last in _cuts(numbers, size):
            texts = pc.utf8_trim(batch.column("t").slice(first, last - first), characters=" ")
            some = pc.not_equal(texts, "")
            length = pc.if_else(some, pc.add(pc.count_substring(texts, " "), 1), 0).cast(pa.int64())
            yield _rows(last - first, number=batch.column("number").slice(first, last - first), record_id=batch.column("record_id").slice(first, last - first), length=length)
            if pc.any(some).as_py():
                yield _lists(numbers[first:last][some.to_numpy(zero_copy_only=False)], texts.filter(some))


def _back(places: Column, by: int) -> Column:
    return F.transform(places, lambda x: x - by)


class TextIndex:
    """The index below ``root``; every lookup sees the segments that were whole when it was asked."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets

    def segments(self) -> int:
        return int(tables.current_version(self.spark, self.root, NAME) or 0)

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def add(self, texts: DataFrame) -> int:
        """Add records (record_id, searchable_text) as a segment; returns its number. Null texts have no words; a null id is no record.

        Of rows that share an id one counts, the greatest text. The segment is seen once it is whole: what a run that
        stopped has left is written over.
        """
        n = self.segments()
        base = f"{self.root}/{NAME}/s={n}"
        one = texts.where("record_id is not null").groupBy("record_id").agg(F.max(F.coalesce("searchable_text", F.lit(""))).alias("t"))
        numbered = one.select(F.monotonically_increasing_id().alias("number"), "record_id", _spaced(F.col("t")).alias("t"))
        numbered.mapInArrow(_invert, _INVERTED_DDL).write.mode("overwrite").parquet(f"{base}/kind=inverted")
        inverted = self.spark.read.schema(_INVERTED_DDL).parquet(f"{base}/kind=inverted")
        stored, lists = inverted.where("record_id is not null"), inverted.where("term is not null")
        stored.select("number", "record_id", "length").write.mode("overwrite").parquet(f"{base}/kind=records")
        rows = lists.select("term", "block", F.size("at").alias("n_records"), "at", "ends", "places", self._bucket(F.col("term")).alias("bucket"))
        files = stored.count() // FILE_RECORDS + 1  # a bucket's files, and with them the tasks, follow the records
        dealt = rows.repartition("bucket", F.pmod(F.xxhash64("block"), F.lit(files)))
        dealt.sortWithinPartitions("bucket", "term", "block").write.mode("overwrite").options(**DELTA_CODED).partitionBy("bucket").parquet(f"{base}/kind=postings")
        old = self._records(n)
        again = old.join(stored.select("record_id"), "record_id", "left_semi").select(F.col("s").alias("of"), "number") if old is not None else self.spark.createDataFrame([], "of int, number long")
        again.write.mode("overwrite").parquet(f"{base}/kind=superseded")
        tables.point_to(self.spark, self.root, NAME, str(n + 1))
        return n

    def _part(self, kind: str, n: int) -> DataFrame:
        """All segments' rows of a kind, with the segment's number ``s``."""
        return self.spark.read.option("basePath", f"{self.root}/{NAME}").parquet(*[f"{self.root}/{NAME}/s={k}/kind={kind}" for k in range(n)]).drop("kind")

    def _live(self, rows: DataFrame, n: int) -> DataFrame:
        gone = self._part("superseded", n).select(F.col("of").alias("s"), "number")
        return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_RECORDS else gone, ["s", "number"], "left_anti")

    def _records(self, n: int) -> DataFrame | None:
        return self._live(self._part("records", n), n) if n else None

    def postings(self, terms: list[str]) -> DataFrame:
        """(term, s, number, places array<int>) of live records; the scan reads the buckets of these terms only."""
        n, wanted = self.segments(), sorted({t.lower() for t in terms})
        if not n or not wanted:
            return self.spark.createDataFrame([], "term string, s int, number long, places array<int>")
        asked = self.spark.createDataFrame([(t,) for t in wanted], "term string")
        buckets = [r[0] for r in asked.select(self._bucket(F.col("term"))).distinct().collect()]
        rows = self._part("postings", n).where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted))
        since = lambda i: F.coalesce(F.get("ends", i - 1), F.lit(0))
        own = F.transform("at", lambda at, i: F.struct(at.alias("at"), F.slice("places", since(i) + 1, F.get("ends", i) - since(i)).alias("places")))
        each = rows.select("term", "s", "block", F.explode(own).alias("x"))
        return self._live(each.select("term", "s", (F.col("block") * BLOCK_RECORDS + F.col("x.at")).alias("number"), F.col("x.places").alias("places")), n)

    def search(self, terms: list[str]) -> DataFrame:
        """(record_id, score) of records that hold all terms: by how often a term occurs, how rare it is and how long the record is."""
        wanted, n = sorted({t.lower() for t in terms}), self.segments()
        none = self.spark.createDataFrame([], "record_id string, score double")
        if not n or not wanted:
            return none
        records = self._records(n)
        total = records.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
        found = self.postings(wanted).select("term", "s", "number", F.size("places").cast("double").alias("tf"))
        held = {r["term"]: r["df"] for r in found.groupBy("term").agg(F.count("*").alias("df")).collect()}  # a row for each asked term
        if len(held) < len(wanted):
            return none
        tf = {t: f"tf{k}" for k, t in enumerate(wanted)}
        per = found.groupBy("s", "number").agg(*[F.max(F.when(F.col("term") == t, F.col("tf"))).alias(c) for t, c in tf.items()]).dropna(subset=list(tf.values()))
        norm = K1 * (1 - B + B * F.col("length") / F.lit(total["mean"]))
        score = F.lit(0.0)
        for t in wanted:
            score = score + log(1 + (total["n"] - held[t] + 0.5) / (held[t] + 0.5)) * F.col(tf[t]) * (K1 + 1) / (F.col(tf[t]) + norm)
        return per.join(records, ["s", "number"]).select("record_id", F.round(score, 6).alias("score"))

    def phrase(self, phrase: str) -> DataFrame:
        """(record_id, n): records in which the words of the phrase follow one another, and how often."""
        asked = [r[0] for r in self.spark.createDataFrame([(phrase,)], "t string").select(F.explode(words(F.col("t")))).collect()]
        hits, n = self.postings(asked), self.segments()
        if not n or not asked:
            return self.spark.createDataFrame([], "record_id string, n long")
        per = hits.groupBy("s", "number").agg(F.map_from_entries(F.collect_list(F.struct("term", "places"))).alias("p")).where(F.size("p") == len(set(asked)))
        starts = F.col("p")[asked[0]]
        for k, w in enumerate(asked[1:], 1):
            starts = F.array_intersect(starts, _back(F.col("p")[w], k))
        return per.select("s", "number", F.size(starts).cast("long").alias("n")).where("n > 0").join(self._records(n), ["s", "number"]).select("record_id", "n")


def best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` best of a search with their ``rank`` from 1."""
    ranked = found.orderBy(F.desc("score"), "record_id").limit(top)
    return ranked.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "record_id")))

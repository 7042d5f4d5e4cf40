"""The inventory as a stream: micro-batches of changes against the known files, which grow with each.

State is not operator state but a section of a snapshot store: each batch commits the rows that it
changes, with its own number, as one version. A batch that is run again after a failure finds its number
there, or does its work once more from the version before.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions.ids import is_set
from shelfmark.functions.text import is_day, iso_week
from shelfmark.operators import inventory, rollups, segments
from shelfmark.sources.snapshots import BUCKETS, Change, SnapshotStore

KNOWN_SCHEMA = "seq long, file_id string, name string, parent_ids_sorted string, md5 string, size long, modified_time string, sha256 string"
STREAM, KNOWN = "inventory", "known"


def process_batch(files: DataFrame, known: DataFrame, limit_mb: int = 500, known_files: DataFrame | None = None) -> DataFrame:
    """The report of one batch: change types, routes, hashes of ``text`` where content counts, duplicates.

    ``known_files``: those of the known rows that can belong to the batch's files, if the caller can tell.
    """
    routed = inventory.route_for_hashing(inventory.classify_changes(files, known if known_files is None else known_files), limit_mb)
    settled = routed.where("status is not null").withColumn("duplicate_of", F.lit(""))
    hashed = routed.where("status is null").withColumn("sha256", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)).drop("status")
    done = inventory.dedupe_by_hash(hashed, known)
    return done.unionByName(settled.select(done.columns))


def run_inventory(changes: DataFrame, root: str, checkpoint: str, limit_mb: int = 500, prepare=None, buckets: int = BUCKETS, keep: int = 2, available_now: bool = True):
    """Process all changes that a stream has, in micro-batches, and stop. Reports go to ``root/report``, known files to the store ``root/known``.

    ``prepare`` makes file rows of what is read. Starting it again goes on after the last batch that was
    committed. What a batch writes are its report and the known rows that it changes; the known files of other buckets than its
    files' are read for their hashes only. Sources that cannot say how much is there are drained by ``available_now=False``.
    """

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        store = SnapshotStore(session, f"{root}/known")
        before = store.snapshot()
        if before.applied(STREAM) >= number:
            return  # committed, and then the stream stopped before it could note so
        rows = prepare(batch) if prepare else batch
        known = before.read(KNOWN, KNOWN_SCHEMA)
        own = before.read(KNOWN, buckets=before.buckets_of(KNOWN, rows)) if KNOWN in before.sections else None
        path = f"{root}/report/batch={number}"
        process_batch(rows, known, limit_mb, own).drop("text").write.mode("overwrite").parquet(path)
        fresh, gone = inventory.known_changes(session.read.parquet(path))
        change = Change(before)
        if KNOWN in before.sections:
            change.upsert(KNOWN, fresh.select(known.columns), gone)
        else:
            change.put(KNOWN, fresh.select(known.columns), "file_id", buckets)
        change.mark(STREAM, number)
        change.commit()
        if number % 16 == 15:
            store.vacuum(keep)

    writer = changes.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    else:
        query = writer.start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return query


def stream_inventory(spark: SparkSession, source: str, schema: StructType, root: str, checkpoint: str, fmt: str = "parquet", max_files: int = 1, limit_mb: int = 500, prepare=None, buckets: int = BUCKETS):
    """``run_inventory`` over the files of a folder, ``max_files`` of them in a batch."""
    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(source)
    return run_inventory(stream, root, checkpoint, limit_mb, prepare, buckets)


def read_known(spark: SparkSession, root: str) -> DataFrame:
    return SnapshotStore(spark, f"{root}/known").snapshot().read(KNOWN, KNOWN_SCHEMA)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("basePath", f"{root}/report").parquet(f"{root}/report")


def stream_daily_counts(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Counts by day and type of a stream of (ts, event_type, value), late rows up to ``delay`` included."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def stream_expiring_counts(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Counts by day and type of a stream of (event_id, ts, event_type, value), each event once, for the append mode.

    A day comes out once the stream is ``delay`` past its end, and its state goes then; an event's repetitions are left out as
    long as they come within ``delay``. Rows that are later than that are dropped: ``late_rows`` tells how many.
    """
    once = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return once.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def late_rows(query) -> int:
    """Rows that a query's operators have dropped as too late, over the progress that it still knows."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])


DAYS, WEEKS, ROLLED = "days", "weeks", "records"


def _dates_of(weeks: list[str]) -> list[str]:
    """The days of ISO weeks like 2024-W05."""
    return [date.fromisocalendar(int(w[:4]), int(w[6:]), d).isoformat() for w in weeks for d in range(1, 8)]


def stream_daily(spark: SparkSession, source: str, schema: StructType, root: str, checkpoint: str, as_of: str, max_files: int = 1, buckets: int = BUCKETS):
    """Keep daily and weekly rollups of all records that are there, in micro-batches, and stop.

    Records lie in ``root/records`` by day and batch; rollups are sections of the store ``root/rollups``. A batch reads
    the records of the days that it touches and the names in those of their weeks, and writes its records and the rows of these
    days and weeks; days and weeks come to one version together. A day's row has what does not grow with its records; the lists
    that name them are the records themselves, to which a reader goes for them, up to the batch of its version. A batch that is run again writes its records
    over and commits once, so nothing counts twice. A batch's days are told to the driver: as many as it has folders.
    """

    def one(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        store = SnapshotStore(session, f"{root}/rollups")
        before = store.snapshot()
        if before.applied(ROLLED) >= number:
            return
        dated = batch.where(is_set("event_date")).withColumns({"__day": F.col("event_date"), "__batch": F.lit(number)})
        dated.repartition("__day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__day", "__batch").parquet(f"{root}/records")
        touched = [r[0] for r in dated.select("__day").distinct().collect()]
        change = Change(before)
        if touched:
            records = _records(session, root, batch.schema, number)
            _upsert(change, DAYS, rollups.day_totals(records.where(F.col("__day").isin(touched)), as_of), "date", buckets)
            days = change.after.read(DAYS, buckets=change.after.buckets_of(DAYS, session.createDataFrame([(d,) for d in touched], "date string")))
            weeks = [r[0] for r in days.where(F.col("date").isin(touched) & is_day(F.col("date"))).select(iso_week(F.col("date"))).distinct().collect()]
            if weeks:
                dates = _dates_of(weeks)
                whole = change.after.read(DAYS, buckets=change.after.buckets_of(DAYS, session.createDataFrame([(d,) for d in dates], "date string")))
                _upsert(change, WEEKS, rollups.weekly_memory(whole.where(F.col("date").isin(dates)), records.where(F.col("__day").isin(dates))), "week", buckets)
        change.mark(ROLLED, number)
        change.commit()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _records(spark: SparkSession, root: str, schema: StructType, number: int) -> DataFrame:
    """The records of the batches up to ``number``, with the day that their folder tells."""
    kept = StructType(schema.fields).add("__day", "string").add("__batch", "long")
    return spark.read.schema(kept).parquet(f"{root}/records").where(F.col("__batch") <= number)


def _upsert(change: Change, section: str, rows: DataFrame, key: str, buckets: int) -> None:
    if section in change.after.sections:
        change.upsert(section, rows)
    else:
        change.put(section, rows, key, buckets)


def read_daily(spark: SparkSession, root: str) -> DataFrame:
    """The daily rows with their lists, as ``rollups.daily_memory`` has them."""
    now = SnapshotStore(spark, f"{root}/rollups").snapshot()
    schema = spark.read.parquet(f"{root}/records").drop("__day", "__batch").schema
    return segments.with_lists(now.read(DAYS), _records(spark, root, schema, now.applied(ROLLED)))


def read_weekly(spark: SparkSession, root: str) -> DataFrame:
    return SnapshotStore(spark, f"{root}/rollups").snapshot().read(WEEKS)

"""Long lists as numbered segments of bounded size, so that no key's list has to fit into a row or a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.ids import first_set, is_set, text
from shelfmark.functions.session import shared_dir

from .rollups import FAMILIES, NAMED, day_names

SEGMENT = 10_000
#: So many values of a list are gathered at once before a day's row is put together.
RUN = 1_024


def list_segments(rows: DataFrame, keys: list[str], order: list[str], value: str, size: int = SEGMENT) -> DataFrame:
    """(keys, segment, first, values): each key's values in the order of ``order``, cut into lists of ``size``.

    ``first`` is the place of a segment's first value, from 0. Rows are sorted by ranges of keys and order, so that a hot
    key spreads over many tasks; a row's place is its place in its range and the number of its key's rows in
    the ranges before. Rows that agree in keys and order have any order among themselves. Nulls sort first; no rows give no segments.
    """
    shared_dir(rows.sparkSession)
    columns = list(dict.fromkeys([*keys, *order, value]))
    ranged = rows.select(*columns).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = ranged.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__at", 33)).checkpoint()
    runs = placed.groupBy(*keys, "__part").agg(F.min("__at").alias("__begin"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("__part").alias("__in"), F.col("__begin"), before.alias("__before"), *[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(keys)])
    same = F.col("__part") == F.col("__in")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}"))
    ranked = placed.join(runs, same).select(*[f"`{c}`" for c in columns], (F.col("__at") - F.col("__begin") + F.col("__before")).alias("__rank"))
    cut = ranked.groupBy(*keys, F.floor(F.col("__rank") / size).alias("segment")).agg(F.array_sort(F.collect_list(F.struct("__rank", F.col(f"`{value}`").alias("v")))).alias("x"))
    return cut.select(*keys, "segment", (F.col("segment") * size).alias("first"), F.transform("x", lambda e: e["v"]).alias("values"))


def list_runs(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, run, values): each key's values in the order of ``order`` as lists of at most ``RUN``; ``run`` grows in that order, with gaps.

    As ``list_segments``, but without places, which need all ranges to be counted first.
    """
    columns = list(dict.fromkeys([*keys, *order, value]))
    ranged = rows.select(*columns).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__at", F.monotonically_increasing_id())
    cut = ranged.groupBy(*keys, F.expr(f"__at div {RUN}").alias("run")).agg(F.array_sort(F.collect_list(F.struct("__at", F.col(f"`{value}`").alias("v")))).alias("x"))
    return cut.select(*keys, "run", F.transform("x", lambda e: e["v"]).alias("values"))


def daily_entries(records: DataFrame) -> DataFrame:
    """(date, list, seq, value): what the lists of ``daily_memory`` hold; names are distinct and have no ``seq``."""
    rows = records.where(is_set("event_date"))
    kind = text("record_type")
    tests = {**{name: kind.contains(word) for name, word in FAMILIES.items()}, "llm_activity": kind.startswith("llm_"), "record_ids": F.lit(True), "media_refs": is_set("url")}
    told = F.explode(F.array_compact(F.array(*[F.when(test, F.struct(F.lit(name).alias("list"), F.col("url" if name == "media_refs" else "record_id").alias("value"))) for name, test in tests.items()])))
    in_order = rows.select(F.col("event_date").alias("date"), "seq", told.alias("t")).select("date", "t.list", "seq", "t.value")
    return in_order.unionByName(day_names(records, NAMED).select("date", "list", F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"), "value"))


def daily_segments(records: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(date, list, segment, first, values): the lists of ``daily_memory`` as segments, for days with more records than a row should hold.

    Lists of records and links are in record order, lists of names are distinct and sorted.
    """
    return list_segments(daily_entries(records), ["date", "list"], ["seq", "value"], "value", size)


def with_lists(days: DataFrame, records: DataFrame) -> DataFrame:
    """The rows of ``daily_memory`` from those of ``day_totals`` and the days' records.

    Values are sorted by ranges and gathered into runs, so that a task has the single values of few runs in memory; the task that
    makes a day's row gets its runs. Each row is as large as the day's lists, which only readers who want them whole should ask for.
    """
    runs = list_runs(daily_entries(records), ["date", "list"], ["seq", "value"], "value")
    rows = runs.unionByName(days, allowMissingColumns=True)
    whole = lambda name: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("list") == name, F.struct("run", "values")))), lambda x: x["values"])).alias(name)
    lists = ["people", "places", "apps", *FAMILIES, "llm_activity", "media_refs", "source_ids", "record_ids"]
    told = lambda *names: [F.first(c, True).alias(c) for c in names]
    return rows.groupBy("date").agg(*told("title", "summary", "key_events"), *map(whole, lists), *told("importance_score", "review_due"))


def entity_segments(child: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(entity_id, segment, first, values): the distinct sources of an entity, sorted, from (entity_id, source_id)."""
    return list_segments(child.select("entity_id", "source_id").distinct(), ["entity_id"], ["source_id"], "source_id", size)


def duplicate_segments(report: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(sha256, original_file_id, segment, first, values): the duplicates of each original, sorted."""
    dup = report.where(F.col("status").startswith("DUPLICATE")).select("sha256", first_set("duplicate_of").alias("original_file_id"), "file_id").distinct()
    return list_segments(dup, ["sha256", "original_file_id"], ["file_id"], "file_id", size)

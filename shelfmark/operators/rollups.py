"""Daily and weekly rollups of records.

Every list of a day is made distinct before it is gathered, and the top titles are ranked
before they are, so that a day with very many records gathers only what it shows, except for
the lists that by contract name all its records. What is kept and read in parts has them apart: ``day_totals``
are a day's short columns, ``segments.with_lists`` adds its lists, and weeks need the former and ``day_names``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions.ids import first_set, is_set, text
from shelfmark.functions.text import is_day, iso_week, review_due

TOP_TITLES, TOP_NAMES, HIGHLIGHTS = 15, 5, 10
#: List of a day: how its record types are told.
FAMILIES = {"purchases": "purchase", "subscriptions": "subscription", "tasks": "task", "calendar_events": "calendar", "messages": "message"}
#: Lists of a day's distinct names, and the columns that hold them.
NAMED = {"people": "people", "places": "places", "apps": "apps", "source_ids": "source_id"}


def _decimal(score: Column, missing: float) -> Column:
    """Sums of decimals do not depend on the order of rows."""
    return F.coalesce(score, F.lit(missing)).cast("decimal(18,6)")


def top_titles(records: DataFrame, n: int = TOP_TITLES) -> DataFrame:
    """(event_date, key_events): distinct titles by importance, then by record order."""
    titled = records.select("event_date", first_set("compact_title", "title").alias("t"), F.coalesce("importance_score", F.lit(0.5)).alias("s"), "seq").where("t <> '' and event_date <> ''")
    best = titled.groupBy("event_date", "t").agg(F.min(F.struct((-F.col("s")).alias("s"), "seq")).alias("o"))
    ranked = best.withColumn("k", F.row_number().over(Window.partitionBy("event_date").orderBy("o"))).where(F.col("k") <= n)
    return ranked.groupBy("event_date").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]).alias("key_events"))


def _names(records: DataFrame, column: str) -> Column:
    """The distinct names of a group, sorted; equal lists of names are met once."""
    if records.schema[column].dataType.typeName() != "array":
        return F.array_sort(F.collect_set(column))
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_compact(column)))))


def _totals() -> list[Column]:
    return [F.count("*").alias("n"), F.round(F.sum(_decimal(F.col("importance_score"), 0.0)), 3).cast("double").alias("importance_score")]


def _heading(day: Column) -> list[Column]:
    return [day.alias("date"), F.concat(F.lit("Daily Memory "), day).alias("title"), F.concat(F.col("n").cast("string"), F.lit(" records on "), day).alias("summary")]


def day_totals(records: DataFrame, as_of: str) -> DataFrame:
    """The columns of ``daily_memory`` that do not grow with a day's records, and the number ``n`` of these."""
    rows = records.where(is_set("event_date"))
    day = F.col("event_date")
    main = rows.groupBy("event_date").agg(*_totals()).join(top_titles(rows), "event_date", "left")
    return main.select(*_heading(day), "n", F.coalesce("key_events", F.array().cast("array<string>")).alias("key_events"), "importance_score", review_due(day, as_of).alias("review_due"))


def day_names(records: DataFrame, lists: dict[str, str]) -> DataFrame:
    """(date, list, value): the distinct names of each day; ``lists`` tells the column that a list is made of."""
    rows, out = records.where(is_set("event_date")), None
    for name, column in lists.items():
        value = F.explode(column) if records.schema[column].dataType.typeName() == "array" else F.col(column)
        told = rows.select(F.col("event_date").alias("date"), value.alias("value")).select("date", F.lit(name).alias("list"), F.col("value").cast("string").alias("value"))
        out = told if out is None else out.unionByName(told)
    return out.where("value is not null").distinct()


def daily_memory(records: DataFrame, as_of: str) -> DataFrame:
    """One row per event date; records without a date are left out. ``seq`` orders the lists of records."""
    rows = records.where(is_set("event_date"))
    in_order = lambda test: F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("seq", "record_id")))), lambda x: x["record_id"])
    kind = text("record_type")
    main = rows.groupBy("event_date").agg(
        *_totals(),
        *[in_order(kind.contains(word)).alias(name) for name, word in FAMILIES.items()],
        in_order(kind.startswith("llm_")).alias("llm_activity"),
        F.transform(F.array_sort(F.collect_list(F.when(is_set("url"), F.struct("seq", "url")))), lambda x: x["url"]).alias("media_refs"),
        in_order(F.lit(True)).alias("record_ids"),
        *[_names(rows, column).alias(name) for name, column in NAMED.items()],
    )
    main = main.join(top_titles(rows), "event_date", "left")
    empty = F.array().cast("array<string>")
    day = F.col("event_date")
    return main.select(
        *_heading(day),
        *[F.coalesce(c, empty).alias(c) for c in ("key_events", "people", "places", "apps", *FAMILIES, "llm_activity", "media_refs", "source_ids", "record_ids")],
        "importance_score",
        review_due(day, as_of).alias("review_due"),
    )


def _top_names(flat: DataFrame, name: str) -> DataFrame:
    """The names x that most days mention; ties go to the one met first, by day and then by place."""
    per = flat.groupBy("week", "x").agg(F.count("*").alias("n"), F.min(F.struct("date", "pos")).alias("first"))
    ranked = per.withColumn("k", F.row_number().over(Window.partitionBy("week").orderBy(F.desc("n"), "first"))).where(F.col("k") <= TOP_NAMES)
    return ranked.groupBy("week").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda v: v["x"]).alias(name))


def weekly_memory(daily: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """One row per ISO week of the daily rows; dates that are no days are left out.

    With the ``records`` of the same days, ``daily`` need only have the columns of ``day_totals``.
    """
    days = daily.where(is_day(F.col("date"))).withColumn("week", iso_week(F.col("date")))
    listed = F.array_sort(F.collect_list(F.struct("date", "key_events")))
    main = days.groupBy("week").agg(
        F.array_sort(F.collect_list("date")).alias("days_covered"),
        F.count("*").alias("day_count"),
        F.sum(F.size("record_ids") if records is None else "n").alias("total_records"),
        F.round(F.sum(F.col("importance_score").cast("decimal(18,6)")), 2).cast("double").alias("total_importance"),
        F.slice(F.array_distinct(F.flatten(F.transform(listed, lambda x: x["key_events"]))), 1, HIGHLIGHTS).alias("weekly_highlights"),
    )
    for column in ("people", "apps"):
        if records is None:
            flat = days.select("week", "date", F.posexplode(column).alias("pos", "x"))
        else:  # a day's names are sorted, so that a name is its own place
            flat = day_names(records, {column: NAMED[column]}).where(is_day(F.col("date"))).select(iso_week(F.col("date")).alias("week"), "date", F.col("value").alias("pos"), F.col("value").alias("x"))
        main = main.join(_top_names(flat, f"top_{column}"), "week", "left")
    empty = F.array().cast("array<string>")
    return main.select("week", "days_covered", "day_count", "total_records", "total_importance", F.coalesce("top_people", empty).alias("top_people"), F.coalesce("top_apps", empty).alias("top_apps"), "weekly_highlights", F.col("days_covered").alias("daily_memory_ids"))


def refresh_days(daily: DataFrame, records: DataFrame, touched: DataFrame, as_of: str) -> DataFrame:
    """The daily rows after records changed: only ``touched`` dates are rebuilt, from all of their records.

    Equal to a full rebuild; dates that have no records any more go.
    """
    days = touched.select(F.col(touched.columns[0]).alias("event_date")).distinct()
    rebuilt = daily_memory(records.join(days, "event_date", "left_semi"), as_of)
    return daily.join(days.withColumnRenamed("event_date", "date"), "date", "left_anti").unionByName(rebuilt)

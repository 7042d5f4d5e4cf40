"""Statistics and quality reports over the indices and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import is_set, text

# The parser families that are looked for in source paths.
FAMILIES = ("chatgpt", "claude", "gemini", "whatsapp", "telegram", "instagram")


def source_stats(sources: DataFrame) -> DataFrame:
    """One row: counts of sources by what they are and how they were parsed."""
    count = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    generic = text("parser_name").startswith("generic_")
    return sources.agg(
        F.count("*").alias("total"),
        count(text("source_system") == "llm").alias("llm"),
        count(is_set("parse_error")).alias("errors"),
        count(is_set("parse_warning")).alias("warnings"),
        count(text("mime").startswith("image/")).alias("images"),
        count(text("sensitivity") == "high").alias("high_sensitivity"),
        count(generic).alias("generic_parser"),
        count(~generic).alias("dedicated_parser"),
        count(text("notes").startswith("event_only")).alias("event_only"),
        count(F.col("is_archive") & (F.coalesce("record_count", F.lit(0)) <= 1)).alias("shallow_archives"),
    )


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(text(column).alias(column)).agg(F.count("*").alias("n"))


def record_stats(records: DataFrame) -> DataFrame:
    """(record_type, n, first_date, last_date) per type, and for all in the row whose type is null."""
    dated = F.when(is_set("event_date"), F.col("event_date"))
    grouped = records.groupingSets([["record_type"], []], "record_type")
    return grouped.agg(F.count("*").alias("n"), F.min(dated).alias("first_date"), F.max(dated).alias("last_date"))


def missing_parser_families(sources: DataFrame, families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """(family): named in a path whose parser is of another name."""
    names = F.explode(F.filter(F.array(*map(F.lit, families)), lambda f: F.lower(text("source_path")).contains(f) & ~text("parser_name").contains(f)))
    return sources.select(names.alias("family")).distinct()


def quality_report(sources: DataFrame) -> DataFrame:
    return sources.select("source_id", "parser_name", "parser_version", "parser_status", "record_count", "entity_count", "relation_count", "parse_error", "parse_warning")


def run_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id", "phase").agg(F.sum("files_processed").alias("files_processed"), F.sum("errors").alias("errors"))


def source_summary(records: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(source_id, record_count, entity_count, relation_count); the inputs have a ``source_id`` each."""
    parts = [df.groupBy("source_id").agg(F.count("*").alias(n)) for df, n in ((records, "record_count"), (entities, "entity_count"), (relations, "relation_count"))]
    out = parts[0].join(parts[1], "source_id", "full").join(parts[2], "source_id", "full")
    return out.select("source_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("record_count", "entity_count", "relation_count")])


def profile_fragments(records: DataFrame) -> DataFrame:
    """(source_id, apps, topics), each distinct and sorted."""
    def names(column):
        return records.select("source_id", F.explode(column).alias("x")).groupBy("source_id").agg(F.array_sort(F.collect_set("x")).alias(column))

    ids = records.select("source_id").distinct()
    out = ids.join(names("apps"), "source_id", "left").join(names("topics"), "source_id", "left")
    return out.select("source_id", *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("apps", "topics")])


def compact_log(log: DataFrame, n: int = 500, order: str = "seq") -> DataFrame:
    """The newest ``n`` rows."""
    return log.orderBy(F.desc(order)).limit(n)

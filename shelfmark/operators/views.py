"""Search views over the record index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import first_set, text

#: Sorts after all ids, for records without an entity.
LAST = "ÿ"
FULLTEXT_CHARS, FULLTEXT_LEAST = 2000, 20


def base_view(records: DataFrame) -> DataFrame:
    return records.select(
        F.concat(F.lit("search::"), "record_id").alias("search_id"),
        text("event_date").alias("primary_date"),
        *[text(c).alias(c) for c in ("compact_title", "compact_summary", "record_type", "source_system", "source_service", "source_app")],
        *[F.coalesce(c, F.array().cast("array<string>")).alias(n) for c, n in (("people", "related_people"), ("places", "related_places"), ("apps", "related_apps"), ("topics", "related_topics"), ("related_entity_ids", "related_entities"))],
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("importance_score", "confidence")],
        F.array(text("source_id")).alias("source_ids"),
        F.array("record_id").alias("record_ids"),
        text("url").alias("deep_link_hint"),
        text("raw_ref").alias("source_path"),
    )


SORT_KEYS = {
    "by_date": lambda: F.col("primary_date"),
    "by_entity": lambda: F.coalesce(F.get("related_entities", F.lit(0)), F.lit(LAST)),
    "by_service": lambda: F.col("source_service"),
    "by_topic": lambda: F.array_join("related_topics", "|"),
}


def sorted_view(base: DataFrame, name: str) -> DataFrame:
    """One of the sorted views, with ``sort_key``; ranges include the id, so that a hot key is split."""
    return base.withColumn("sort_key", SORT_KEYS[name]()).orderBy("sort_key", "search_id")


def llm_view(base: DataFrame) -> DataFrame:
    return base.where(F.col("record_type").startswith("llm_"))


def fulltext_view(records: DataFrame, max_chars: int | None = FULLTEXT_CHARS) -> DataFrame:
    """Lower-cased text of records that have at least 20 characters; ``max_chars`` is the view's own contract, None is
    the whole text, as an index needs it."""
    whole = first_set("normalized_text", "raw_text")
    cut = whole if max_chars is None else F.substring(whole, 1, max_chars)
    return records.withColumn("__t", cut).where(F.length("__t") >= FULLTEXT_LEAST).select(
        F.concat(F.lit("ft::"), "record_id").alias("search_id"), "record_id", text("source_id").alias("source_id"), text("event_date").alias("primary_date"), text("record_type").alias("record_type"), F.lower("__t").alias("searchable_text"), text("title").alias("title"), text("source_app").alias("source_app")
    )


def search_views(records: DataFrame) -> dict[str, DataFrame]:
    base = base_view(records)
    return {"all": base, "fulltext": fulltext_view(records), **{n: sorted_view(base, n) for n in SORT_KEYS}, "llm_conversations": llm_view(base)}


def search_fulltext(view: DataFrame, terms: list[str]) -> DataFrame:
    """Rows that hold all terms, as a scan with ``contains`` would find them."""
    out = view
    for t in terms:
        out = out.where(F.col("searchable_text").contains(t.lower()))
    return out


def inverted_index(view: DataFrame) -> DataFrame:
    """(term, record_id, n): how often each word occurs in each record; a word is a run of letters and digits."""
    words = F.regexp_extract_all("searchable_text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return view.select("record_id", F.explode(words).alias("term")).groupBy("term", "record_id").agg(F.count("*").alias("n"))


def lookup(index: DataFrame, terms: list[str]) -> DataFrame:
    """(record_id, score) of records that hold all the words, by how often."""
    wanted = sorted({t.lower() for t in terms})
    hits = index.where(F.col("term").isin(*wanted)).groupBy("record_id").agg(F.count("*").alias("found"), F.sum("n").alias("score"))
    return hits.where(F.col("found") == len(wanted)).select("record_id", "score")

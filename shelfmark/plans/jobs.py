"""Queries of export jobs' less common ways: the default record, the JSON form of calendars, what a job itself adds to entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import graph, stats
from shelfmark.plans.bindings import INGESTED, PROJECT, chat_exports, event_records, read
from shelfmark.plans.catalog import _ENT, _EV, _RELATIONS, _events_by_user, _export, _records_of, query
from shelfmark.sources import exports, rules


@query(f"""SELECT 'notebooklm-' || event_id AS file_id, 'notebooklm_artifacts' AS parser_name, 'llm_artifact_reference' AS record_type, 'default' AS subtype, CASE WHEN event_id % 3 > 0 THEN 'About ' || event_type ELSE 'notebooklm-' || event_id || '.json' END AS title,
    CASE WHEN event_id % 4 > 0 THEN props ELSE '' END AS summary, event_time_start, CASE event_id % 5 WHEN 0 THEN '2020-02-02' WHEN 1 THEN substr(began, 1, 10) ELSE substr(event_time_start, 1, 10) END AS event_date,
    CASE WHEN event_id % 2 = 0 THEN 'P1,P2' ELSE '' END AS people, '' AS places, '' AS apps, event_type AS topics, 'n' || event_id AS external_id, '' AS url, 'active' AS status, CAST(0.8 AS DOUBLE) AS confidence, CASE WHEN event_id % 6 = 0 THEN 0.9 ELSE 0.5 END::DOUBLE AS importance_score
  FROM (SELECT *, CASE WHEN event_id % 5 = 1 THEN '' ELSE began END AS event_time_start FROM ({_EV}))""")
def parse_default_record(spark, sf_dir):
    """Sources of a job without logic of its own: one record each, from the content's fields and else from the source."""
    e = F.col("event_id")
    rows = read(spark, sf_dir, "events").withColumn("at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).withColumn("k", e)
    content = F.struct(
        F.when(e % 3 > 0, F.concat(F.lit("About "), "event_type")).alias("title"), F.when(e % 4 > 0, F.col("props")).alias("summary"), F.when(e % 5 != 1, F.col("at")).alias("event_time_start"), F.when(e % 5 == 0, "2020-02-02").alias("event_date"), F.col("at").alias("coverage_start"),
        F.when(e % 2 == 0, F.array(F.lit("P1"), F.lit("P2"))).alias("people"), F.array("event_type").alias("topics"), F.concat(F.lit("n"), e).alias("external_id"), F.when(e % 6 == 0, 0.9).alias("importance_score"),
    )
    return _records_of(_export(rows, "notebooklm", content), "notebooklm_artifacts")


@query(f"""SELECT 'google_calendar-' || user_id AS file_id, CASE WHEN event_id % 4 > 0 THEN event_type ELSE 'Calendar event' END AS title, CASE WHEN event_id % 2 = 0 THEN began ELSE substr(began, 1, 10) END AS event_time_start,
    CASE WHEN event_id % 3 > 0 THEN 'R' || event_id % 4 ELSE '' END AS places, CASE WHEN event_id % 5 > 0 THEN 'e' || event_id ELSE 'u' || event_id END AS external_id, props AS summary FROM ({_EV})""")
def parse_google_calendar_json(spark, sf_dir):
    """Calendars that come as JSON: times with and without hours, events without a title, a place or an id."""
    e, day = F.col("event_id"), F.substring("at", 1, 10)
    start = F.struct(F.when(e % 2 == 0, F.col("at")).alias("dateTime"), F.when(e % 2 == 1, day).alias("date"))
    item = F.struct(F.when(e % 5 > 0, F.concat(F.lit("e"), e)).alias("id"), F.concat(F.lit("u"), e).alias("iCalUID"), F.when(e % 4 > 0, F.col("event_type")).alias("summary"), F.col("props").alias("description"), F.when(e % 3 > 0, F.concat(F.lit("R"), e % 4)).alias("location"), start.alias("start"))
    sources = _export(_events_by_user(spark, sf_dir, item), "google_calendar", F.struct(F.col("i").alias("events")))
    return _records_of(sources, "google_calendar").select("file_id", "title", "event_time_start", "places", "external_id", "summary")


@query(f"""WITH c AS (SELECT conv_id, count(*) + 1 AS n FROM conversations GROUP BY conv_id), e AS (SELECT unnest([struct_pack(t := 'app', c := 'chatgpt', d := 'chatgpt', m := n), struct_pack(t := 'conversation', c := 'c' || conv_id, d := 'c' || conv_id, m := n),
    struct_pack(t := 'model', c := 'm1', d := 'm1', m := 1), struct_pack(t := 'provider', c := 'openai', d := 'OpenAI', m := n), struct_pack(t := 'topic', c := 'chat', d := 'chat', m := n)]) AS x, n FROM c)
  SELECT {_ENT('x.t', 'x.c')} AS entity_id, x.t AS entity_type, x.c AS canonical_name, x.d AS display_name, CAST(sum(x.m) AS BIGINT) AS mentions, count(*) AS sources, CAST(sum(n) AS BIGINT) AS related_record_count FROM e GROUP BY x.t, x.c, x.d""")
def job_entities(spark, sf_dir):
    """Entities of chat exports, with those that the job adds to each source: its provider, conversations and models."""
    job = "chatgpt_export"
    sources = exports.build_sources(rules.resolve_parser(chat_exports(read(spark, sf_dir, "conversations"), job)), PROJECT, INGESTED)
    e = graph.merge_entities(graph.entity_sources(exports.parse_sources(sources, INGESTED, [job])))
    return e.select("entity_id", "entity_type", "canonical_name", "display_name", "mentions", F.size("source_ids").cast("long").alias("sources"), "related_record_count")


@query(f"WITH {_RELATIONS} SELECT predicate, count(*) AS n FROM rel GROUP BY predicate")
def relation_counts(spark, sf_dir):
    return stats.counts_by(graph.source_relations(event_records(read(spark, sf_dir, "events"))), "predicate")

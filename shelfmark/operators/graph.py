"""Entities and relations of records.

A popular entity occurs in very many records, so mentions are combined per source before they
meet by entity; the row per (entity, source) is the truth that counts and purges work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import entity_id, is_set, relation_id, text

# Entities that a job adds to each of its sources, as (type, display name).
JOB_ENTITIES = {
    "chatgpt_export": [("provider", "OpenAI")],
    "claude_export": [("provider", "Anthropic"), ("app", "Claude")],
    "gemini_chat_export": [("provider", "Google"), ("app", "Gemini")],
    "perplexity_export": [("app", "Perplexity")],
    "google_calendar": [("app", "Google Calendar")],
    "whatsapp_export": [("app", "WhatsApp")],
    "telegram_export": [("app", "Telegram")],
    "instagram_export": [("app", "Instagram")],
}
#: Names whose key is not their display name in lower case.
CANONICAL = {"Google Calendar": "google-calendar"}
CONVERSATION_JOBS = ("chatgpt_export", "claude_export", "gemini_chat_export")
MODEL_JOBS = ("chatgpt_export", "llm_json_transcript")


def _pairs(names: Column, kind: str) -> Column:
    return F.transform(F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: F.struct(F.lit(kind).alias("entity_type"), x.alias("display_name"), F.lower(x).alias("canonical_name")))


def _single(value: Column, kind: str, test: Column) -> Column:
    return F.when(test & is_set(value), _pairs(F.array(value), kind)).otherwise(_pairs(F.array().cast("array<string>"), kind))


def entity_mentions(records: DataFrame) -> DataFrame:
    """(source_id, record_id, pos, entity_type, canonical_name, display_name) of every record, extras of its job included."""
    job = F.col("parser_name")
    found = F.concat(
        _pairs(F.col("apps"), "app"),
        _pairs(F.col("topics"), "topic"),
        _pairs(F.col("people"), "person"),
        _single(F.col("place_name"), "place", F.lit(True)),
        _single(F.col("conversation_id"), "conversation", job.isin(*CONVERSATION_JOBS)),
        _single(F.col("subtype"), "model", job.isin(*MODEL_JOBS) & (F.col("record_type") == "llm_conversation") & (F.col("subtype") != "unknown")),
        _single(F.col("external_id"), "app", job == "google_play_installs"),
        *[
            F.when(job == name, F.array(*[F.struct(F.lit(t).alias("entity_type"), F.lit(d).alias("display_name"), F.lit(CANONICAL.get(d, d.lower())).alias("canonical_name")) for t, d in extra])).otherwise(_pairs(F.array().cast("array<string>"), "app"))
            for name, extra in JOB_ENTITIES.items()
        ],
    )
    rows = records.select("source_id", "source_system", "record_id", "pos", "event_date", F.posexplode(found).alias("at", "e"))
    return rows.select("source_id", "source_system", "record_id", F.struct("pos", "at").alias("place"), "event_date", "e.*").where("canonical_name <> ''")


def entity_sources(records: DataFrame) -> DataFrame:
    """One row per (entity, source): display name of its last mention, mentions, the source's records and dates."""
    dated = F.when(is_set("event_date"), F.col("event_date"))
    per_source = records.groupBy("source_id").agg(F.min(dated).alias("first_seen"), F.max(dated).alias("last_seen"), F.count("*").alias("records"))
    named = entity_mentions(records).groupBy("source_id", "source_system", "entity_type", "canonical_name").agg(F.max_by("display_name", "place").alias("display_name"), F.count("*").alias("mentions"))
    rows = named.withColumn("entity_id", entity_id(F.col("entity_type"), F.col("canonical_name")))
    return rows.join(per_source, "source_id").withColumns({"first_seen": text("first_seen"), "last_seen": text("last_seen")})


def merge_entities(child: DataFrame, existing_child: DataFrame | None = None) -> DataFrame:
    """Entities over all their sources. A source's newer child row replaces its older one, so runs can be repeated."""
    rows = child
    if existing_child is not None:
        rows = existing_child.join(child.select("entity_id", "source_id"), ["entity_id", "source_id"], "left_anti").unionByName(child)
    seen = lambda c: F.when(is_set(c), F.col(c))
    return rows.groupBy("entity_id").agg(
        F.first("entity_type").alias("entity_type"),
        F.first("canonical_name").alias("canonical_name"),
        F.max_by("display_name", "source_id").alias("display_name"),
        text(F.min(seen("first_seen"))).alias("first_seen"),
        text(F.max(seen("last_seen"))).alias("last_seen"),
        F.array_sort(F.collect_set("source_system")).alias("source_systems"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"),
        F.sum("records").alias("related_record_count"),
        F.sum("mentions").alias("mentions"),
    )


def link_entities(records: DataFrame, child: DataFrame) -> DataFrame:
    """Fill ``related_entity_ids`` with all entities of the record's source, by one array per source."""
    per = child.groupBy("source_id").agg(F.array_sort(F.collect_set("entity_id")).alias("__ids"))
    rows = records.join(per, "source_id", "left")
    return rows.withColumn("related_entity_ids", F.coalesce("__ids", F.array().cast("array<string>"))).drop("__ids")


def _edge(subject: Column, s_type: str, predicate: str, obj: Column, o_type: str, confidence: float) -> Column:
    clean = lambda c: F.lower(F.trim(text(c)))
    return F.struct(clean(subject).alias("subject"), F.lit(s_type).alias("subject_type"), F.lit(predicate).alias("predicate"), clean(obj).alias("object"), F.lit(o_type).alias("object_type"), F.lit(confidence).alias("confidence"))


def record_edges(records: DataFrame) -> DataFrame:
    """The edges that each record gives, in order: topics, visits, apps used, people met; for chat senders, messages sent.

    All pairs of people of one record are made within its row; their number is the square of
    the people that the record itself names.
    """
    arr = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    people, apps, topics = arr(F.col("people")), arr(F.col("apps")), arr(F.col("topics"))
    title, place = F.substring(F.col("title"), 1, 80), F.col("place_name")
    mentions = F.transform(topics, lambda t: _edge(t, "topic", "mentions", title, "topic", 0.8))
    visits = F.transform(F.filter(people, lambda p: is_set(place)), lambda p: _edge(p, "person", "visited", place, "place", 0.75))
    used = F.flatten(F.transform(people, lambda p: F.transform(apps, lambda a: _edge(p, "person", "used_app", a, "app", 0.75))))
    met = F.flatten(F.transform(people, lambda p, i: F.transform(F.slice(people, i + 2, F.size(people)), lambda q: _edge(p, "person", "communicated_with", q, "person", 0.7))))
    sent = F.transform(people, lambda p: _edge(p, "person", "sent_message", F.lit("whatsapp"), "app", 0.9))
    edges = F.when(F.col("parser_name") == "whatsapp_export", sent).otherwise(F.concat(mentions, visits, used, met))
    rows = records.select("source_id", "parser_name", "external_id", "event_time_start", "event_time_end", "pos", F.posexplode(edges).alias("at", "e"))
    return rows.select("source_id", "parser_name", "external_id", "event_time_start", "event_time_end", F.struct("pos", "at").alias("place"), "e.*").where("subject <> '' and object <> ''")


def known_edges(edges: DataFrame, child: DataFrame) -> DataFrame:
    """Edges without those of topics and chat senders that are no entity of their source; ``child``: ``entity_sources``."""
    names = child.select("source_id", F.col("canonical_name").alias("subject")).distinct()
    told = F.col("predicate").isin("mentions", "sent_message")
    return edges.where(~told).unionByName(edges.where(told).join(names, ["source_id", "subject"], "left_semi").select(edges.columns))


def source_relations(records: DataFrame, child: DataFrame | None = None) -> DataFrame:
    """Relations of each source: the first edge of each (subject, predicate, object), with its evidence.

    Evidence are the source's records with the edge's external id; chat messages keep one edge each.
    With ``child``, a topic or chat sender must be an entity of the source there.
    """
    edges = record_edges(records) if child is None else known_edges(record_edges(records), child)
    chat = F.when(F.col("parser_name") == "whatsapp_export", F.col("external_id")).otherwise("")
    key = ["source_id", "subject", "predicate", "object"]
    first = edges.groupBy(*key, chat.alias("message")).agg(F.min_by(F.struct("subject_type", "object_type", "external_id", "event_time_start", "event_time_end", "confidence"), "place").alias("r")).select(*key, "r.*")
    proof = records.where(is_set("external_id")).groupBy("source_id", "external_id").agg(F.array_sort(F.collect_set("record_id")).alias("evidence_record_ids"))
    rows = first.join(proof, ["source_id", "external_id"], "left").withColumn("evidence_record_ids", F.coalesce("evidence_record_ids", F.array().cast("array<string>")))
    ends = rows.withColumns({"subject_entity_id": entity_id(F.col("subject_type"), F.col("subject")), "object_entity_id": entity_id(F.col("object_type"), F.col("object"))})
    rid = relation_id(F.col("subject_entity_id"), F.col("predicate"), F.col("object_entity_id"), F.col("evidence_record_ids"))
    return ends.select(rid.alias("relation_id"), "source_id", "subject_entity_id", "predicate", "object_entity_id", F.col("event_time_start").alias("time_start"), F.col("event_time_end").alias("time_end"), "evidence_record_ids", "confidence", F.lit("active").alias("status"))


def merge_relations(per_source: DataFrame) -> DataFrame:
    """Equal relations of several sources as one: all sources, earliest start, latest end."""
    seen = lambda c: F.when(is_set(c), F.col(c))
    return per_source.groupBy("relation_id", "subject_entity_id", "predicate", "object_entity_id").agg(
        text(F.min(seen("time_start"))).alias("time_start"), text(F.max(seen("time_end"))).alias("time_end"), F.first("evidence_record_ids").alias("evidence_record_ids"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"), F.max("confidence").alias("confidence"), F.first("status").alias("status"),
    )

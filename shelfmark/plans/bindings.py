"""The library's inputs, made from the driver's tables: files, known files, records, exports.

Each binding exists twice, as a DataFrame and as SQL of the same meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31"
PROJECT = "shelf"
INGESTED = "2024-02-01T00:00:00Z"
TYPES = [
    (".txt", "text/plain"), (".md", "text/markdown"), (".pdf", "application/pdf"), (".py", "text/x-python"), (".zip", "application/zip"), (".jpg", "image/jpeg"),
    (".mp4", "video/mp4"), (".mp3", "audio/mpeg"), (".json", "application/json"), (".html", "text/html"), (".csv", "text/csv"), (".gdoc", "application/vnd.google-apps.document"),
]
_EXTS, _MIMES = [e for e, _ in TYPES], [m for _, m in TYPES]
_sql_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files_of(documents: DataFrame) -> DataFrame:
    """One file per document, with all kinds of names, types and change flags."""
    d = F.col("doc_id")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (d % len(xs) + 1).cast("int"))
    return documents.select(
        d.alias("seq"), F.concat(F.lit("f"), d).alias("file_id"),
        F.concat(F.when(d % 9 == 0, "decision ").when(d % 15 == 0, "skyline ").otherwise("doc "), d, pick(_EXTS)).alias("name"), pick(_MIMES).alias("mime_type"), F.col("n_chars").cast("long").alias("size"), F.md5("text").alias("md5"),
        F.array(F.concat(F.lit("d"), d % 50)).alias("parents"), F.concat(F.lit("2024-0"), d % 9 + 1, F.lit("-15T08:00:00Z")).alias("created_time"), F.concat(F.lit("2024-0"), d % 9 + 1, F.lit("-20T08:00:00Z")).alias("modified_time"),
        *[(d % n == 0).alias(c) for c, n in (("removed", 23), ("explicitly_deleted", 46), ("trashed", 29), ("scope_exit", 69))], F.when(d % 40 == 0, "INBOX_TRASH").otherwise("").alias("lane"), F.concat(F.lit("/d"), d % 50, F.lit("/code")).alias("path"), "text",
    )


FILES = f"""SELECT doc_id AS seq, 'f' || doc_id AS file_id, CASE WHEN doc_id % 9 = 0 THEN 'decision ' WHEN doc_id % 15 = 0 THEN 'skyline ' ELSE 'doc ' END || doc_id || {_sql_list(_EXTS)}[doc_id % 12 + 1] AS name,
  {_sql_list(_MIMES)}[doc_id % 12 + 1] AS mime_type, CAST(n_chars AS BIGINT) AS size, md5(text) AS md5, ['d' || doc_id % 50] AS parents, '2024-0' || (doc_id % 9 + 1) || '-15T08:00:00Z' AS created_time,
  '2024-0' || (doc_id % 9 + 1) || '-20T08:00:00Z' AS modified_time, doc_id % 23 = 0 AS removed, doc_id % 46 = 0 AS explicitly_deleted, doc_id % 29 = 0 AS trashed, doc_id % 69 = 0 AS scope_exit,
  CASE WHEN doc_id % 40 = 0 THEN 'INBOX_TRASH' ELSE '' END AS lane, '/d' || doc_id % 50 || '/code' AS path, text FROM documents"""


def hashed_files(documents: DataFrame) -> DataFrame:
    """The files with their content's hash instead of the content."""
    return files_of(documents).withColumn("sha256", F.sha2("text", 256)).drop("text")


def known_of(documents: DataFrame) -> DataFrame:
    return known_from(hashed_files(documents))


def known_from(files: DataFrame) -> DataFrame:
    """An earlier state of hashed files: some were not there yet, others had another place, name, content or time."""
    d = F.col("seq")
    files = files.where(d % 10 != 3)
    return files.select(
        "seq", "file_id", F.when(d % 11 == 0, F.concat(F.lit("old "), "name")).otherwise(F.col("name")).alias("name"), F.when(d % 7 == 0, "d99").otherwise(F.get("parents", F.lit(0))).alias("parent_ids_sorted"),
        F.when(d % 13 == 0, F.concat(F.lit("x"), "md5")).otherwise(F.col("md5")).alias("md5"), F.when(d % 17 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(d % 19 == 0, "2023-01-01T00:00:00Z").otherwise(F.col("modified_time")).alias("modified_time"),
        "sha256",
    )


KNOWN = """SELECT seq, file_id, CASE WHEN seq % 11 = 0 THEN 'old ' || name ELSE name END AS name, CASE WHEN seq % 7 = 0 THEN 'd99' ELSE parents[1] END AS parent_ids_sorted,
  CASE WHEN seq % 13 = 0 THEN 'x' || md5 ELSE md5 END AS md5, CASE WHEN seq % 17 = 0 THEN size + 1 ELSE size END AS size, CASE WHEN seq % 19 = 0 THEN '2023-01-01T00:00:00Z' ELSE modified_time END AS modified_time,
  sha256(text) AS sha256 FROM files WHERE seq % 10 <> 3"""


def event_sources(events: DataFrame) -> DataFrame:
    """Events as exported items, one source per user and day, in the shape that jobs give."""
    e = F.col("event_id")
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.element_at(F.array(*map(F.lit, ["purchase_event", "subscription_event", "task", "calendar_event", "message_event", "llm_turn", "activity_event"])), (e % 7 + 1).cast("int"))
    app = F.col("event_type")
    return events.select(
        e.alias("seq"), F.concat(F.lit("src::"), "user_id").alias("source_id"), F.concat(F.lit("f"), "user_id").alias("file_id"), kind.alias("record_type"), start.alias("event_time_start"), F.substring(start, 1, 10).alias("event_date"),
        F.concat(app, F.lit(" "), e % 40).alias("title"), F.col("value").alias("importance_score"), F.array(F.concat(F.lit("user "), "user_id")).alias("people"), F.array(F.concat(F.lit("place "), e % 5)).alias("places"), F.array(app).alias("apps"), F.array(F.concat(F.lit("topic "), e % 6)).alias("topics"),
        F.when(e % 4 == 0, F.concat(F.lit("http://x/"), e)).otherwise("").alias("url"), F.concat(F.lit("e"), e).alias("external_id"), F.concat(F.lit("Event number "), e, F.lit(" of "), app).alias("raw_text"),
    )


def event_records(events: DataFrame) -> DataFrame:
    from shelfmark.functions.ids import record_id

    r = event_sources(events)
    rid = record_id(F.col("source_id"), F.col("record_type"), F.col("external_id"), F.col("event_time_start"), F.col("title"))
    return r.select(
        rid.alias("record_id"), "*", F.substring("title", 1, 120).alias("compact_title"), F.lit("").alias("compact_summary"), F.lit("events").alias("source_system"), F.col("apps")[0].alias("source_service"), F.lit("tracker").alias("source_app"), F.lit("").alias("normalized_text"),
        F.lit("generic_json_export").alias("parser_name"), F.lit("").alias("event_time_end"), F.col("places")[0].alias("place_name"), F.lit("").alias("conversation_id"), F.lit("item").alias("subtype"), F.col("seq").alias("pos"), F.lit(0.8).alias("confidence"), F.col("url").alias("raw_ref"),
        F.array().cast("array<string>").alias("related_entity_ids"),
    )


RECORDS = """SELECT 'rec::' || substr(sha256('{"event_time_start":"' || event_time_start || '","external_id":"' || external_id || '","record_type":"' || record_type || '","source_id":"' || source_id || '","title":"' || title || '"}'), 1, 20) AS record_id, *,
  title AS compact_title, '' AS compact_summary, 'events' AS source_system, apps[1] AS source_service, 'tracker' AS source_app, '' AS normalized_text, '' AS event_time_end, places[1] AS place_name, 0.8 AS confidence, url AS raw_ref FROM (
  SELECT event_id AS seq, 'src::' || user_id AS source_id, 'f' || user_id AS file_id, ['purchase_event', 'subscription_event', 'task', 'calendar_event', 'message_event', 'llm_turn', 'activity_event'][event_id % 7 + 1] AS record_type,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time_start, strftime(ts, '%Y-%m-%d') AS event_date, event_type || ' ' || event_id % 40 AS title, value AS importance_score, ['user ' || user_id] AS people, ['place ' || event_id % 5] AS places, [event_type] AS apps, ['topic ' || event_id % 6] AS topics,
    CASE WHEN event_id % 4 = 0 THEN 'http://x/' || event_id ELSE '' END AS url, 'e' || event_id AS external_id, 'Event number ' || event_id || ' of ' || event_type AS raw_text FROM events)"""


def chat_exports(conversations: DataFrame, shape: str) -> DataFrame:
    """Conversations as one export of a chat service each; (source columns, content JSON)."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = conversations.groupBy("conv_id").agg(turns.alias("t"))
    cid, title, created = F.concat(F.lit("c"), "conv_id"), F.concat(F.lit("Chat "), "conv_id"), F.lit("2024-03-05T10:00:00Z")
    mid = lambda x: F.concat(cid, F.lit("-"), x["turn"])

    def content():
        if shape == "chatgpt_export":
            each = F.transform("t", lambda x: F.struct(mid(x).alias("id"), x["role"].alias("role"), created.alias("timestamp"), x["text"].alias("content")))
            return F.struct(F.array(F.struct(cid.alias("id"), title.alias("title"), F.lit("m1").alias("model"), created.alias("create_time"), F.array(F.lit("chat")).alias("topics"), each.alias("turns"))).alias("conversations"))
        if shape == "claude_export":
            each = F.transform("t", lambda x: F.struct(mid(x).alias("uuid"), x["role"].alias("sender"), x["text"].alias("text"), created.alias("created_at")))
            return F.struct(F.array(F.struct(cid.alias("uuid"), title.alias("name"), created.alias("created_at"), created.alias("updated_at"), each.alias("chat_messages"))).alias("conversations"))
        if shape == "gemini_chat_export":
            each = F.transform("t", lambda x: F.struct(mid(x).alias("id"), x["role"].alias("role"), x["text"].alias("content"), created.alias("timestamp")))
            return F.struct(F.array(F.struct(cid.alias("id"), title.alias("title"), created.alias("createTime"), each.alias("turns"))).alias("conversations"))
        if shape == "llm_json_transcript":
            each = F.transform("t", lambda x: F.struct(mid(x).alias("id"), x["role"].alias("role"), x["text"].alias("content"), created.alias("timestamp")))
            return F.struct(F.struct(cid.alias("id"), F.lit("m1").alias("model"), created.alias("created_at"), title.alias("title")).alias("metadata"), each.alias("messages"))
        each = F.transform("t", lambda x: F.struct(x["role"].alias("role"), created.alias("timestamp"), x["text"].alias("content")))
        return F.struct(F.array(F.struct(cid.alias("id"), title.alias("title"), created.alias("created_at"), each.alias("turns"))).alias("threads"))

    return rows.select(F.concat(F.lit(shape + "-"), "conv_id").alias("file_id"), F.concat(F.lit(f"exports/{shape}-"), "conv_id", F.lit(".json")).alias("source_path"), F.concat(F.lit(f"{shape}-"), "conv_id", F.lit(".json")).alias("original_filename"), F.to_json(content()).alias("content"), F.lit("").alias("raw_text"), F.lit("").alias("text_preview"))

"""Queries of the feeds between the jobs: listings, deltas, files and archives, published tables, streams.

What an operator reads from files is first written into the shared folder from the driver's tables.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.session import shared_dir
from shelfmark.operators import graph, inventory, rollups, stats
from shelfmark.plans.bindings import AS_OF, event_records, files_of, read
from shelfmark.plans.catalog import _DAILY_SQL, _MENTIONS, _RECORDS, _RELATIONS, _REPORTED, _reported, _shown_daily, query
from shelfmark.sources import archives, files, rules, tables
from shelfmark.streaming import inventory as stream


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- listing and change feed


def _listing(docs: DataFrame) -> DataFrame:
    """Documents as a raw listing: every seventh is a folder, fields are missing here and there."""
    d = F.col("doc_id")
    say = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    return docs.select(
        d.alias("seq"), say("f", d).alias("id"), say("doc ", d).alias("name"), F.when(d % 7 == 0, inventory.FOLDER_MIME).otherwise("text/plain").alias("mimeType"),
        F.when(d % 5 > 0, F.col("n_chars").cast("long")).alias("size"), F.when(d % 4 > 0, F.md5("text")).alias("md5Checksum"),
        F.when(d % 6 > 0, F.array(say("d", d % 50), F.when(d % 3 == 0, "trash").otherwise("keep"))).alias("parents"), F.lit("2024-01-01T00:00:00Z").alias("createdTime"), F.lit(None).cast("string").alias("modifiedTime"),
        say("http://x/", d).alias("webViewLink"), F.lit(None).cast("string").alias("description"), (d % 2 == 0).alias("starred"), F.when(d % 9 > 0, d % 29 == 0).alias("trashed"), F.lit(None).cast("boolean").alias("removed"),
        F.lit(False).alias("scope_exit"), (d % 46 == 0).alias("explicitly_trashed_or_deleted_flag"), F.when(d % 8 > 0, F.array(F.struct(say("o", d % 3, "@x").alias("emailAddress")), F.struct(F.lit("second@x").alias("emailAddress")))).alias("owners"),
        F.struct(say("e", d % 4, "@x").alias("emailAddress")).alias("lastModifyingUser"), F.when(d % 5 > 0, F.struct((d % 2 == 0).alias("canEdit"), F.lit(True).alias("canShare"), F.when(d % 3 > 0, d % 3 == 1).alias("canDownload"))).alias("capabilities"),
    )


@query("""SELECT doc_id AS seq, 'f' || doc_id AS file_id, CASE WHEN doc_id % 5 > 0 THEN CAST(n_chars AS BIGINT) ELSE 0 END AS size, CASE WHEN doc_id % 4 > 0 THEN md5(text) ELSE '' END AS md5,
  CASE WHEN doc_id % 6 > 0 THEN 'd' || doc_id % 50 || CASE WHEN doc_id % 3 = 0 THEN ',trash' ELSE ',keep' END ELSE '' END AS parents, '' AS modified_time, doc_id % 2 = 0 AS starred, doc_id % 9 > 0 AND doc_id % 29 = 0 AS trashed,
  doc_id % 46 = 0 AS explicitly_deleted, CASE WHEN doc_id % 8 > 0 THEN 'o' || doc_id % 3 || '@x' ELSE '' END AS owner, 'e' || doc_id % 4 || '@x' AS last_modified_by, doc_id % 5 > 0 AND doc_id % 2 = 0 AS can_edit, doc_id % 5 > 0 AS can_share,
  doc_id % 5 = 0 OR doc_id % 3 < 2 AS can_download, CASE WHEN doc_id % 6 > 0 AND doc_id % 3 = 0 THEN 'INBOX_TRASH' ELSE '' END AS lane FROM documents WHERE doc_id % 7 <> 0""")
def list_files(spark, sf_dir):
    rows = inventory.to_file_records(_listing(read(spark, sf_dir, "documents")), trash_inbox="trash")
    return rows.select("seq", "file_id", "size", "md5", F.array_join("parents", ",").alias("parents"), "modified_time", "starred", "trashed", "explicitly_deleted", "owner", "last_modified_by", "can_edit", "can_share", "can_download", "lane")


@query("""WITH c AS (SELECT doc_id, doc_id % 23 = 0 AS r, doc_id % 17 > 0 AS has, doc_id % 5 = 0 AS t, coalesce(doc_id % 3 > 0, false) AS inside FROM documents), g AS (SELECT *, r OR NOT has AS gone, has AND t AS tr FROM c)
  SELECT doc_id AS seq, gone OR NOT inside AS removed, gone AND NOT has AS explicitly_deleted, NOT gone AND NOT inside AS scope_exit, NOT gone AND tr AS trashed FROM g WHERE gone OR inside OR NOT tr""")
def change_feed(spark, sf_dir):
    d = F.col("doc_id")
    file = F.when(d % 17 > 0, F.struct(d.alias("id"), (d % 5 == 0).alias("trashed")))
    changes = read(spark, sf_dir, "documents").select(d.alias("seq"), (d % 23 == 0).alias("removed"), file.alias("file"))
    return inventory.normalize_changes(changes, F.col("seq") % 3 > 0).select("seq", "removed", "explicitly_deleted", "scope_exit", "trashed")


# --- what the report and the OCR result say of a source

_OCR = """ocr AS (SELECT 'f' || doc_id AS file_id, ['invoice', 'chat message', ''][doc_id % 3 + 1] AS doc_type, ['low', 'medium', 'high'][doc_id % 3 + 1] AS sensitivity, CAST(doc_id % 2 AS DOUBLE) AS amount,
  CASE WHEN doc_id % 5 > 0 THEN '2024-02-03' END AS date, lang AS summary, ['P' || doc_id % 4, 'P1'] AS people, ['Org ' || source] AS organizations FROM documents WHERE doc_id % 4 > 0)"""


def _ocr(spark, sf_dir) -> DataFrame:
    d = F.col("doc_id")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (d % len(xs) + 1).cast("int"))
    return read(spark, sf_dir, "documents").where(d % 4 > 0).select(
        F.concat(F.lit("f"), d).alias("file_id"), pick("invoice", "chat message", "").alias("doc_type"), pick("low", "medium", "high").alias("sensitivity"), (d % 2).cast("double").alias("amount"), F.when(d % 5 > 0, "2024-02-03").alias("date"),
        F.col("lang").alias("summary"), F.array(F.concat(F.lit("P"), d % 4), F.lit("P1")).alias("people"), F.array(F.concat(F.lit("Org "), "source")).alias("organizations"),
    )


def _seen(spark, sf_dir) -> DataFrame:
    """The report with OCR results beside it."""
    rows = _reported(spark, sf_dir).withColumns({"notes": F.concat(F.lit("n"), F.col("seq") % 5), "run_utc": F.lit("2024-02-01T00:00:00Z"), "starred": F.col("seq") % 2 == 0, "web_link": F.concat(F.lit("http://x/"), "seq"), "folder_rule": F.when(F.col("seq") % 3 > 0, F.concat(F.lit("r"), F.col("seq") % 3))})
    return inventory.attach_ocr(rows, _ocr(spark, sf_dir))


@query(f"""WITH {_REPORTED}, {_OCR}, s AS (SELECT 'f' || doc_id AS file_id, 'rule ' || lang AS folder_rule, '/t/' || doc_id AS target_path FROM documents WHERE doc_id % 3 > 0),
  e AS (SELECT *, status = 'UNCHANGED_CONTENT' OR status IN ('DELETED', 'TRASHED', 'REMOVED_OR_NO_ACCESS', 'MOVED_OUT_OF_SCOPE') OR change_type IN ('DELETED', 'TRASHED', 'REMOVED_OR_NO_ACCESS', 'MOVED_OUT_OF_SCOPE', 'UNCHANGED_CONTENT_METADATA_ONLY') AS event FROM reported WHERE run_id = 'run1')
  SELECT e.file_id, e.status, e.change_type, coalesce(s.folder_rule, '') AS folder_rule, coalesce(s.target_path, '') AS target_path, CASE WHEN s.file_id IS NULL THEN '' ELSE 'move' END AS action_mode,
    CASE WHEN event THEN 'event_only: content not processed' ELSE 'n' || seq % 5 END AS notes, CASE WHEN NOT event THEN doc_type END AS ocr_type, CASE WHEN NOT event THEN array_to_string(people, ',') END AS ocr_people
  FROM e LEFT JOIN s USING (file_id) LEFT JOIN ocr USING (file_id)""")
def delta_export(spark, sf_dir):
    d = F.col("doc_id")
    docs = read(spark, sf_dir, "documents").where(d % 3 > 0)
    told = docs.select(F.concat(F.lit("f"), d).alias("file_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"), F.concat(F.lit("rule "), "lang").alias("r"), F.concat(F.lit("/t/"), d).alias("target_path"))
    told = told.select("file_id", "seq", F.when(F.col("seq") == 2, F.col("r")).otherwise("old").alias("folder_rule"), "target_path", F.lit("move").alias("action_mode"))
    report = _seen(spark, sf_dir).where("run_id = 'run1'").drop("folder_rule")
    out = files.delta_export(report, told)
    path = _folder(spark, "delta")
    out.select("file_id", "status", "change_type", "folder_rule", "target_path", "action_mode", "notes", "ocr").write.option("ignoreNullFields", "false").json(path)
    back = spark.read.schema(out.select("file_id", "status", "change_type", "folder_rule", "target_path", "action_mode", "notes", "ocr").schema).json(path)
    return back.select("file_id", "status", "change_type", "folder_rule", "target_path", "action_mode", "notes", F.col("ocr.doc_type").alias("ocr_type"), F.array_join("ocr.people", ",").alias("ocr_people"))


@query(f"""WITH {_REPORTED}, {_OCR}, s AS (SELECT r.*, o.file_id AS o, o.doc_type, o.sensitivity, o.amount FROM reported r LEFT JOIN ocr o USING (file_id))
  SELECT file_id, coalesce(sensitivity IN ('medium', 'high'), false) AS contains_pii, coalesce(contains(doc_type, 'message'), false) AS contains_messages, contains(path, 'map') AS contains_geo,
    coalesce(amount, 0) <> 0 AS contains_financial, starts_with(mime_type, 'image/') AS contains_media_refs FROM s""")
def source_flags(spark, sf_dir):
    return files.source_flags(_seen(spark, sf_dir)).select("file_id", "contains_pii", "contains_messages", "contains_geo", "contains_financial", "contains_media_refs")


@query(f"""WITH {_REPORTED}, {_OCR}, s AS (SELECT r.*, o.file_id AS o, o.doc_type, o.date, o.summary, o.people, o.organizations, CASE WHEN seq % 4 = 0 THEN 'Own ' || seq END AS own_title, CASE WHEN seq % 5 = 0 THEN '' END AS own_summary,
    CASE WHEN seq % 6 = 0 THEN '2020-01-01' END AS own_date, CASE WHEN seq % 3 = 0 THEN ['P9', 'P1', 'P9'] END AS own_people, CASE WHEN seq % 10 = 0 THEN ['own app'] END AS own_apps, CASE WHEN seq % 7 = 0 THEN ['own topic'] END AS own_topics,
    CASE WHEN seq % 4 = 1 THEN 0.9 WHEN seq % 4 = 2 THEN 0.4 END AS own_score, CASE WHEN seq % 8 = 0 THEN 'http://own/' END AS own_url, coalesce(nullif(date, ''), '2024-02-01T00:00:00Z') AS start FROM reported r LEFT JOIN ocr o USING (file_id)),
  a AS (SELECT *, coalesce(own_apps, CASE WHEN seq % 3 > 0 THEN ['r' || seq % 3] ELSE [] END) AS apps FROM s),
  distinct_once AS (SELECT *, CASE WHEN people IS NOT NULL THEN list_concat(coalesce(own_people, []), people) END AS p2, CASE WHEN organizations IS NOT NULL THEN list_concat(apps, organizations) END AS a2 FROM a)
  SELECT file_id, coalesce(own_title, name) AS title, coalesce(own_summary, nullif(summary, ''), 'n' || seq % 5) AS summary, coalesce(own_date, start) AS event_time_start, substr(start, 1, 10) AS event_date,
    array_to_string(CASE WHEN p2 IS NULL THEN coalesce(own_people, []) ELSE list_filter(p2, lambda x, i: list_position(p2, x) = i) END, ',') AS people,
    array_to_string(CASE WHEN a2 IS NULL THEN apps ELSE list_filter(a2, lambda x, i: list_position(a2, x) = i) END, ',') AS apps,
    array_to_string(coalesce(own_topics, CASE WHEN trim(coalesce(doc_type, '')) <> '' THEN [trim(doc_type)] ELSE [] END), ',') AS topics,
    CAST(CASE WHEN seq % 2 = 0 THEN least(1.0, coalesce(own_score, 0.5) + 0.25) ELSE coalesce(own_score, 0.5) END AS DOUBLE) AS importance_score, coalesce(own_url, 'http://x/' || seq) AS url,
    CASE WHEN starts_with(mime_type, 'text/') THEN 'text' WHEN contains(mime_type, 'json') THEN 'json' ELSE 'unknown' END AS canonical_format FROM distinct_once""")
def enrich_sources(spark, sf_dir):
    """Contents with fields of their own here and there; the report and the OCR result fill in the rest."""
    n = F.col("seq")
    listed = lambda *xs: F.array(*map(F.lit, xs))
    content = F.struct(F.when(n % 4 == 0, F.concat(F.lit("Own "), n)).alias("title"), F.when(n % 5 == 0, "").alias("summary"), F.when(n % 6 == 0, "2020-01-01").alias("event_time_start"), F.lit(None).cast("string").alias("event_date"), F.when(n % 10 == 0, listed("own app")).alias("apps"),
        F.when(n % 7 == 0, listed("own topic")).alias("topics"), F.when(n % 3 == 0, listed("P9", "P1", "P9")).alias("people"), F.when(n % 4 == 1, 0.9).when(n % 4 == 2, 0.4).alias("importance_score"), F.when(n % 8 == 0, "http://own/").alias("url"))
    out = files.enrich_sources(_seen(spark, sf_dir).withColumn("content", content))
    return out.select("file_id", "title", "summary", "event_time_start", "event_date", *[F.array_join(c, ",").alias(c) for c in ("people", "apps", "topics")], "importance_score", "url", "canonical_format")


# --- statistics of sources

_PARSED = """sources AS (SELECT 's' || event_id AS source_id, ['llm', 'google', ''][event_id % 3 + 1] AS source_system, CASE WHEN event_id % 11 = 0 THEN 'broken' ELSE '' END AS parse_error, CASE WHEN event_id % 13 = 0 THEN 'odd' END AS parse_warning,
  CASE WHEN event_id % 4 = 0 THEN 'image/png' ELSE 'text/plain' END AS mime, CASE WHEN event_id % 9 = 0 THEN 'high' ELSE 'low' END AS sensitivity, CASE WHEN event_id % 5 = 0 THEN 'generic_json_export' ELSE 'claude_export' END AS parser_name,
  CASE WHEN event_id % 6 = 0 THEN 'event_only: x' ELSE '' END AS notes, event_id % 8 = 0 AS is_archive, CASE WHEN event_id % 3 > 0 THEN event_id % 4 END AS record_count,
  'In/' || ['ChatGPT', 'claude', 'Telegram', 'other'][event_id % 4 + 1] || '/x' AS source_path, user_id AS entity_count FROM events)"""


def _parsed_sources(spark, sf_dir) -> DataFrame:
    e = F.col("event_id")
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), (e % len(xs) + 1).cast("int"))
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), e).alias("source_id"), pick("llm", "google", "").alias("source_system"), F.when(e % 11 == 0, "broken").otherwise("").alias("parse_error"), F.when(e % 13 == 0, "odd").alias("parse_warning"),
        F.when(e % 4 == 0, "image/png").otherwise("text/plain").alias("mime"), F.when(e % 9 == 0, "high").otherwise("low").alias("sensitivity"), F.when(e % 5 == 0, "generic_json_export").otherwise("claude_export").alias("parser_name"),
        F.when(e % 6 == 0, "event_only: x").otherwise("").alias("notes"), (e % 8 == 0).alias("is_archive"), F.when(e % 3 > 0, e % 4).alias("record_count"), F.concat(F.lit("In/"), pick("ChatGPT", "claude", "Telegram", "other"), F.lit("/x")).alias("source_path"),
        F.col("user_id").alias("entity_count"), F.lit("1").alias("parser_version"), F.lit("success").alias("parser_status"), F.lit(0).alias("relation_count"),
    )


@query(f"""WITH {_PARSED} SELECT count(*) AS total, count(*) FILTER (source_system = 'llm') AS llm, count(*) FILTER (parse_error <> '') AS errors, count(*) FILTER (parse_warning <> '') AS warnings, count(*) FILTER (mime LIKE 'image/%') AS images,
  count(*) FILTER (sensitivity = 'high') AS high_sensitivity, count(*) FILTER (parser_name LIKE 'generic%') AS generic_parser, count(*) FILTER (parser_name NOT LIKE 'generic%') AS dedicated_parser, count(*) FILTER (notes LIKE 'event_only%') AS event_only,
  count(*) FILTER (is_archive AND coalesce(record_count, 0) <= 1) AS shallow_archives FROM sources""")
def source_stats(spark, sf_dir):
    return stats.source_stats(_parsed_sources(spark, sf_dir))


@query(f"WITH {_PARSED} SELECT source_system, count(*) AS n FROM sources GROUP BY 1")
def sources_by_system(spark, sf_dir):
    return stats.counts_by(_parsed_sources(spark, sf_dir), "source_system")


@query(f"WITH {_PARSED} SELECT DISTINCT f AS family FROM sources, (SELECT unnest(['chatgpt', 'claude', 'gemini', 'whatsapp', 'telegram', 'instagram']) AS f) WHERE contains(lower(source_path), f) AND NOT contains(parser_name, f)")
def missing_parser_families(spark, sf_dir):
    return stats.missing_parser_families(_parsed_sources(spark, sf_dir))


@query(f"WITH {_PARSED} SELECT source_id, parser_name, '1' AS parser_version, 'success' AS parser_status, coalesce(record_count, -1) AS record_count, entity_count, 0 AS relation_count, parse_error, coalesce(parse_warning, '') AS parse_warning FROM sources")
def quality_report(spark, sf_dir):
    return stats.quality_report(_parsed_sources(spark, sf_dir)).fillna({"record_count": -1, "parse_warning": ""})


# --- entities and relations with several people


def _met(spark, sf_dir) -> DataFrame:
    """Records with up to three people each, every fifth from chats."""
    s = F.col("seq")
    people = F.array(F.concat(F.lit("P"), s % 7), F.concat(F.lit("P"), s % 5), F.concat(F.lit("P"), s % 3))
    r = event_records(read(spark, sf_dir, "events"))
    return r.withColumns({"people": F.slice(people, 1, (s % 3 + 1).cast("int")), "parser_name": F.when(s % 5 == 0, "whatsapp_export").otherwise("generic_json_export")})


@query(f"""WITH {_RECORDS}, p AS (SELECT source_id, ['p' || seq % 7, 'p' || seq % 5, 'p' || seq % 3][1:seq % 3 + 1] AS people FROM records WHERE seq % 5 <> 0)
  SELECT DISTINCT source_id, people[i] AS subject, people[j] AS object FROM (SELECT source_id, people, unnest(range(1, 4)) AS i FROM p) q, (SELECT unnest(range(1, 4)) AS j) w WHERE i < j AND j <= len(people)""")
def person_pairs(spark, sf_dir):
    edges = graph.record_edges(_met(spark, sf_dir))
    return edges.where("predicate = 'communicated_with'").select("source_id", "subject", "object").distinct()


@query(f"""WITH {_RECORDS}, e AS (SELECT source_id, 'topic ' || seq % 6 AS subject, 'mentions' AS predicate FROM records WHERE seq % 5 <> 0
    UNION ALL SELECT source_id, unnest(['p' || seq % 7, 'p' || seq % 5, 'p' || seq % 3][1:seq % 3 + 1]), 'sent_message' FROM records WHERE seq % 5 = 0),
  k AS (SELECT source_id, 'topic ' || seq % 6 AS subject FROM records WHERE seq % 4 > 0 UNION SELECT source_id, unnest(['p' || seq % 7, 'p' || seq % 5, 'p' || seq % 3][1:seq % 3 + 1]) FROM records WHERE seq % 4 > 0)
  SELECT DISTINCT e.source_id, e.subject, e.predicate FROM e JOIN k ON k.source_id = e.source_id AND k.subject = e.subject""")
def known_topics_and_senders(spark, sf_dir):
    """Topics and chat senders count only where an earlier index of three records in four has them as the source's entities."""
    records = _met(spark, sf_dir)
    child = graph.entity_sources(records.where(F.col("seq") % 4 > 0))
    edges = graph.known_edges(graph.record_edges(records), child)
    return edges.where("predicate in ('mentions', 'sent_message')").select("source_id", "subject", "predicate").distinct()


@query(f"""WITH {_MENTIONS}, {_RELATIONS.removeprefix(_MENTIONS + ', ') if _RELATIONS.startswith(_MENTIONS) else _RELATIONS.removeprefix(_RECORDS + ', ')} SELECT relation_id, source_id FROM rel""")
def relations_of_known_entities(spark, sf_dir):
    """With all entities known, every relation stays."""
    records = event_records(read(spark, sf_dir, "events"))
    return graph.source_relations(records, graph.entity_sources(records)).select("relation_id", "source_id")


# --- index, logs and published tables


@query("SELECT event_id % 1000 AS k, max(event_id) AS seq, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def compact_index(spark, sf_dir):
    index = read(spark, sf_dir, "events").select((F.col("event_id") % 1000).alias("k"), F.col("event_id").alias("seq"), "event_type")
    return inventory.compact_index(index, "k", "seq", threshold=100)


@query("SELECT 'k' || event_id % 700 AS k, max(event_id) AS seq, arg_max(event_type, event_id) AS event_type FROM events WHERE event_id % 10 <> 3 GROUP BY 1")
def read_index(spark, sf_dir):
    """A JSON-lines index with blank and broken lines and rows without a key."""
    e = F.col("event_id")
    good = F.to_json(F.struct(F.concat(F.lit("k"), e % 700).alias("k"), e.alias("seq"), "event_type"))
    none = F.to_json(F.struct(e.alias("seq"), "event_type"))
    path = _folder(spark, "index")
    lines = read(spark, sf_dir, "events").select(F.when(e % 10 != 3, good).when(e % 20 == 3, F.concat(F.substring(good, 1, 9))).when(e % 40 == 13, "").otherwise(none).alias("value"))
    lines.write.text(path)
    schema = spark.createDataFrame([], "k string, seq long, event_type string").schema
    return tables.read_index(spark, path, schema, "k")


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey % 5 > 0")
def read_control_table(spark, sf_dir):
    """A table with a header whose short and ill-typed rows are dropped."""
    c = F.col("c_custkey")
    full = F.concat_ws(",", c.cast("string"), "c_name", F.col("c_acctbal").cast("string"))
    path = _folder(spark, "control")
    rows = read(spark, sf_dir, "customer").select(F.when(c % 10 == 5, "x,y").when(c % 10 == 0, F.concat_ws(",", F.lit("no number"), "c_name", F.lit("1"))).otherwise(full).alias("value"))
    spark.range(1).select(F.lit("k,name,balance").alias("value")).unionAll(rows).coalesce(1).write.text(path)
    return tables.read_control_table(spark, path, spark.createDataFrame([], "k long, name string, balance double").schema)


@query("SELECT 'run' || event_id % 3 AS run_id, event_id AS seq, event_type || repeat('x', 495 - length(event_type)) || 'yyyyy' AS error_message FROM events WHERE event_id % 3 < 2")
def append_log(spark, sf_dir):
    """Two runs append to one log; long messages are cut."""
    path = _folder(spark, "log")
    e = F.col("event_id")
    rows = read(spark, sf_dir, "events").select(F.concat(F.lit("run"), e % 3).alias("run_id"), e.alias("seq"), F.concat(F.rpad("event_type", 495, "x"), F.lit("yyyyyzzzzz")).alias("error_message"))
    for run in ("run0", "run1"):
        tables.append_log(rows.where(F.col("run_id") == run), path)
    return spark.read.parquet(path).select("run_id", "seq", "error_message")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 > 0")
def publish(spark, sf_dir):
    """The second version of a table, published twice as after a crash, is what readers see."""
    root, orders = _folder(spark, "published"), read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    tables.publish(orders, root, "orders", "1")
    for _ in range(2):
        tables.publish(orders.where("o_orderkey % 4 > 0"), root, "orders", "2")
    return tables.read_published(spark, root, "orders", orders.schema)


@query("SELECT 'regions' AS section, r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT 'nations', n_nationkey, n_name FROM nation UNION ALL SELECT 'suppliers', s_suppkey, s_name FROM supplier")
def publish_all(spark, sf_dir):
    root = _folder(spark, "sections")
    parts = {"regions": ("region", "r_regionkey", "r_name"), "nations": ("nation", "n_nationkey", "n_name"), "suppliers": ("supplier", "s_suppkey", "s_name")}
    sections = {s: read(spark, sf_dir, t).select(F.lit(s).alias("section"), F.col(k).cast("long").alias("k"), F.col(n).alias("name")) for s, (t, k, n) in parts.items()}
    tables.publish_all(sections, root, "1")
    out = None
    for name, df in sections.items():
        got = tables.read_published(spark, root, name, df.schema)
        out = got if out is None else out.unionByName(got)
    return out


@query(f"WITH {_RECORDS} SELECT event_date AS date, count(*) AS n FROM records WHERE event_date <> (SELECT min(event_date) FROM records) GROUP BY 1")
def publish_daily(spark, sf_dir):
    """The first day's records go, and with them its row of the next version."""
    root, records = _folder(spark, "daily"), event_records(read(spark, sf_dir, "events"))
    first = records.agg(F.min("event_date")).first()[0]
    daily = rollups.daily_memory(records, AS_OF)
    tables.publish_daily(daily, root, "1")
    tables.publish_daily(rollups.daily_memory(records.where(F.col("event_date") != first), AS_OF), root, "2")
    schema = daily.withColumn("day", F.col("date")).schema
    return tables.read_published(spark, root, "daily", schema).select("date", F.size("record_ids").cast("long").alias("n"))


@query(f"WITH {_RECORDS} SELECT strftime(CAST(event_date AS DATE), '%G-W%V') AS week, count(*) AS total_records FROM records GROUP BY 1")
def publish_weekly(spark, sf_dir):
    root = _folder(spark, "weekly")
    weekly = rollups.weekly_memory(rollups.daily_memory(event_records(read(spark, sf_dir, "events")), AS_OF))
    tables.publish_weekly(weekly, root, "1")
    return tables.read_published(spark, root, "weekly", weekly.withColumn("iso_week", F.col("week")).schema).select("week", F.col("total_records").cast("long").alias("total_records"))


# --- files and archives


@query("SELECT page_id % 20 AS bucket, CAST(sum(strlen(html) + 1) AS BIGINT) AS bytes FROM pages GROUP BY 1")
def scan_files(spark, sf_dir):
    """Pages as files of a tree, and what lies in each folder of it."""
    root = _folder(spark, "tree")
    rows = read(spark, sf_dir, "pages").select("html", (F.col("page_id") % 20).alias("bucket"))
    rows.write.partitionBy("bucket").option("lineSep", "\n").text(root)
    found = files.with_checksums(files.scan_files(spark, root, max_bytes=1 << 30))
    seen = found.where(F.length("content") == F.col("length")).where(F.length("checksum_sha256") == 64)
    return seen.groupBy(F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("long").alias("bucket")).agg(F.sum("length").alias("bytes"))


def _export_files(spark, sf_dir) -> DataFrame:
    """Conversations' turns as files: objects, arrays, broken JSON and other kinds of text, some of them binary by name."""
    c, t = F.col("conv_id"), F.col("turn")
    ext = F.element_at(F.array(*map(F.lit, [".json", ".json", ".txt", ".JSON", ".7z", ".zip"])), ((c + t) % 6 + 1).cast("int"))
    place = F.element_at(F.array(*map(F.lit, ["in/../Takeout/./c", "My Exports/c", "other/c"])), (c % 3 + 1).cast("int"))
    body = F.when((c + t) % 6 == 0, F.to_json(F.struct("role", "text"))).when((c + t) % 6 == 1, F.concat(F.lit("[1, "), F.to_json(F.struct("role")), F.lit("]"))).when((c + t) % 6 == 3, "{broken").otherwise(F.col("text"))
    return read(spark, sf_dir, "conversations").select(F.concat(place, c, F.lit("-"), t, ext).alias("path"), F.encode(F.coalesce(body, F.lit("")), "UTF-8").alias("content"))


@query("""WITH f AS (SELECT *, (conv_id + turn) % 6 AS k, 'c' || conv_id || '-' || turn || ['.json', '.json', '.txt', '.JSON', '.7z', '.zip'][(conv_id + turn) % 6 + 1] AS n FROM conversations)
  SELECT ['Takeout/', 'My Exports/', 'other/'][conv_id % 3 + 1] || n AS source_path, lower(regexp_extract(n, '\\.[^.]*$')) AS ext, ['application/json', 'application/json', 'text/plain', 'application/json', 'application/octet-stream', 'application/octet-stream'][k + 1] AS mime,
    ['json', 'json', 'text', 'json', 'binary', 'binary'][k + 1] AS canonical_format, k = 5 AS is_archive, conv_id % 3 < 2 OR k = 5 AS is_bundle, conv_id % 3 < 2 OR k = 5 AS is_export, CASE WHEN k = 0 THEN 'role,text' ELSE '' END AS preview_keys, k IN (0, 1) AS is_content,
    CASE WHEN k = 2 THEN length(coalesce(text, '')) WHEN k = 3 THEN 7 WHEN k > 3 THEN 0 ELSE -1 END AS raw_chars, CASE WHEN k = 2 THEN md5(substr(coalesce(text, ''), 1, 1000)) ELSE '' END AS preview_md5 FROM f""")
def ingest_exports(spark, sf_dir):
    out = files.ingest_exports(_export_files(spark, sf_dir))
    own = F.col("content").startswith('{"role"') | F.col("content").startswith("[1, ")
    return out.select("source_path", "ext", "mime", "canonical_format", "is_archive", "is_bundle", "is_export", F.array_join("preview_keys", ",").alias("preview_keys"), own.alias("is_content"),
        F.when(~own, F.length("raw_text").cast("long")).otherwise(-1).alias("raw_chars"), F.when(F.col("ext") == ".txt", F.md5("text_preview")).otherwise("").alias("preview_md5"))


def _zip(batches):
    """One archive per row: a member for each turn, a folder, a kind that is not read; every ninth archive is broken. One is held at a time, and a bounded batch."""

    def one(r):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            z.writestr("a/", "")
            z.writestr("a/skip.exe", "x")
            for turn in r["turns"]:
                z.writestr(f"a/../b/t{turn['turn']}.txt", turn["text"] or "")
        return f"z{r['conv_id']}", "", raw.getvalue() if r["conv_id"] % 9 else b"no archive", "ORIGINAL"

    def shown(held):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)], ["file_id", "checksum_sha256", "content", "status"])

    held, size = [], 0
    for batch in batches:
        for k in range(len(batch)):
            held.append(one(batch.slice(k, 1).to_pylist()[0]))
            size += len(held[-1][2])
            if size >= archives.BATCH_BYTES:
                yield shown(held)
                held, size = [], 0
    if held:
        yield shown(held)


def _archives(spark, sf_dir) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns")).mapInArrow(_zip, "file_id string, checksum_sha256 string, content binary, status string")


_MEMBERS = """members AS (SELECT 'z' || conv_id AS bundle_id, 'b/t' || turn || '.txt' AS source_path, 'z' || conv_id || '_' || sha256('z' || conv_id || 'b/t' || turn || '.txt') AS file_id, sha256(coalesce(text, '')) AS checksum_sha256 FROM conversations WHERE conv_id % 9 > 0)"""


@query(f"WITH {_MEMBERS} SELECT file_id, bundle_id, source_path, checksum_sha256, false AS broken FROM members UNION ALL SELECT DISTINCT 'z' || conv_id, 'z' || conv_id, '', NULL, true FROM conversations WHERE conv_id % 9 = 0")
def expand_archives(spark, sf_dir):
    out = files.expand_archives(_archives(spark, sf_dir))
    return out.select("file_id", "bundle_id", "source_path", "checksum_sha256", F.col("problem").isNotNull().alias("broken"))


@query(f"WITH {_MEMBERS} SELECT file_id, source_path, 'generic_txt_export' AS parser_name FROM members UNION ALL SELECT DISTINCT 'z' || conv_id, 'in/z' || conv_id || '.zip', 'generic_zip_bundle' FROM conversations")
def ingest_archives(spark, sf_dir):
    """Archives and their members as sources of one table."""
    parents = _archives(spark, sf_dir)
    rows = files.with_members(parents.withColumn("path", F.concat(F.lit("in/"), "file_id", F.lit(".zip"))))
    return rules.resolve_parser(files.ingest_exports(rows)).select("file_id", "source_path", "parser_name")


# --- streams


#: More files than a step has: all that has come since the last start is one batch.
ALL_FILES = 1 << 30


def _grow(rows: DataFrame, root: str, by: str, steps: int = 4) -> Iterator[str]:
    """A folder that grows in steps, each told once its files are there: as many as its rows call for, none made by one task alone."""
    for k in range(steps):
        rows.where(F.pmod(F.col(by), F.lit(steps)) == k).write.mode("append").parquet(f"{root}/changes")
        yield f"{root}/changes"


@query(_DAILY_SQL)
def stream_daily(spark, sf_dir):
    """Daily rollups kept up to date by micro-batches of records; equal to one rollup of all."""
    root = _folder(spark, "stream-daily")
    rows = event_records(read(spark, sf_dir, "events"))
    for source in _grow(rows, root, "seq"):
        stream.stream_daily(spark, source, rows.schema, root, f"{root}/checkpoint", AS_OF, max_files=ALL_FILES, buckets=4)
    return _shown_daily(stream.read_daily(spark, root))


@query("""WITH b AS (SELECT doc_id % 4 AS b, doc_id AS seq, sha256(text) AS sha FROM documents),
  o AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY b, seq) AS k, min(b) OVER (PARTITION BY sha) AS first_b FROM b)
  SELECT 'f' || seq AS file_id, b AS batch, CASE WHEN k = 1 THEN 'ORIGINAL' ELSE 'DUPLICATE' END AS status, CASE WHEN k = 1 THEN '' ELSE 'f' || min(seq) FILTER (b = first_b) OVER (PARTITION BY sha) END AS duplicate_of FROM o""")
def stream_inventory_in_steps(spark, sf_dir):
    """New files in four micro-batches: each finds duplicates of what the ones before it have left as known, once more after a restart."""
    root, docs = _folder(spark, "stream-steps"), read(spark, sf_dir, "documents")
    plain = lambda df: files_of(df).withColumns({c: F.lit(False) for c in ("removed", "explicitly_deleted", "trashed", "scope_exit")}).withColumn("size", F.lit(1).cast("long"))
    for source in _grow(docs, root, "doc_id"):
        for _ in range(2):  # the second start finds nothing new
            stream.stream_inventory(spark, source, docs.schema, root, f"{root}/checkpoint", max_files=ALL_FILES, prepare=plain, buckets=4)
    return stream.read_reports(spark, root).select("file_id", F.col("batch").cast("long").alias("batch"), "status", "duplicate_of")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def stream_daily_counts(spark, sf_dir):
    root, events = _folder(spark, "stream-counts"), read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(18,6)").alias("value"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/counts/batch={number}")

    for source in _grow(events.withColumn("part", F.day("ts")), root, "part"):
        rows = spark.readStream.schema(events.schema).parquet(source)
        counts = stream.stream_daily_counts(rows, "400 days").select("window.start", "event_type", "n", "total")
        counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    told = spark.read.option("basePath", f"{root}/counts").parquet(f"{root}/counts")
    last = told.agg(F.max("batch")).first()[0]
    return told.where(F.col("batch") == last).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.col("total").cast("double").alias("total"))

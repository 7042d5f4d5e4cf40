"""One query per operator over the driver's tables, each beside SQL of the same meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import ids
from shelfmark.functions import text as T
from shelfmark.functions.session import shared_dir
from shelfmark.operators import graph, inventory, lifecycle, rollups, sorting, stats, views
from shelfmark.plans.bindings import AS_OF, FILES, INGESTED, KNOWN, PROJECT, RECORDS, chat_exports, event_records, files_of, hashed_files, known_from, known_of, read
from shelfmark.sources import exports, rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


def _joined(*columns: str) -> list:
    return [F.array_join(c, ",").alias(c) for c in columns]


# --- inventory

_FILES = f"files AS ({FILES}), known AS ({KNOWN})"
_SIZE = "CAST(coalesce({}, 0) AS VARCHAR)"
_CLASSIFIED = f"""{_FILES}, classified AS (SELECT f.*, k.seq AS known_seq, k.sha256 AS known_sha,
  CASE WHEN f.removed AND f.explicitly_deleted THEN 'DELETED' WHEN f.trashed THEN 'TRASHED' WHEN f.removed AND f.scope_exit THEN 'MOVED_OUT_OF_SCOPE' WHEN f.removed THEN 'REMOVED_OR_NO_ACCESS'
    WHEN k.file_id IS NULL THEN 'NEW' WHEN f.parents[1] <> k.parent_ids_sorted THEN 'MOVED' WHEN k.name <> '' AND f.name <> k.name THEN 'RENAMED' WHEN f.md5 <> k.md5 THEN 'UPDATED' WHEN f.size <> k.size THEN 'UPDATED'
    WHEN f.modified_time <> k.modified_time THEN 'UPDATED' ELSE 'UNCHANGED_CONTENT_METADATA_ONLY' END AS change_type,
  coalesce(k.file_id IS NOT NULL AND NOT starts_with(f.mime_type, 'application/vnd.google-apps.') AND f.md5 = k.md5 AND f.size = k.size, false) AS content_unchanged
  FROM files f LEFT JOIN known k USING (file_id))"""
_REMOVALS = "('DELETED', 'TRASHED', 'REMOVED_OR_NO_ACCESS', 'MOVED_OUT_OF_SCOPE')"
#: A small limit, so that the size guard decides for some files.
LIMIT_MB = 0.005
_ROUTED = f"""{_CLASSIFIED}, routed AS (SELECT *,
  CASE WHEN change_type IN {_REMOVALS} THEN change_type WHEN change_type = 'UNCHANGED_CONTENT_METADATA_ONLY' OR content_unchanged THEN CASE WHEN known_sha = 'HASH_SKIPPED_SIZE' THEN 'SKIPPED_SIZE' ELSE 'UNCHANGED_CONTENT' END
    WHEN size > {LIMIT_MB} * 1024 * 1024 THEN 'SKIPPED_SIZE' END AS status,
  CASE WHEN change_type IN {_REMOVALS} THEN '' WHEN change_type = 'UNCHANGED_CONTENT_METADATA_ONLY' OR content_unchanged THEN coalesce(known_sha, '') WHEN size > {LIMIT_MB} * 1024 * 1024 THEN 'HASH_SKIPPED_SIZE' END AS sha256 FROM classified)"""


def _classified(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return inventory.classify_changes(files_of(docs), known_of(docs))


@query(f"WITH {_CLASSIFIED} SELECT file_id, change_type, content_unchanged FROM classified")
def classify_changes(spark, sf_dir):
    return _classified(spark, sf_dir).select("file_id", "change_type", "content_unchanged")


@query(f"WITH {_ROUTED} SELECT file_id, status, sha256 FROM routed")
def route_for_hashing(spark, sf_dir):
    return inventory.route_for_hashing(_classified(spark, sf_dir), LIMIT_MB).select("file_id", "status", "sha256")


@query(f"""WITH {_CLASSIFIED} SELECT file_id, CASE WHEN change_type IN {_REMOVALS} THEN '' WHEN starts_with(name, substr(created_time, 1, 10) || '_') THEN name
  ELSE substr(created_time, 1, 10) || '_{PROJECT}_' || trim(replace(name, ':', '-')) END AS suggested_name FROM classified""")
def suggest_names(spark, sf_dir):
    return inventory.suggest_names(_classified(spark, sf_dir), PROJECT).select("file_id", "suggested_name")


_DEDUPED = f"""{_FILES}, hashed AS (SELECT *, sha256(text) AS sha FROM files),
  current AS (SELECT k.* FROM known k JOIN hashed h USING (file_id) WHERE k.sha256 = h.sha),
  old AS (SELECT sha256 AS sha, arg_min(file_id, seq) AS first FROM current GROUP BY 1), own AS (SELECT sha, arg_min(file_id, seq) AS first FROM hashed GROUP BY 1),
  deduped AS (SELECT h.*, coalesce(old.first, own.first) AS primary_id, CASE WHEN coalesce(old.first, own.first) <> h.file_id THEN 'DUPLICATE' WHEN old.first IS NOT NULL THEN 'ORIGINAL_RESUMED' ELSE 'ORIGINAL' END AS status
    FROM hashed h JOIN own USING (sha) LEFT JOIN old USING (sha))"""


def _stored(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(hashed files, known files): the documents are read and hashed once."""
    shared_dir(spark)
    files = hashed_files(read(spark, sf_dir, "documents")).checkpoint()
    return files, known_from(files)


def _deduped(spark, sf_dir):
    return inventory.dedupe_by_hash(*_stored(spark, sf_dir))


@query(f"WITH {_DEDUPED} SELECT file_id, sha AS sha256, status, CASE WHEN status = 'DUPLICATE' THEN primary_id ELSE '' END AS duplicate_of FROM deduped")
def dedupe_by_hash(spark, sf_dir):
    return _deduped(spark, sf_dir).select("file_id", "sha256", "status", "duplicate_of")


@query(f"WITH {_DEDUPED} SELECT sha AS sha256, min(primary_id) AS original_file_id, string_agg(file_id, ',' ORDER BY file_id) AS duplicate_file_ids, count(*) AS count FROM deduped WHERE status = 'DUPLICATE' GROUP BY sha")
def duplicate_groups(spark, sf_dir):
    return inventory.duplicate_groups(_deduped(spark, sf_dir)).select("sha256", "original_file_id", F.array_join("duplicate_file_ids", ",").alias("duplicate_file_ids"), "count")


@query(f"""WITH {_DEDUPED} SELECT seq, file_id, name, parents[1] AS parent_ids_sorted, md5, size, modified_time, sha AS sha256 FROM deduped WHERE status <> 'DUPLICATE'
  UNION ALL SELECT k.seq, k.file_id, k.name, k.parent_ids_sorted, k.md5, k.size, k.modified_time, k.sha256 FROM known k JOIN deduped d USING (file_id) WHERE d.status = 'DUPLICATE'""")
def update_known(spark, sf_dir):
    files, known = _stored(spark, sf_dir)
    return inventory.update_known(known, inventory.dedupe_by_hash(files, known).checkpoint())


@query("SELECT o_custkey, arg_max(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey")
def latest_by_key(spark, sf_dir):
    return inventory.latest_by_key(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey")


_FOLDERS = "folders AS (SELECT 'd' || p_partkey AS folder_id, 'd' || p_partkey // 3 AS parent_id FROM part)"


def _folders(spark, sf_dir):
    p = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(F.concat(F.lit("d"), p).alias("folder_id"), F.concat(F.lit("d"), F.floor(p / 3)).alias("parent_id"))


_SCOPE = f"{_FOLDERS}, inside AS (SELECT 'd2' AS folder_id UNION SELECT f.folder_id FROM folders f JOIN inside i ON f.parent_id = i.folder_id)"


@query(f"WITH RECURSIVE {_SCOPE} SELECT folder_id FROM inside")
def folders_in_scope(spark, sf_dir):
    return inventory.in_scope(_folders(spark, sf_dir), "d2")


@query(f"WITH RECURSIVE {_SCOPE}, files AS ({FILES}) SELECT file_id, parents[1] IN (SELECT folder_id FROM inside) AS in_scope FROM files")
def flag_scope(spark, sf_dir):
    return inventory.flag_scope(files_of(read(spark, sf_dir, "documents")), _folders(spark, sf_dir), "d2").select("file_id", "in_scope")


@query(f"""WITH files AS ({FILES}), registry AS (SELECT 'd' || p_partkey AS folder_id, '/' || p_name AS full_path FROM part WHERE p_partkey % 2 = 0)
  SELECT file_id, coalesce(full_path, parents[1]) || '/' || name AS path FROM files LEFT JOIN registry r ON r.folder_id = parents[1]""")
def display_paths(spark, sf_dir):
    registry = read(spark, sf_dir, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("d"), "p_partkey").alias("folder_id"), F.concat(F.lit("/"), "p_name").alias("full_path"))
    return inventory.display_paths(files_of(read(spark, sf_dir, "documents")).drop("path"), registry).select("file_id", "path")


def _reported_with_known(spark, sf_dir):
    files, known = _stored(spark, sf_dir)
    kinds = inventory.classify_changes(files, known).select("file_id", "change_type")
    report = inventory.dedupe_by_hash(files, known).join(kinds, "file_id").withColumn("run_id", F.concat(F.lit("run"), F.col("seq") % 3))
    return report, known


def _reported(spark, sf_dir):
    return _reported_with_known(spark, sf_dir)[0]


_REPORTED = f"{_CLASSIFIED}, {_DEDUPED.removeprefix(_FILES + ', ')}, reported AS (SELECT d.*, c.change_type, 'run' || d.seq % 3 AS run_id FROM deduped d JOIN classified c USING (file_id))"


@query(f"WITH {_REPORTED} SELECT file_id, status FROM reported WHERE run_id = 'run1' AND status <> 'DUPLICATE'")
def eligible_for_index(spark, sf_dir):
    return inventory.eligible_for_index(_reported(spark, sf_dir), "run1").select("file_id", "status")


@query(f"""WITH {_REPORTED} SELECT file_id FROM reported WHERE (mime_type LIKE 'image/%' OR mime_type IN ('application/pdf', 'application/vnd.google-apps.document')) AND status = 'ORIGINAL' AND change_type IN ('NEW', 'UPDATED')
  ORDER BY seq, file_id LIMIT 500""")
def select_ocr_candidates(spark, sf_dir):
    return inventory.select_ocr_candidates(_reported(spark, sf_dir)).select("file_id")


@query(f"WITH files AS ({FILES}) SELECT file_id FROM files WHERE CAST(substr(modified_time, 1, 10) AS DATE) < DATE '2024-05-01' - 7")
def expired_files(spark, sf_dir):
    return inventory.expired_files(files_of(read(spark, sf_dir, "documents")), "2024-05-01T08:00:01Z").select("file_id")


# --- sorting

_HINTS = "hints AS (SELECT 'f' || doc_id AS file_id, ['invoice', 'notes', 'vertrag'][doc_id % 3 + 1] AS topic_hint FROM documents WHERE doc_id % 8 = 0)"
_REGISTRY = "registry AS (SELECT * FROM (VALUES ('30_scripts', 'Scripts', 's1', '/a/Scripts'), ('99_archive', 'Archive', 's2', '/a/Archive'), ('00_inbox', 'Inbox', 's3', '/a/Inbox'), ('01_inbox_trash', 'Trash', 's4', '/a/Trash')) t(folder_key, folder_name, folder_id, full_path))"
_MARKERS = ("skyline",)
_in = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
_ends = lambda xs: "(" + " OR ".join(f"ends_with(lower(name), '{x}')" for x in xs) + ")"
_has = lambda c, xs: "(" + " OR ".join(f"contains(lower({c}), '{x}')" for x in xs) + ")"
_SORTED = f"""{_REPORTED}, {_HINTS}, {_REGISTRY}, ruled AS (SELECT r.*, topic_hint,
  CASE WHEN lane = 'INBOX_TRASH' THEN '01_inbox_trash' WHEN contains(status, 'DUPLICATE') THEN '99_archive' WHEN topic_hint IN {_in(sorting.FINANCIAL_TOPICS)} THEN '40b_referenzen' WHEN mime_type LIKE 'image/%' THEN '50a_fotos'
    WHEN mime_type LIKE 'video/%' THEN '50b_videos' WHEN mime_type LIKE 'audio/%' THEN '50c_audio' WHEN {_ends(sorting.SCRIPT_EXTENSIONS)} THEN '30_scripts' WHEN ends_with(lower(name), '.md') AND {_has('path', sorting.CODE_PATHS)} THEN '30_scripts'
    WHEN mime_type = 'application/pdf' THEN '40b_referenzen' WHEN {_has('name', _MARKERS)} OR {_has('path', _MARKERS)} THEN '40c_projekte' WHEN {_has('name', sorting.DECISION_MARKERS)} THEN '10_decisions'
    WHEN {_ends(sorting.SOFTWARE_EXTENSIONS)} THEN '60_software' ELSE '00_inbox' END AS folder_rule FROM reported r LEFT JOIN hints USING (file_id)),
  suggested AS (SELECT r.*, r.parents[1] AS parent_id, coalesce(folder_name, folder_rule) AS suggested_target_folder, coalesce(folder_id, '') AS suggested_target_folder_id, coalesce(full_path, '/' || folder_rule) AS target_path,
    CASE WHEN folder_rule = '01_inbox_trash' THEN 'SWEEP_TRASH' ELSE 'SAFE' END AS action_mode, CASE WHEN folder_id IS NULL THEN 'ERROR: no target folder' ELSE '' END AS target_error
    FROM ruled r LEFT JOIN registry g ON g.folder_key = r.folder_rule WHERE r.seq % 20 <> 19)"""


def _hints(spark, sf_dir):
    d = F.col("doc_id")
    return read(spark, sf_dir, "documents").where(d % 8 == 0).select(F.concat(F.lit("f"), d).alias("file_id"), F.element_at(F.array(*map(F.lit, ["invoice", "notes", "vertrag"])), (d % 3 + 1).cast("int")).alias("topic_hint"))


def _registry(spark):
    rows = [("30_scripts", "Scripts", "s1", "/a/Scripts"), ("99_archive", "Archive", "s2", "/a/Archive"), ("00_inbox", "Inbox", "s3", "/a/Inbox"), ("01_inbox_trash", "Trash", "s4", "/a/Trash")]
    return F.broadcast(spark.createDataFrame(rows, "folder_key string, folder_name string, folder_id string, full_path string"))


def _suggested(spark, sf_dir):
    report, known = _reported_with_known(spark, sf_dir)
    report = report.checkpoint()
    done = report.where("seq % 20 = 19").select("run_id", "file_id")
    return sorting.sort_suggestions(report, known, _hints(spark, sf_dir), _registry(spark), done, sorting.default_rules(_MARKERS))


@query(f"WITH {_SORTED} SELECT file_id, folder_rule, suggested_target_folder, suggested_target_folder_id, target_path, action_mode, target_error FROM suggested")
def sort_suggestions(spark, sf_dir):
    return _suggested(spark, sf_dir).select("file_id", "folder_rule", "suggested_target_folder", "suggested_target_folder_id", "target_path", "action_mode", "target_error")


@query(f"""WITH {_SORTED}, live AS (SELECT file_id, CASE WHEN seq % 6 = 0 THEN ['s1'] WHEN seq % 6 = 1 THEN ['d77'] ELSE parents END AS now, seq % 31 = 0 AS gone FROM files WHERE seq % 14 <> 0)
  SELECT s.file_id, CASE WHEN l.file_id IS NULL THEN 'FAILED' WHEN gone THEN 'ALREADY_TRASHED' WHEN NOT list_contains(now, parent_id) AND NOT list_contains(now, suggested_target_folder_id) THEN 'STALE_PARENT'
    WHEN action_mode = 'SWEEP_TRASH' THEN 'TRASH' WHEN target_error <> '' THEN 'FAILED' WHEN list_contains(now, suggested_target_folder_id) THEN 'ALREADY_IN_TARGET' ELSE 'MOVE' END AS plan
  FROM suggested s LEFT JOIN live l USING (file_id)""")
def plan_moves(spark, sf_dir):
    n = F.col("seq")
    now = F.when(n % 6 == 0, F.array(F.lit("s1"))).when(n % 6 == 1, F.array(F.lit("d77"))).otherwise(F.col("parents"))
    live = files_of(read(spark, sf_dir, "documents")).where(n % 14 != 0).select("file_id", now.alias("parents"), (n % 31 == 0).alias("trashed"))
    return sorting.plan_moves(_suggested(spark, sf_dir), live).select("file_id", "plan")


@query(f"""WITH {_CLASSIFIED}, named AS (SELECT file_id, seq, name, CASE WHEN change_type IN {_REMOVALS} THEN '' ELSE substr(created_time, 1, 10) || '_{PROJECT}_' || name END AS suggested_name FROM classified),
  live AS (SELECT file_id, CASE WHEN seq % 5 = 0 THEN suggested_name WHEN seq % 5 = 1 THEN 'other' ELSE name END AS live_name FROM named WHERE seq % 14 <> 0)
  SELECT file_id, CASE WHEN live_name IS NULL THEN 'FAILED' WHEN live_name = suggested_name THEN 'ALREADY_RENAMED' WHEN live_name <> name THEN 'STALE_NAME' ELSE 'RENAME' END AS plan FROM named LEFT JOIN live USING (file_id) WHERE suggested_name <> ''""")
def plan_renames(spark, sf_dir):
    n = F.col("seq")
    report = inventory.suggest_names(_classified(spark, sf_dir), PROJECT).withColumn("rename_result", F.lit(""))
    live = report.where(n % 14 != 0).select("file_id", F.when(n % 5 == 0, F.col("suggested_name")).when(n % 5 == 1, "other").otherwise(F.col("name")).alias("name"))
    return sorting.plan_renames(report, live).select("file_id", "plan")


# --- records, rollups, views

_RECORDS = f"records AS ({RECORDS})"


def _records(spark, sf_dir):
    return event_records(read(spark, sf_dir, "events"))


@query(f"WITH {_RECORDS} SELECT record_id, source_id, record_type, event_time_start, event_date, title, external_id FROM records")
def event_record_index(spark, sf_dir):
    return _records(spark, sf_dir).select("record_id", "source_id", "record_type", "event_time_start", "event_date", "title", "external_id")


_list = lambda test, of="record_id": f"coalesce(string_agg({of}, ',' ORDER BY seq) FILTER ({test}), '')"
_DAILY = f"""{_RECORDS}, t AS (SELECT event_date, title, min(struct_pack(s := -importance_score, q := seq)) AS o FROM records GROUP BY ALL),
  k AS (SELECT event_date, string_agg(title, ',' ORDER BY o) AS key_events FROM (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY o) <= 15) GROUP BY event_date),
  daily AS (SELECT event_date AS date, count(*) || ' records on ' || event_date AS summary, any_value(key_events) AS key_events,
    {', '.join(f"array_to_string(list_sort(list_distinct(flatten(list({c})))), ',') AS {c}" for c in ("people", "places", "apps"))},
    {', '.join(f"{_list(f'contains(record_type, {chr(39)}{w}{chr(39)})')} AS {n}" for n, w in rollups.FAMILIES.items())}, {_list("starts_with(record_type, 'llm_')")} AS llm_activity, {_list("url <> ''", "url")} AS media_refs,
    array_to_string(list_sort(list_distinct(list(source_id))), ',') AS source_ids, {_list("true")} AS record_ids, CAST(round(sum(CAST(importance_score AS DECIMAL(18, 6))), 3) AS DOUBLE) AS importance_score,
    date_diff('day', CAST(event_date AS DATE), DATE '{AS_OF}') IN (1, 7, 30, 90) AS review_due, count(*) AS n
    FROM records LEFT JOIN k USING (event_date) GROUP BY event_date)"""
_DAILY_SQL = f"WITH {_DAILY} SELECT * EXCLUDE (n) FROM daily"
_DAILY_LISTS = ["key_events", "people", "places", "apps", *rollups.FAMILIES, "llm_activity", "media_refs", "source_ids", "record_ids"]


def _shown_daily(daily: DataFrame) -> DataFrame:
    return daily.select("date", "summary", *_joined(*_DAILY_LISTS), "importance_score", "review_due")


@query(_DAILY_SQL)
def daily_memory(spark, sf_dir):
    return _shown_daily(rollups.daily_memory(_records(spark, sf_dir), AS_OF))


@query(_DAILY_SQL)
def refresh_days(spark, sf_dir):
    """Equal to the full rollup, though it starts from one that lacks the last days' records."""
    records = _records(spark, sf_dir)
    late = F.col("event_date") >= "2024-01-25"
    before = rollups.daily_memory(records.where(~late | (F.col("seq") % 2 == 0)), AS_OF)
    return _shown_daily(rollups.refresh_days(before, records, records.where(late).select("event_date").distinct(), AS_OF))


_WEEKLY = f"""{_DAILY}, dated AS (SELECT date, strftime(CAST(date AS DATE), '%G-W%V') AS week, n, importance_score, str_split(key_events, ',') AS ke, str_split(people, ',') AS p, str_split(apps, ',') AS a FROM daily)"""
_top = lambda c: f"""(SELECT week, string_agg(x, ',' ORDER BY k) AS v FROM (SELECT week, x, row_number() OVER (PARTITION BY week ORDER BY count(*) DESC, min(struct_pack(d := date, i := i))) AS k
  FROM (SELECT week, date, unnest({c}) AS x, generate_subscripts({c}, 1) AS i FROM dated) GROUP BY week, x) WHERE k <= 5 GROUP BY week)"""  # noqa: E731


@query(f"""WITH {_WEEKLY}, e AS (SELECT week, x, min(struct_pack(d := date, i := i)) AS o FROM (SELECT week, date, unnest(ke) AS x, generate_subscripts(ke, 1) AS i FROM dated) GROUP BY week, x),
  h AS (SELECT week, string_agg(x, ',' ORDER BY o) AS weekly_highlights FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY week ORDER BY o) <= 10) GROUP BY week)
  SELECT week, string_agg(date, ',' ORDER BY date) AS days_covered, count(*) AS day_count, CAST(sum(n) AS BIGINT) AS total_records, CAST(round(sum(CAST(importance_score AS DECIMAL(18, 6))), 2) AS DOUBLE) AS total_importance,
    any_value(tp.v) AS top_people, any_value(ta.v) AS top_apps, any_value(weekly_highlights) AS weekly_highlights
  FROM dated JOIN {_top('p')} tp USING (week) JOIN {_top('a')} ta USING (week) JOIN h USING (week) GROUP BY week""")
def weekly_memory(spark, sf_dir):
    w = rollups.weekly_memory(rollups.daily_memory(_records(spark, sf_dir), AS_OF))
    return w.select("week", *_joined("days_covered"), "day_count", "total_records", "total_importance", *_joined("top_people", "top_apps", "weekly_highlights"))


@query(f"""WITH {_RECORDS} SELECT DISTINCT event_date FROM records WHERE day(CAST(event_date AS DATE)) % 3 = 0""")
def stale_days(spark, sf_dir):
    """Days of every third date lose all of their records."""
    r = _records(spark, sf_dir)
    return lifecycle.stale_partitions(r, r.where(F.day(F.to_date("event_date")) % 3 != 0), "event_date")


_VIEW = "'search::' || record_id AS search_id, event_date AS primary_date, compact_title, record_type, source_service, array_to_string(people, ',') AS related_people, array_to_string(topics, ',') AS related_topics, importance_score, url AS deep_link_hint"


def _view(spark, sf_dir, name):
    records = _records(spark, sf_dir)
    base = views.base_view(graph.link_entities(records, graph.entity_sources(records)) if name == "by_entity" else records)
    out = views.sorted_view(base, name) if name in views.SORT_KEYS else views.llm_view(base) if name == "llm" else base
    return out.select("search_id", "primary_date", "compact_title", "record_type", "source_service", *_joined("related_people", "related_topics"), "importance_score", "deep_link_hint", *(["sort_key"] if name in views.SORT_KEYS else []))


for _name, _key in (("by_date", ", event_date AS sort_key"), ("by_service", ", source_service AS sort_key"), ("by_topic", ", array_to_string(topics, '|') AS sort_key"), ("all", "")):
    query(f"WITH {_RECORDS} SELECT {_VIEW}{_key} FROM records", f"search_view_{_name}")(lambda spark, sf_dir, n=_name: _view(spark, sf_dir, n))
query(f"WITH {_RECORDS} SELECT {_VIEW} FROM records WHERE starts_with(record_type, 'llm_')", "search_view_llm")(lambda spark, sf_dir: _view(spark, sf_dir, "llm"))

_TEXTS = "texts AS (SELECT 'd' || doc_id AS record_id, substr(text, 1, 2000) AS t FROM documents WHERE length(text) >= 20)"


def _documents_as_records(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("d"), "doc_id").alias("record_id"), F.col("text").alias("raw_text"), F.lit("").alias("normalized_text"), F.col("source").alias("source_id"), F.lit("").alias("event_date"), F.lit("note").alias("record_type"), F.lit("").alias("title"), F.col("lang").alias("source_app"))


@query(f"WITH {_TEXTS} SELECT record_id, md5(lower(t)) AS text_md5 FROM texts")
def fulltext_view(spark, sf_dir):
    return views.fulltext_view(_documents_as_records(spark, sf_dir)).select("record_id", F.md5("searchable_text").alias("text_md5"))


@query(f"WITH {_TEXTS} SELECT record_id FROM texts WHERE contains(lower(t), 'the') AND contains(lower(t), 'and')")
def search_fulltext(spark, sf_dir):
    return views.search_fulltext(views.fulltext_view(_documents_as_records(spark, sf_dir)), ["The", "and"]).select("record_id")


@query(f"""WITH {_TEXTS.replace('substr(text, 1, 2000)', 'text')}, w AS (SELECT record_id, unnest(regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+')) AS term FROM texts)
  SELECT record_id, count(*) AS score FROM w WHERE term IN ('the', 'of') GROUP BY record_id HAVING count(DISTINCT term) = 2""")
def inverted_index_lookup(spark, sf_dir):
    return views.lookup(views.inverted_index(views.fulltext_view(_documents_as_records(spark, sf_dir), max_chars=None)), ["the", "of"])


# --- statistics


@query(f"WITH {_RECORDS} SELECT record_type, count(*) AS n, min(event_date) AS first_date, max(event_date) AS last_date FROM records GROUP BY GROUPING SETS ((record_type), ())")
def record_stats(spark, sf_dir):
    return stats.record_stats(_records(spark, sf_dir))


@query(f"WITH {_RECORDS} SELECT source_id, array_to_string(list_sort(list_distinct(flatten(list(apps)))), ',') AS apps, array_to_string(list_sort(list_distinct(flatten(list(topics)))), ',') AS topics FROM records GROUP BY source_id")
def profile_fragments(spark, sf_dir):
    return stats.profile_fragments(_records(spark, sf_dir)).select("source_id", *_joined("apps", "topics"))


@query("SELECT 'run' || event_id % 5 AS run_id, event_type AS phase, CAST(sum(CAST(value AS BIGINT)) AS BIGINT) AS files_processed, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY ALL")
def run_summary(spark, sf_dir):
    log = read(spark, sf_dir, "events").select(F.concat(F.lit("run"), F.col("event_id") % 5).alias("run_id"), F.col("event_type").alias("phase"), F.bround("value").cast("long").alias("files_processed"), (F.col("event_type") == "error").cast("long").alias("errors"))
    return stats.run_summary(log)


@query("SELECT event_id AS seq, event_type FROM events ORDER BY event_id DESC LIMIT 500")
def compact_log(spark, sf_dir):
    return stats.compact_log(read(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 3 = 0")
def upsert(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return lifecycle.upsert(orders, orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("new")), "o_orderkey")


# --- entities and relations

_MENTIONS = f"""{_RECORDS}, mentions AS (SELECT source_id, seq, e.t AS entity_type, lower(e.n) AS canonical_name, e.n AS display_name FROM (SELECT source_id, seq, unnest(
    list_concat(list_concat(list_transform(apps, lambda x: struct_pack(t := 'app', n := x)), list_transform(topics, lambda x: struct_pack(t := 'topic', n := x))),
    list_concat(list_transform(people, lambda x: struct_pack(t := 'person', n := x)), [struct_pack(t := 'place', n := place_name)]))) AS e FROM records)),
  src AS (SELECT source_id, min(event_date) AS first_seen, max(event_date) AS last_seen, count(*) AS records FROM records GROUP BY 1),
  child AS (SELECT 'ent::' || substr(sha256('{{"canonical_name":"' || canonical_name || '","entity_type":"' || entity_type || '"}}'), 1, 20) AS entity_id, source_id, entity_type, canonical_name, count(*) AS mentions, any_value(first_seen) AS first_seen, any_value(last_seen) AS last_seen, any_value(records) AS records
    FROM mentions JOIN src USING (source_id) GROUP BY source_id, entity_type, canonical_name)"""


query(f"WITH {_MENTIONS}, first AS (SELECT source_id, min(entity_id) AS sort_key FROM child GROUP BY 1) SELECT {_VIEW}, sort_key FROM records JOIN first USING (source_id)", "search_view_by_entity")(lambda spark, sf_dir: _view(spark, sf_dir, "by_entity"))


@query(f"WITH {_MENTIONS} SELECT entity_id, source_id, entity_type, canonical_name, mentions, first_seen, last_seen, records FROM child")
def entity_sources(spark, sf_dir):
    return graph.entity_sources(_records(spark, sf_dir)).select("entity_id", "source_id", "entity_type", "canonical_name", "mentions", "first_seen", "last_seen", "records")


@query(f"""WITH {_MENTIONS} SELECT entity_id, any_value(entity_type) AS entity_type, any_value(canonical_name) AS canonical_name, min(first_seen) AS first_seen, max(last_seen) AS last_seen, string_agg(source_id, ',' ORDER BY source_id) AS source_ids,
  CAST(sum(records) AS BIGINT) AS related_record_count, CAST(sum(mentions) AS BIGINT) AS mentions FROM child GROUP BY entity_id""")
def merge_entities(spark, sf_dir):
    e = graph.merge_entities(graph.entity_sources(_records(spark, sf_dir)))
    return e.select("entity_id", "entity_type", "canonical_name", "first_seen", "last_seen", *_joined("source_ids"), "related_record_count", "mentions")


@query(f"WITH {_MENTIONS}, per AS (SELECT source_id, string_agg(entity_id, ',' ORDER BY entity_id) AS v FROM child GROUP BY 1) SELECT record_id, md5(v) AS entities_md5 FROM records JOIN per USING (source_id)")
def link_entities(spark, sf_dir):
    r = _records(spark, sf_dir)
    return graph.link_entities(r, graph.entity_sources(r)).select("record_id", F.md5(F.array_join("related_entity_ids", ",")).alias("entities_md5"))


_ENT = lambda t, n: f"""'ent::' || substr(sha256('{{"canonical_name":"' || {n} || '","entity_type":"' || {t} || '"}}'), 1, 20)"""
_RELATIONS = f"""{_RECORDS}, edges AS (SELECT source_id, external_id, event_time_start, seq, 1 AS nth, topics[1] AS s, 'topic' AS st, 'mentions' AS p, title AS o, 'topic' AS ot, 0.8 AS c, record_id FROM records
    UNION ALL SELECT source_id, external_id, event_time_start, seq, 2, people[1], 'person', 'visited', place_name, 'place', 0.75, record_id FROM records
    UNION ALL SELECT source_id, external_id, event_time_start, seq, 3, people[1], 'person', 'used_app', apps[1], 'app', 0.75, record_id FROM records),
  firsts AS (SELECT * FROM edges QUALIFY row_number() OVER (PARTITION BY source_id, s, p, o ORDER BY seq, nth) = 1),
  ends AS (SELECT *, {_ENT('st', 's')} AS si, {_ENT('ot', 'o')} AS oi FROM firsts),
  rel AS (SELECT 'rel::' || substr(sha256('{{"evidence":["' || record_id || '"],"object":"' || oi || '","predicate":"' || p || '","subject":"' || si || '"}}'), 1, 20) AS relation_id, source_id, si AS subject_entity_id, p AS predicate, oi AS object_entity_id, event_time_start AS time_start, record_id AS evidence, CAST(c AS DOUBLE) AS confidence FROM ends)"""


@query(f"WITH {_RELATIONS} SELECT * FROM rel")
def source_relations(spark, sf_dir):
    r = graph.source_relations(_records(spark, sf_dir))
    return r.select("relation_id", "source_id", "subject_entity_id", "predicate", "object_entity_id", "time_start", F.array_join("evidence_record_ids", ",").alias("evidence"), "confidence")


@query(f"WITH {_RELATIONS} SELECT relation_id, min(time_start) AS time_start, string_agg(source_id, ',' ORDER BY source_id) AS source_ids FROM rel GROUP BY relation_id")
def merge_relations(spark, sf_dir):
    return graph.merge_relations(graph.source_relations(_records(spark, sf_dir))).select("relation_id", "time_start", *_joined("source_ids"))


@query(f"""WITH {_RELATIONS}, m AS (SELECT source_id, count(DISTINCT (t, n)) AS entity_count FROM (SELECT source_id, unnest(list_concat([struct_pack(t := 'app', n := apps[1]), struct_pack(t := 'topic', n := topics[1])], [struct_pack(t := 'person', n := people[1]), struct_pack(t := 'place', n := place_name)]), recursive := true) FROM records) GROUP BY 1)
  SELECT r.source_id, r.record_count, m.entity_count, x.relation_count FROM (SELECT source_id, count(*) AS record_count FROM records GROUP BY 1) r JOIN m USING (source_id) JOIN (SELECT source_id, count(*) AS relation_count FROM rel GROUP BY 1) x USING (source_id)""")
def source_summary(spark, sf_dir):
    r = _records(spark, sf_dir)
    return stats.source_summary(r, graph.entity_sources(r), graph.source_relations(r))


@query(f"WITH {_MENTIONS} SELECT entity_type, count(DISTINCT entity_id) AS n FROM child GROUP BY 1")
def entity_counts(spark, sf_dir):
    return stats.counts_by(graph.merge_entities(graph.entity_sources(_records(spark, sf_dir))), "entity_type")


# --- lifecycle

_SOURCES = f"{_RECORDS}, sources AS (SELECT source_id, file_id, CAST(substr(file_id, 2) AS INTEGER) AS u, 'f' || CAST(substr(file_id, 2) AS INTEGER) // 10 AS bundle_id FROM records GROUP BY ALL)"


def _sources(spark, sf_dir):
    u = F.substring("file_id", 2, 20).cast("int")
    rows = _records(spark, sf_dir).select("source_id", "file_id").distinct()
    return rows.withColumns({"u": u, "bundle_id": F.concat(F.lit("f"), F.floor(u / 10)), "change_type": F.when(u % 7 == 0, "DELETED").otherwise("UPDATED"), "bundle_change_type": F.when(u % 20 < 3, "TRASHED").otherwise("")})


def _exclusions(spark, sf_dir):
    u = F.col("u")
    return _sources(spark, sf_dir).where(u % 4 == 0).select("file_id", F.when(u % 12 == 0, "PURGED").when(u % 8 == 0, "ACTIVE").otherwise("EXCLUDED").alias("status"))


_EXCLUSIONS = "exclusions AS (SELECT file_id, CASE WHEN u % 12 = 0 THEN 'PURGED' WHEN u % 8 = 0 THEN 'ACTIVE' ELSE 'EXCLUDED' END AS status FROM sources WHERE u % 4 = 0)"


@query(f"""WITH {_SOURCES}, {_EXCLUSIONS} SELECT s.file_id, coalesce(e.status, CASE WHEN u % 7 = 0 THEN 'EXCLUDED' END, b.status, CASE WHEN u % 20 < 3 THEN 'EXCLUDED' END, 'ACTIVE') AS knowledge_status
  FROM sources s LEFT JOIN exclusions e ON e.file_id = s.file_id LEFT JOIN exclusions b ON b.file_id = s.bundle_id""")
def apply_exclusions(spark, sf_dir):
    return lifecycle.apply_exclusions(_sources(spark, sf_dir), _exclusions(spark, sf_dir)).select("file_id", "knowledge_status")


def _purged(spark, sf_dir):
    r = _records(spark, sf_dir)
    child = graph.entity_sources(r)
    indices = {"sources": _sources(spark, sf_dir), "records": r, "entities": graph.merge_entities(child), "relations": graph.merge_relations(graph.source_relations(r))}
    return lifecycle.purge(indices, _exclusions(spark, sf_dir))


_GONE = f"{_EXCLUSIONS}, p AS (SELECT file_id FROM exclusions WHERE status = 'PURGED'), gone AS (SELECT file_id FROM p UNION SELECT file_id FROM sources WHERE bundle_id IN (SELECT file_id FROM p))"


@query(f"WITH {_SOURCES}, {_GONE} SELECT record_id FROM records WHERE file_id NOT IN (SELECT file_id FROM gone)")
def purge_records(spark, sf_dir):
    return _purged(spark, sf_dir)["records"].select("record_id")


@query(f"WITH {_MENTIONS}, {_SOURCES.removeprefix(_RECORDS + ', ')}, {_GONE} SELECT DISTINCT entity_id FROM child WHERE source_id NOT IN (SELECT source_id FROM sources WHERE file_id IN (SELECT file_id FROM gone))")
def purge_entities(spark, sf_dir):
    return _purged(spark, sf_dir)["entities"].select("entity_id")


@query(f"WITH {_RELATIONS}, {_SOURCES.removeprefix(_RECORDS + ', ')}, {_GONE} SELECT DISTINCT relation_id FROM rel WHERE source_id NOT IN (SELECT source_id FROM sources WHERE file_id IN (SELECT file_id FROM gone))")
def purge_relations(spark, sf_dir):
    return _purged(spark, sf_dir)["relations"].select("relation_id")


@query(f"WITH {_RECORDS} SELECT file_id, arg_max(topics[1], seq) AS topic_hint FROM records GROUP BY file_id")
def topic_hints(spark, sf_dir):
    return sorting.topic_hints(_records(spark, sf_dir))


# --- exports

_FACTS = {"chatgpt_export": ("chatgpt", "m1", 0.95, 0.7, 0.9, 0.45, "chat", "chat"), "claude_export": ("claude", "claude", 0.95, 0.75, 0.9, 0.45, "", ""), "gemini_chat_export": ("gemini", "gemini", 0.93, 0.7, 0.9, 0.4, "", ""), "llm_json_transcript": ("m1", "m1", 0.85, 0.6, 0.8, 0.4, "", "")}


def _parsed(spark, sf_dir, shape):
    resolved = rules.resolve_parser(chat_exports(read(spark, sf_dir, "conversations"), shape))
    return exports.parse_sources(exports.build_sources(resolved.drop("text_preview"), PROJECT, INGESTED), INGESTED, [shape])


def _chat_query(shape: str):
    def run(spark, sf_dir):
        r = _parsed(spark, sf_dir, shape)
        return r.select("file_id", "parser_name", "record_type", "subtype", "title", "summary", F.md5("raw_text").alias("raw_md5"), *_joined("apps", "topics"), "external_id", "event_date", "confidence", "importance_score")

    return run


def _chat_sql(shape: str) -> str:
    app, subtype, c1, i1, c2, i2, t1, t2 = _FACTS[shape]
    cut = 500 if shape == "chatgpt_export" else 300
    summary = {"chatgpt_export": "count(*) || ' turns with model m1'", "claude_export": "count(*) || ' messages'", "gemini_chat_export": "count(*) || ' turns'", "llm_json_transcript": "count(*) || ' messages, model: m1'"}[shape]
    return f"""SELECT '{shape}-' || conv_id AS file_id, '{shape}' AS parser_name, 'llm_conversation' AS record_type, '{subtype}' AS subtype, 'Chat ' || conv_id AS title, {summary} AS summary, md5(string_agg(substr(text, 1, {cut}), chr(10) ORDER BY turn)) AS raw_md5,
        '{app}' AS apps, '{t1}' AS topics, 'c' || conv_id AS external_id, '2024-03-05' AS event_date, CAST({c1} AS DOUBLE) AS confidence, CAST({i1} AS DOUBLE) AS importance_score FROM conversations GROUP BY conv_id
      UNION ALL SELECT '{shape}-' || conv_id, '{shape}', 'llm_turn', role, 'Turn ' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) || ' (' || role || ')', substr(text, 1, 200), md5(text), '{app}', '{t2}', 'c' || conv_id || '-' || turn, '2024-03-05', CAST({c2} AS DOUBLE), CAST({i2} AS DOUBLE) FROM conversations"""


for _shape in _FACTS:
    query(_chat_sql(_shape), f"parse_{_shape}")(_chat_query(_shape))


@query("""SELECT file_id, record_type, subtype, title, external_id, confidence, importance_score FROM (SELECT 'perplexity_export-' || conv_id AS file_id, 'llm_conversation' AS record_type, 'perplexity_thread' AS subtype, 'Chat ' || conv_id AS title, 'c' || conv_id AS external_id, CAST(0.8 AS DOUBLE) AS confidence, CAST(0.5 AS DOUBLE) AS importance_score FROM conversations GROUP BY conv_id
  UNION SELECT 'perplexity_export-' || conv_id, 'llm_turn', role, 'Turn (' || role || ') in Chat ' || conv_id, '', CAST(0.8 AS DOUBLE), CAST(0.5 AS DOUBLE) FROM conversations)""")
def parse_perplexity_export(spark, sf_dir):
    return _parsed(spark, sf_dir, "perplexity_export").select("file_id", "record_type", "subtype", "title", "external_id", "confidence", "importance_score")


def _export(rows: DataFrame, name: str, content=None, raw=None) -> DataFrame:
    """One source per row of ``rows`` (k, ...), named for its job."""
    ext = ".ics" if raw is not None and "calendar" in name else ".txt" if raw is not None else ".json"
    return rows.select(
        F.concat(F.lit(name + "-"), "k").alias("file_id"), F.concat(F.lit(f"in/{name}-"), "k", F.lit(ext)).alias("source_path"), F.concat(F.lit(f"{name}-"), "k", F.lit(ext)).alias("original_filename"), (F.to_json(content) if content is not None else F.lit("{}")).alias("content"), (raw if raw is not None else F.lit("")).alias("raw_text"), F.lit("").alias("text_preview")
    )


def _records_of(sources: DataFrame, job: str, only: bool = False) -> DataFrame:
    """``only``: the rule alone, where an earlier one would take such files too."""
    known = [r for r in rules.RULES if r.name == job] if only else rules.RULES
    out = exports.parse_sources(exports.build_sources(rules.resolve_parser(sources, known), PROJECT, INGESTED), INGESTED, [job])
    return out.select("file_id", "parser_name", "record_type", "subtype", "title", "summary", "event_time_start", "event_date", *_joined("people", "places", "apps", "topics"), "external_id", "url", "status", "confidence", "importance_score")


def _events_by_user(spark, sf_dir, item):
    e = read(spark, sf_dir, "events").withColumn("at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.groupBy(F.col("user_id").alias("k")).agg(F.array_sort(F.collect_list(F.struct("event_id", item.alias("x")))).alias("i")).withColumn("i", F.transform("i", lambda v: v["x"]))


_EV = "SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS began FROM events"
_OUT = "event_time_start, substr(event_time_start, 1, 10) AS event_date, people, places, apps, topics, external_id, url, status, CAST(confidence AS DOUBLE) AS confidence, CAST(importance_score AS DOUBLE) AS importance_score"


def _item_sql(name: str, **c: str) -> str:
    base = {"summary": "''", "event_time_start": "''", "people": "''", "places": "''", "apps": "''", "topics": "''", "external_id": "''", "url": "''", "status": "'active'", "confidence": "0.8", "importance_score": "0.5"} | c
    shown = ", ".join(f"{v} AS {k}" for k, v in base.items())
    return f"SELECT file_id, '{name}' AS parser_name, record_type, subtype, title, summary, {_OUT} FROM (SELECT '{name}-' || user_id AS file_id, {shown} FROM ({_EV}))"


@query(_item_sql("google_play_installs", record_type="'app_install'", subtype="'store'", title="'Install ' || event_type", summary="event_type || ' on dev'", event_time_start="began", apps="event_type", topics="'install,google_play'", external_id="'p' || event_id", confidence="0.95", importance_score="0.7"))
def parse_google_play_installs(spark, sf_dir):
    item = F.struct(F.col("event_type").alias("app_name"), F.concat(F.lit("p"), "event_id").alias("package_name"), F.col("at").alias("installed_at"), F.lit("dev").alias("device"), F.lit("store").alias("install_source"))
    return _records_of(_export(_events_by_user(spark, sf_dir, item), "google_play_installs", F.struct(F.col("i").alias("installed_apps"))), "google_play_installs")


@query(_item_sql("google_my_activity", record_type="'activity_event'", subtype="'Maps'", title="'Did ' || event_type", summary="props", event_time_start="began", apps="'Maps'", topics="event_type", external_id="'a' || event_id", url="'http://x/' || event_id", confidence="0.9", importance_score="0.55"))
def parse_google_my_activity(spark, sf_dir):
    item = F.struct(F.concat(F.lit("a"), "event_id").alias("id"), F.col("at").alias("time"), F.lit("Maps").alias("product"), F.col("event_type").alias("type"), F.concat(F.lit("Did "), "event_type").alias("title"), F.col("props").alias("description"), F.concat(F.lit("http://x/"), "event_id").alias("url"))
    return _records_of(_export(_events_by_user(spark, sf_dir, item), "google_my_activity", F.struct(F.col("i").alias("activity"))), "google_my_activity")


@query(f"""SELECT DISTINCT 'google_timeline-' || user_id AS file_id, 'place_visit' AS record_type, 'Visited P' || event_id % 9 AS title, began AS event_time_start, 'P' || event_id % 9 AS place_name, CAST((event_id % 9 + 1) * 10000000 AS DOUBLE) / 1e7 AS geo_lat, CAST(NULL AS DOUBLE) AS geo_lon FROM ({_EV})""")
def parse_google_timeline(spark, sf_dir):
    where = F.struct(F.concat(F.lit("P"), F.col("event_id") % 9).alias("name"), ((F.col("event_id") % 9 + 1) * 10000000).alias("latitudeE7"), F.lit(0).alias("longitudeE7"))
    item = F.struct(F.struct(where.alias("location"), F.struct(F.col("at").alias("startTimestamp")).alias("duration")).alias("placeVisit"))
    sources = _export(_events_by_user(spark, sf_dir, item), "google_timeline", F.struct(F.col("i").alias("timeline_objects")))
    out = exports.parse_sources(exports.build_sources(rules.resolve_parser(sources), PROJECT, INGESTED), INGESTED, ["google_timeline"])
    return out.select("file_id", "record_type", "title", "event_time_start", "place_name", "geo_lat", "geo_lon")


@query(_item_sql("google_tasks", record_type="'task'", subtype="'todo'", title="event_type", summary="'n' || event_id", event_time_start="began", external_id="'t' || event_id", status="'done'"))
def parse_google_tasks(spark, sf_dir):
    item = F.struct(F.concat(F.lit("t"), "event_id").alias("id"), F.col("event_type").alias("title"), F.concat(F.lit("n"), "event_id").alias("notes"), F.col("at").alias("updated"), F.lit("done").alias("status"))
    return _records_of(_export(_events_by_user(spark, sf_dir, item), "google_tasks", F.struct(F.col("i").alias("items"))), "google_tasks")


@query("""SELECT 'google_contacts-' || c_nationkey AS file_id, 'Contact: ' || c_name AS title, c_name AS people, 'c' || c_custkey AS external_id FROM customer""")
def parse_google_contacts(spark, sf_dir):
    c = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.collect_list(F.struct(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("name"))).alias("contacts"))
    return _records_of(_export(c, "google_contacts", F.struct("contacts")), "google_contacts").select("file_id", "title", "people", "external_id")


@query(f"""SELECT DISTINCT 'instagram_messages-' || user_id AS file_id, 'Instagram message from S' || event_id % 3 AS title, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE '.250000Z' END AS event_time_start FROM events""")
def parse_instagram_export(spark, sf_dir):
    ms = F.unix_millis(F.date_trunc("second", "ts")) + F.when(F.col("event_id") % 2 == 0, 0).otherwise(250)
    item = F.struct(F.concat(F.lit("S"), F.col("event_id") % 3).alias("sender_name"), F.col("event_type").alias("content"), ms.alias("timestamp_ms"))
    e = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.collect_list(item).alias("i"))
    return _records_of(_export(e, "instagram_messages", F.struct(F.col("i").alias("messages"), F.array().cast("array<string>").alias("participants"))), "instagram_export", only=True).select("file_id", "title", "event_time_start")


@query(f"""SELECT DISTINCT 'whatsapp-' || user_id AS file_id, 'S' || event_id % 3 || ': ' || event_type AS title, CASE WHEN user_id % 2 = 0 THEN began ELSE substr(began, 1, 17) || '00Z' END AS event_time_start, CAST(CASE WHEN user_id % 2 = 0 THEN 0.92 ELSE 0.9 END AS DOUBLE) AS confidence FROM ({_EV})
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, event_id % 3, CASE WHEN user_id % 2 = 0 THEN began ELSE substr(began, 1, 17) END ORDER BY event_id) = 1""")
def parse_whatsapp_export(spark, sf_dir):
    eu, us = (F.date_format("ts", f) for f in ("'['dd.MM.yyyy, HH:mm:ss'] '", "M/d/yy, h:mm a' - '"))
    line = F.concat(F.when(F.col("user_id") % 2 == 0, eu).otherwise(us), F.lit("S"), F.col("event_id") % 3, F.lit(": "), "event_type")
    e = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("x")))), lambda v: v["x"]), "\n").alias("raw"))
    return _records_of(_export(e, "whatsapp", raw=F.col("raw")), "whatsapp_export").select("file_id", "title", "event_time_start", "confidence")


@query(f"""SELECT 'telegram-' || user_id AS file_id, 'Message from S' || event_id % 3 || ' in Chat' AS title, began AS event_time_start, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'see ' || event_type END AS summary, CAST(event_id AS VARCHAR) AS external_id FROM ({_EV}) WHERE event_id % 5 <> 0""")
def parse_telegram_export(spark, sf_dir):
    n = F.col("event_id")
    body = F.when(n % 2 == 0, F.to_json(F.array("event_type"))).otherwise(F.concat(F.lit('["see ",{"type":"bold","text":"'), "event_type", F.lit('"}]')))
    message = F.concat(F.lit('{"id":'), n, F.lit(',"type":"'), F.when(n % 5 == 0, "service").otherwise("message"), F.lit('","date":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('","from":"S'), n % 3, F.lit('","text":'), body, F.lit("}"))
    e = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.array_join(F.collect_list(message), ",").alias("m"))
    content = F.concat(F.lit('{"chats":{"list":[{"id":7,"name":"Chat","messages":['), "m", F.lit("]}]}}"))
    sources = _export(e.withColumn("content", content), "telegram", F.struct("k")).drop("content").join(e.select(F.concat(F.lit("telegram-"), "k").alias("file_id"), content.alias("content")), "file_id")
    return _records_of(sources, "telegram_export").select("file_id", "title", "event_time_start", "summary", "external_id")


@query(f"""SELECT 'google_calendar-' || user_id AS file_id, event_type AS title, CASE event_id % 3 WHEN 0 THEN began WHEN 1 THEN substr(began, 1, 19) ELSE substr(began, 1, 10) END AS event_time_start, 'R' || event_id % 4 AS places, 'u' || event_id AS external_id, 'long note' AS summary FROM ({_EV})""")
def parse_google_calendar(spark, sf_dir):
    n = F.col("event_id")
    start = F.when(n % 3 == 0, F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'")).when(n % 3 == 1, F.date_format("ts", "yyyyMMdd'T'HHmmss")).otherwise(F.date_format("ts", "yyyyMMdd"))
    block = F.concat(F.lit("BEGIN:VEVENT\r\nDTSTART:"), start, F.lit("\r\nSUMMARY:"), "event_type", F.lit("\r\nDESCRIPTION:long \r\n note\r\nLOCATION:R"), n % 4, F.lit("\r\nUID:u"), n, F.lit("\r\nEND:VEVENT"))
    e = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.array_join(F.collect_list(block), "\r\n").alias("raw"))
    return _records_of(_export(e, "google_calendar", raw=F.col("raw")), "google_calendar").select("file_id", "title", "event_time_start", "places", "external_id", F.regexp_replace("summary", " +", " ").alias("summary"))


@query(_item_sql("generic_json_export", record_type="'note'", subtype="'item'", title="event_type", summary="'s'", event_time_start="began", topics="'x'", external_id="'g' || event_id", confidence="0.6", importance_score="0.4").replace("'generic_json_export-' || user_id", "'generic-' || user_id"))
def parse_generic_json_export(spark, sf_dir):
    item = F.struct(F.concat(F.lit("g"), "event_id").alias("id"), F.lit("note").alias("record_type"), F.col("at").alias("timestamp"), F.col("event_type").alias("title"), F.lit("s").alias("summary"), F.array(F.lit("x")).alias("topics"))
    return _records_of(_export(_events_by_user(spark, sf_dir, item), "generic", F.struct(F.col("i").alias("items"))), "generic_json_export")


#: (path, name, preview, content, rule): each rule by a token or by keys, tests of their own both ways, and names that several rules would take.
PROBES = [
    ("in", "ChatGPT.json", "", "{}", "chatgpt_export"), ("in", "a.json", "", '{"conversations": [{"turns": [], "model": "m"}]}', "chatgpt_export"), ("in", "Claude.json", "", "{}", "claude_export"), ("in", "b.json", "", '[{"chat_messages": []}]', "claude_export"),
    ("in", "Gemini.json", "", '{"conversations": [{"turns": []}]}', "gemini_chat_export"), ("in", "c.json", "", '{"messages": []}', "llm_json_transcript"), ("in", "Transcript.bin", "", "{}", "llm_json_transcript"), ("in", "perplexity.json", "", "{}", "perplexity_export"),
    ("in", "x.bin", "a notebooklm page", "{}", "notebooklm_artifacts"), ("my Prompts", "x.bin", "", "{}", "prompt_bundle"), ("in", "page.html", "", "{}", "llm_html_export"), ("in", "llm-markdown.bin", "", "{}", "llm_markdown_bundle"), ("in", "d.bin", "", '{"installed_apps": []}', "google_play_installs"),
    ("in", "display.bin", "", "{}", "google_play_installs"), ("in", "subscription.bin", "", "{}", "google_play_subscriptions"), ("in", "purchase.bin", "", "{}", "google_play_purchases"), ("in", "order.bin", "", "{}", "google_play_orders"), ("in", "device.bin", "", "{}", "google_play_devices"),
    ("in", "library.bin", "", "{}", "google_play_library"), ("My Activity", "x.bin", "", "{}", "google_my_activity"), ("in", "e.bin", "", '{"activity": []}', "google_my_activity"), ("in", "maps.bin", "", "{}", "google_maps_places"), ("in", "f.bin", "", '{"timeline_objects": []}', "google_timeline"),
    ("in", "x.ics", "", "{}", "google_calendar"), ("in", "tasks.bin", "", "{}", "google_tasks"), ("in", "contacts.bin", "", "{}", "google_contacts"), ("in", "keep.bin", "", "{}", "google_keep"), ("in", "mail.mbox", "", "{}", "gmail_export"), ("in", "docs.bin", "", "{}", "google_drive_export"),
    ("in", "gemini_export.bin", "", "{}", "gemini_exports"), ("in", "instagram.bin", "", '{"participants": []}', "instagram_export"), ("in", "facebook.bin", "", "{}", "facebook_export"), ("in", "messenger.bin", "", "{}", "messenger_export"), ("in", "threads.bin", "", "{}", "threads_export"),
    ("WhatsApp", "x.bin", "", "{}", "whatsapp_export"), ("in", "g.bin", "1/2/24, 9:05 AM - A: hi", "{}", "whatsapp_export"), ("telegram", "x.bin", "", '{"chats": {}}', "telegram_export"), ("in", "Signal.bin", "", "{}", "signal_export"), ("in", "h.json", "", "{}", "generic_json_export"),
    ("in", "table.csv", "", "{}", "generic_csv_export"), ("in", "x.txt", "", "{}", "generic_txt_export"), ("in", "x.zip", "", "{}", "generic_zip_bundle"), ("Takeout", "x.bin", "", "{}", "generic_zip_bundle"), ("in", "plain.bin", "", "{}", "generic_txt_export"), ("in", "telegram.bin", "", "{}", "generic_txt_export"),
]
_quoted = lambda x: "'" + x.replace("'", "''") + "'"


@query(f"""WITH probes AS (SELECT * FROM (VALUES {', '.join(f"({k}, {_quoted(p[4])})" for k, p in enumerate(PROBES))}) t(k, parser_name)), facts AS (SELECT * FROM (VALUES {', '.join(f"({', '.join(map(_quoted, (r.name, r.version, r.system, r.record_type)))})" for r in rules.RULES)}) t(parser_name, version, system, record_type))
  SELECT doc_id, parser_name, version, system, record_type FROM documents JOIN probes ON k = doc_id % {len(PROBES)} JOIN facts USING (parser_name)""")
def resolve_parser(spark, sf_dir):
    """Sources that between them meet the rules of all jobs, by tokens, keys and previews."""
    at = (F.col("doc_id") % len(PROBES)).cast("int")
    columns = {c: F.get(F.array(*[F.lit(p[i]) for p in PROBES]), at) for i, c in enumerate(("folder", "original_filename", "text_preview", "content"))}
    rows = read(spark, sf_dir, "documents").select("doc_id", *[v.alias(k) for k, v in columns.items()]).withColumn("source_path", F.concat_ws("/", "folder", "original_filename"))
    return rules.resolve_parser(rows).select("doc_id", "parser_name", F.col("parser_version").alias("version"), F.col("source_system").alias("system"), F.col("default_record_type").alias("record_type"))


# --- text, paths, ids


@query(r"""SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, sha256(html) AS html_sha256, md5(html) AS html_md5, substr(html, 1, 200) AS summary FROM pages""")
def page_sources(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", T.slug(F.col("url")).alias("slug"), F.sha2("html", 256).alias("html_sha256"), F.md5("html").alias("html_md5"), F.substring("html", 1, 200).alias("summary"))


@query("SELECT page_id, 'b/' || page_id || '.html' AS path, page_id || '-x.html' AS normalized, '.html' AS ext FROM pages")
def page_paths(spark, sf_dir):
    raw = F.concat(F.lit("/a/../b\\./c/../"), "page_id", F.lit(".html"))
    return read(spark, sf_dir, "pages").select("page_id", T.clean_path(raw).alias("path"), T.normalized_filename(F.concat("page_id", F.lit(" X.HTML"))).alias("normalized"), T.extension(raw).alias("ext"))


@query("SELECT event_id, sha256('{\"k\":' || json_extract_string(props, '$.k') || '}') AS hash FROM events")
def content_hash(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", ids.content_hash(F.col("props")).alias("hash"))


@query("SELECT o_orderkey, sha256('k=' || o_orderkey || '|s=' || o_orderstatus) AS hash FROM orders")
def flat_hash(spark, sf_dir):
    m = F.create_map(F.lit("s"), F.col("o_orderstatus"), F.lit("k"), F.col("o_orderkey").cast("string"))
    return read(spark, sf_dir, "orders").select("o_orderkey", ids.flat_hash(m).alias("hash"))


# --- the stream


@query(f"WITH {_ROUTED}, " + """h AS (SELECT *, coalesce(status, 'hash') AS route, CASE WHEN status IS NULL THEN sha256(text) ELSE sha256 END AS sha FROM (SELECT f.*, CASE WHEN removed AND explicitly_deleted THEN 'DELETED' WHEN trashed THEN 'TRASHED' WHEN removed AND scope_exit THEN 'MOVED_OUT_OF_SCOPE' WHEN removed THEN 'REMOVED_OR_NO_ACCESS' END AS status, '' AS sha256 FROM files f)),
  own AS (SELECT sha, arg_min(file_id, seq) AS first FROM h WHERE status IS NULL GROUP BY 1)
  SELECT file_id, CASE WHEN route <> 'hash' THEN route WHEN first = file_id THEN 'ORIGINAL' ELSE 'DUPLICATE' END AS status, CASE WHEN route = 'hash' AND first <> file_id THEN first ELSE '' END AS duplicate_of FROM h LEFT JOIN own USING (sha)""")
def stream_inventory(spark, sf_dir):
    """All documents as changes, read as a stream; equal to one batch over the same rows."""
    import uuid

    from shelfmark.streaming import inventory as stream

    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    changes = read(spark, sf_dir, "documents")
    changes.write.parquet(f"{root}/changes")
    stream.stream_inventory(spark, f"{root}/changes", changes.schema, root, f"{root}/checkpoint", max_files=1000, limit_mb=500, prepare=files_of, buckets=4)
    return stream.read_reports(spark, root).select("file_id", "status", "duplicate_of")

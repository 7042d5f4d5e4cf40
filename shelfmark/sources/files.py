"""Files as rows: a tree of files, the sources made of them, archives' members, and the delta export."""

from __future__ import annotations

import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.ids import first_set, is_set, text
from shelfmark.functions.text import PARSEABLE, canonical_format, clean_path, extension, parseable_mime
from shelfmark.operators.inventory import REMOVALS
from shelfmark.sources.archives import MEMBER_LIMIT, broken_archive, in_batches, member_rows

#: Extensions of archives.
ARCHIVES = (".zip", ".tar", ".gz")
SUMMARY_CHARS, PREVIEW_CHARS, PREVIEW_KEYS = 200, 1000, 15


def scan_files(spark: SparkSession, root: str, max_bytes: int | None = None) -> DataFrame:
    """(path, modified, length, content) of a tree; the size test is made before any content is read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return rows if max_bytes is None else rows.where(F.col("length") <= max_bytes)


def with_checksums(files: DataFrame) -> DataFrame:
    return files.withColumns({"checksum_sha256": F.sha2("content", 256), "md5": F.md5("content")})


def ingest_exports(files: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Files (path, content) as sources: name, extension, media type, JSON content or raw text, preview, flags.

    JSON counts as content if its top level is an object or an array, else as text. Texts are
    whole unless ``max_chars`` is given.
    """
    name = F.regexp_extract("source_path", r"([^/]*)$", 1)
    rows = files.withColumn("source_path", clean_path(F.col("path"))).withColumn("original_filename", name).withColumn("ext", extension(name))
    decoded = F.when(F.col("ext").isin(*PARSEABLE), F.decode("content", "UTF-8"))
    rows = rows.withColumn("raw_text", F.coalesce(decoded if max_chars is None else F.substring(decoded, 1, max_chars), F.lit("")))
    is_json = (F.col("ext") == ".json") & F.trim("raw_text").rlike(r"^[\[{]") & F.get_json_object("raw_text", "$").isNotNull()
    as_text = F.to_json(F.struct(F.col("original_filename").alias("title"), F.substring("raw_text", 1, SUMMARY_CHARS).alias("summary"), "raw_text"))
    keys = F.coalesce(F.json_object_keys(F.when(is_json, F.col("raw_text"))), F.array().cast("array<string>"))
    return rows.withColumns(
        {
            "checksum_sha256": F.sha2("content", 256),
            "content": F.when(is_json, F.col("raw_text")).otherwise(as_text),
            "mime": first_set(parseable_mime(F.col("ext")), F.lit("application/octet-stream")),
            "preview_keys": F.slice(keys, 1, PREVIEW_KEYS),
            "text_preview": F.substring("raw_text", 1, PREVIEW_CHARS),
            "is_archive": F.col("ext").isin(*ARCHIVES),
            "is_bundle": F.col("ext").isin(*ARCHIVES) | F.lower("source_path").contains("takeout") | F.lower("source_path").contains("export"),
            "canonical_format": canonical_format(first_set(parseable_mime(F.col("ext")), F.lit("application/octet-stream")), with_binary=True),
        }
    ).withColumn("is_export", F.col("is_bundle"))  # a path that names an export is a bundle's too


def _members(member_limit: int):
    def one(file_id, checksum, content, status):
        try:
            with zipfile.ZipFile(pa.BufferReader(content)) as archive:
                yield from member_rows(archive, file_id, checksum, status, member_limit)
        except zipfile.BadZipFile as e:
            yield broken_archive(file_id, status, e)

    def run(batches):
        for batch in batches:
            ids, sums, contents, states = (batch.column(c) for c in ("file_id", "checksum_sha256", "content", "status"))
            # the content is read where it lies in the batch, and members of small archives share one
            yield from in_batches(row for i in range(len(batch)) for row in one(ids[i].as_py(), sums[i].as_py(), contents[i].as_buffer() or pa.py_buffer(b""), states[i].as_py()))

    return run


def expand_archives(files: DataFrame, member_limit: int = MEMBER_LIMIT) -> DataFrame:
    """One row per readable member of each ZIP file (file_id, checksum_sha256, content, status).

    Directories, members over the limit and unknown extensions are skipped; a member inherits
    its archive's status and has an identity of its own; a broken one has a ``problem`` and no
    content. Members are dealt out anew afterwards, as archives differ widely in size. Archives
    that do not fit into a row are read by the source ``zip_members``.
    """
    rows = files.select("file_id", "checksum_sha256", "content", "status")
    schema = "file_id string, bundle_id string, source_path string, original_filename string, checksum_sha256 string, content binary, status string, problem string"
    return rows.mapInArrow(_members(member_limit), schema).hint("rebalance")


def with_members(parents: DataFrame, member_limit: int = MEMBER_LIMIT) -> DataFrame:
    """(file_id, path, content) of archives and of their readable members, for ``ingest_exports``."""
    members = expand_archives(parents, member_limit).where("problem is null").withColumn("path", F.col("source_path"))
    return members.select("file_id", "path", "content").unionByName(parents.select("file_id", "path", "content"))


def source_flags(sources: DataFrame) -> DataFrame:
    """Add what a source contains, from its OCR type, sensitivity and amount, its path and its media type."""
    return sources.withColumns(
        {
            "contains_pii": text("ocr.sensitivity").isin("medium", "high"),
            "contains_messages": F.lower(text("ocr.doc_type")).contains("message"),
            "contains_geo": F.lower(text("path")).contains("map"),
            "contains_financial": F.coalesce(F.col("ocr.amount"), F.lit(0.0)) != 0,
            "contains_media_refs": text("mime_type").startswith("image/"),
        }
    )


CONTENT_DEFAULTS = "title string, summary string, event_time_start string, event_date string, apps array<string>, topics array<string>, people array<string>, importance_score double, url string"


def enrich_sources(sources: DataFrame) -> DataFrame:
    """Complete a source's content with what the report and the OCR result say of it.

    ``sources``: name, notes, run_utc, folder_rule, starred, web_link, mime_type, a nullable struct ``ocr``, and a struct
    ``content`` of the fields of CONTENT_DEFAULTS, null where the content has none. What the content says stays,
    empty values too: title, summary, date, topics and url are filled in only where it has none. OCR people
    and organizations follow the content's own people and apps, each once; a starred file counts for 0.25 more, 1 at most.
    """
    own = lambda c: F.col("content")[c]
    none = F.array().cast("array<string>")
    start = first_set("ocr.date", "run_utc")
    topic = F.trim(text("ocr.doc_type"))
    apps = F.coalesce(own("apps"), F.when(is_set("folder_rule"), F.array("folder_rule")))
    follow = lambda c, more: F.when(F.size(F.coalesce(F.col(more), none)) > 0, F.array_distinct(F.concat(F.coalesce(c, none), F.col(more)))).otherwise(F.coalesce(c, none))
    score = F.coalesce(own("importance_score"), F.lit(0.5))
    return sources.withColumns(
        {
            "title": F.coalesce(own("title"), F.col("name")),
            "summary": F.coalesce(own("summary"), first_set("ocr.summary", "notes")),
            "event_time_start": F.coalesce(own("event_time_start"), start),
            "event_date": F.coalesce(own("event_date"), F.substring(start, 1, 10)),
            "people": follow(own("people"), "ocr.people"),
            "apps": follow(apps, "ocr.organizations"),
            "topics": F.coalesce(own("topics"), F.when(topic != "", F.array(topic)), none),
            "importance_score": F.when(F.col("starred"), F.least(F.lit(1.0), score + 0.25)).otherwise(score),
            "url": F.coalesce(own("url"), text("web_link")),
            "canonical_format": canonical_format(text("mime_type"), with_binary=True),
        }
    )


def delta_export(report: DataFrame, suggestions: DataFrame) -> DataFrame:
    """A run's rows for the index: sort results beside them, OCR only where content counts.

    Removals and unchanged files are events only: their ``notes`` say so and their OCR is null.
    """
    last = suggestions.groupBy("file_id").agg(F.max_by(F.struct("folder_rule", "target_path", "action_mode"), "seq").alias("__s"))
    event = F.col("change_type").isin(*REMOVALS, "UNCHANGED_CONTENT_METADATA_ONLY") | F.col("status").isin(*REMOVALS, "UNCHANGED_CONTENT")
    rows = report.join(last, "file_id", "left").withColumn("__event", event)
    return rows.select(
        *[c for c in report.columns if c not in ("ocr", "notes")],
        *[text(f"__s.{c}").alias(c) for c in ("folder_rule", "target_path", "action_mode")],
        F.when(F.col("__event"), "event_only: content not processed").otherwise(text("notes")).alias("notes"),
        F.when(~F.col("__event"), F.col("ocr")).alias("ocr"),
    )

"""Inventory: what changed, what to hash, which contents are duplicates, what is known now.

Files are rows (seq, file_id, name, mime_type, size, md5, parents, modified_time, ...). Every
order-dependent result is ordered by ``seq`` and then ``file_id``. Contents may repeat without
bound (an empty file, a placeholder): primaries are found by aggregates that combine before
they shuffle, never by a window over all copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions.ids import is_set, text
from shelfmark.functions.session import shared_dir
from shelfmark.functions.text import joined_parents

REMOVALS = ("DELETED", "TRASHED", "REMOVED_OR_NO_ACCESS", "MOVED_OUT_OF_SCOPE")
SIZE_SENTINEL = "HASH_SKIPPED_SIZE"
#: A content with more files than this is hot; there are at most as many as this number goes into the rows.
HOT_COPIES = 1_000_000
FOLDER_MIME = "application/vnd.google-apps.folder"
NATIVE_PREFIX = "application/vnd.google-apps."


def to_file_records(raw: DataFrame, trash_inbox: str = "") -> DataFrame:
    """Flatten a raw listing to one row per file, without folders."""
    owner, editor = F.get("owners", F.lit(0)), F.col("lastModifyingUser")
    rows = raw.where(text("mimeType") != FOLDER_MIME)
    return rows.select(
        "seq",
        F.col("id").alias("file_id"),
        text("name").alias("name"),
        text("mimeType").alias("mime_type"),
        F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"),
        text("md5Checksum").alias("md5"),
        F.coalesce("parents", F.array().cast("array<string>")).alias("parents"),
        text("createdTime").alias("created_time"),
        text("modifiedTime").alias("modified_time"),
        text("webViewLink").alias("web_link"),
        text("description").alias("description"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("starred", "trashed", "removed", "scope_exit")],
        F.coalesce("explicitly_trashed_or_deleted_flag", F.lit(False)).alias("explicitly_deleted"),
        text(owner["emailAddress"]).alias("owner"),
        text(editor["emailAddress"]).alias("last_modified_by"),
        *[F.coalesce(F.col("capabilities")[c], F.lit(d)).alias(n) for c, n, d in (("canEdit", "can_edit", False), ("canShare", "can_share", False), ("canDownload", "can_download", True))],
        F.when(F.lit(trash_inbox != "") & F.array_contains(F.coalesce("parents", F.array().cast("array<string>")), trash_inbox), "INBOX_TRASH").otherwise("").alias("lane"),
    )


def normalize_changes(changes: DataFrame, in_scope: Column) -> DataFrame:
    """A raw change feed with its removal kinds told apart.

    ``changes`` has ``removed`` and ``file`` (null if the file is gone). Without a file the
    change is a deletion; a trashed file outside the tree is left out; any other file outside
    the tree has left the scope.
    """
    file = F.col("file")
    gone = F.coalesce("removed", F.lit(False)) | file.isNull()
    trashed = F.coalesce(file["trashed"], F.lit(False))
    rows = changes.withColumns({"__in": F.coalesce(in_scope, F.lit(False)), "__gone": gone, "__trashed": trashed})
    rows = rows.where("__gone or __in or not __trashed")
    return rows.withColumns(
        {
            "removed": F.col("__gone") | ~F.col("__in"),
            "explicitly_deleted": F.col("__gone") & file.isNull(),
            "scope_exit": ~F.col("__gone") & ~F.col("__in"),
            "trashed": ~F.col("__gone") & F.col("__trashed"),
        }
    ).drop("__in", "__gone", "__trashed")


def latest_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key in the order of ``order`` (nulls first); rows without a key are dropped.

    Combined before the shuffle, so that a key with very many versions is no problem.
    """
    rows = df.where(F.col(key).isNotNull())
    rank = F.struct(*order)
    best = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), rank).alias("__row"))
    return best.select(key, "__row.*").select(df.columns)


def classify_changes(files: DataFrame, known: DataFrame, is_initial: bool = False) -> DataFrame:
    """Add ``change_type`` and ``content_unchanged`` by comparison with the known row of each file.

    Several changes of one file in a batch count as its last one. ``known``: file_id, name,
    parent_ids_sorted, md5, size, modified_time, sha256, one row per file.
    """
    files = latest_by_key(files, "file_id", "seq")
    if is_initial:
        return files.withColumns({"change_type": F.lit("NEW"), "content_unchanged": F.lit(False), "known_sha256": F.lit("")})
    k = known.select("file_id", F.struct("name", "parent_ids_sorted", "md5", "size", "modified_time", "sha256").alias("known"))
    rows = files.join(k, "file_id", "left")
    old = lambda c: F.col("known")[c]
    both = lambda a, b: is_set(a) & is_set(b)
    size = text(F.coalesce(F.col("size"), F.lit(0)))
    change = (
        F.when(F.col("removed") & F.col("explicitly_deleted"), "DELETED")
        .when(F.col("trashed"), "TRASHED")
        .when(F.col("removed") & F.col("scope_exit"), "MOVED_OUT_OF_SCOPE")
        .when(F.col("removed"), "REMOVED_OR_NO_ACCESS")
        .when(F.col("known").isNull(), "NEW")
        .when(joined_parents(F.col("parents")) != text(old("parent_ids_sorted")), "MOVED")
        .when(is_set(old("name")) & (text("name") != text(old("name"))), "RENAMED")
        .when(both("md5", old("md5")) & (F.col("md5") != old("md5")), "UPDATED")
        .when(size != text(F.coalesce(old("size"), F.lit(0))), "UPDATED")
        .when(both("modified_time", old("modified_time")) & (F.col("modified_time") != old("modified_time")), "UPDATED")
        .otherwise("UNCHANGED_CONTENT_METADATA_ONLY")
    )
    same = F.col("known").isNotNull() & ~text("mime_type").startswith(NATIVE_PREFIX) & both("md5", old("md5")) & (F.col("md5") == old("md5")) & (size == text(F.coalesce(old("size"), F.lit(0))))
    return rows.withColumns({"change_type": change, "content_unchanged": F.coalesce(same, F.lit(False)), "known_sha256": text(old("sha256"))}).drop("known")


def route_for_hashing(classified: DataFrame, limit_mb: int = 500, is_initial: bool = False) -> DataFrame:
    """Add ``status`` (null: the content is to be hashed) and ``sha256`` where it is known without reading."""
    unchanged = (F.col("change_type") == "UNCHANGED_CONTENT_METADATA_ONLY") | (F.lit(not is_initial) & F.col("content_unchanged"))
    kept = F.when(F.col("known_sha256") == SIZE_SENTINEL, "SKIPPED_SIZE").otherwise("UNCHANGED_CONTENT")
    large = F.col("size") > limit_mb * 1024 * 1024
    removal = F.col("change_type").isin(*REMOVALS)
    return classified.withColumns(
        {
            "status": F.when(removal, F.col("change_type")).when(unchanged, kept).when(large, "SKIPPED_SIZE"),
            "sha256": F.when(removal, "").when(unchanged, F.col("known_sha256")).when(large, SIZE_SENTINEL),
        }
    )


def suggest_names(files: DataFrame, project: str) -> DataFrame:
    """Add ``suggested_name``: ``YYYY-MM-DD_project_name``; none for removals, unchanged without a date."""
    day = F.substring(text("created_time"), 1, 10)
    made = F.concat(day, F.lit(f"_{project}_"), F.trim(F.translate("name", ":", "-")))
    same = ~is_set("created_time") | F.col("name").startswith(F.concat(day, F.lit("_")))
    return files.withColumn("suggested_name", F.when(F.col("change_type").isin(*REMOVALS), "").when(same, F.col("name")).otherwise(made))


def primaries(rows: DataFrame) -> DataFrame:
    """(sha256, primary, copies): the first file of each content, and how many there are; unhashed rows have none."""
    real = rows.where(is_set("sha256") & (F.col("sha256") != SIZE_SENTINEL))
    return real.groupBy("sha256").agg(F.min(F.struct("seq", "file_id")).alias("m"), F.count("*").alias("copies")).select("sha256", F.col("m.file_id").alias("primary"), "copies")


def dedupe_by_hash(files: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Add ``status`` and ``duplicate_of`` to hashed files.

    A content's primary is the known file with the smallest seq that still has it (rows of this
    batch override older known rows), else the first file of this batch. Contents with more than
    HOT_COPIES files, of which there are few by that bound, are joined by broadcast, so that
    their copies stay where they are.
    """
    own = primaries(files).withColumnRenamed("primary", "batch_primary")
    if known is None:
        first = own.select("sha256", F.col("batch_primary").alias("first"), F.lit(False).alias("was_known"), "copies")
    else:
        current = known.join(files.select("file_id", F.col("sha256").alias("now")), "file_id", "left").where("now is null or now = sha256")
        first = own.join(primaries(current).drop("copies"), "sha256", "left").select("sha256", F.coalesce("primary", "batch_primary").alias("first"), F.col("primary").isNotNull().alias("was_known"), own["copies"])
    shared_dir(files.sparkSession)
    first = first.checkpoint()  # a row for each content, read for the hot and for the others
    hot, cold = first.where(F.col("copies") > HOT_COPIES), first.where(F.col("copies") <= HOT_COPIES)
    rows = files.join(F.broadcast(hot.select("sha256", F.struct("first", "was_known").alias("__hot"))), "sha256", "left")
    rows = rows.withColumn("__key", F.when(F.col("__hot").isNull() & is_set("sha256"), F.col("sha256")).otherwise(F.concat(F.lit("~"), "file_id")))
    rows = rows.join(cold.select(F.col("sha256").alias("__key"), F.struct("first", "was_known").alias("__cold")), "__key", "left")
    rows = rows.withColumn("__first", F.coalesce("__hot", "__cold")).withColumns({"first": F.col("__first.first"), "was_known": F.coalesce("__first.was_known", F.lit(False))})
    resumed = F.col("was_known")
    status = (
        F.when(~is_set("sha256"), "HASH_ERROR")
        .when(F.col("sha256") == SIZE_SENTINEL, "SKIPPED_SIZE")
        .when((F.col("first") == F.col("file_id")) & resumed, "ORIGINAL_RESUMED")
        .when(F.col("first") == F.col("file_id"), "ORIGINAL")
        .otherwise("DUPLICATE")
    )
    return rows.withColumn("status", status).withColumn("duplicate_of", F.when(F.col("status") == "DUPLICATE", F.col("first")).otherwise("")).select(*dict.fromkeys([*files.columns, "status", "duplicate_of"]))


def duplicate_groups(report: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(sha256, original_file_id, duplicate_file_ids sorted, count); an existing group keeps its original and gains members."""
    dup = report.where(F.col("status").startswith("DUPLICATE")).select("sha256", F.col("duplicate_of").alias("original_file_id"), "file_id").distinct()
    rows = dup.withColumn("old", F.lit(False))
    if existing is not None:
        told = existing.select("sha256", "original_file_id", F.explode_outer("duplicate_file_ids").alias("file_id"), F.lit(True).alias("old"))
        rows = rows.unionByName(told)
    made = rows.groupBy("sha256").agg(F.max_by("original_file_id", F.struct("old", "original_file_id")).alias("original_file_id"), F.array_sort(F.collect_set("file_id")).alias("duplicate_file_ids"))
    return made.withColumn("count", F.size("duplicate_file_ids").cast("long"))


def known_rows(report: DataFrame) -> DataFrame:
    return report.select("seq", "file_id", "name", joined_parents(F.col("parents")).alias("parent_ids_sorted"), "md5", "size", "modified_time", "sha256")


KEPT = ("ORIGINAL", "ORIGINAL_RESUMED", "SKIPPED_SIZE", "UNCHANGED_CONTENT")


def known_changes(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a run changes in the known files: (rows that are new or replace their file's, file_ids that go).

    Originals, resumed and skipped files are new rows, files with unchanged content have their metadata
    refreshed, removed files go; duplicates and failed hashes change nothing.
    """
    return known_rows(report.where(F.col("status").isin(*KEPT))), report.where(F.col("status").isin(*REMOVALS)).select("file_id")


def update_known(known: DataFrame, report: DataFrame) -> DataFrame:
    """The known files after a run, as ``known_changes`` has it; all others stay."""
    fresh, _ = known_changes(report)
    touched = report.where(F.col("status").isin(*KEPT, *REMOVALS)).select("file_id")
    return known.join(touched, "file_id", "left_anti").unionByName(fresh.select(known.columns))


def compact_index(index: DataFrame, key: str, order: str, threshold: int = 50_000) -> DataFrame:
    """One current row per key once the index has ``threshold`` rows; below that it stays as it is."""
    return latest_by_key(index, key, order) if index.count() >= threshold else index


def _to_tops(pointers: DataFrame, joined: str | None = None) -> DataFrame:
    """Follow pointers (folder_id, up) to their ends, by steps that double: (folder_id, up, open).

    ``up`` ends at an id that has no pointer of its own; what is still ``open`` after all ends are found lies on a cycle or
    below one. Rounds grow with the logarithm of the longest path. ``joined``: a text column that is put together along the way.
    """
    shared_dir(pointers.sparkSession)
    more = [joined] if joined else []
    done, live, was = None, pointers.withColumn("open", F.lit(True)).checkpoint(), -1
    n = live.count()
    while n and n != was:
        reached = live if done is None else live.unionByName(done)
        ahead = reached.select(F.col("folder_id").alias("up"), F.col("up").alias("__up"), F.col("open").alias("__open"), *[F.col(c).alias(f"__{c}") for c in more])
        step = live.join(ahead, "up", "left").select(
            "folder_id", F.coalesce("__up", "up").alias("up"), F.coalesce("__open", F.lit(False)).alias("open"),
            *[F.when(F.col(f"__{c}").isNull(), F.col(c)).otherwise(F.concat(F.col(f"__{c}"), F.lit("/"), F.col(c))).alias(c) for c in more],
        ).checkpoint()
        ended = step.where("not open")
        done = ended if done is None else done.unionByName(ended)
        live, was = step.where("open"), n
        n = live.count()
    return live if done is None else done.unionByName(live)


def in_scope(folders: DataFrame, target: str) -> DataFrame:
    """(folder_id) of the target and all folders below it; ``folders``: (folder_id, parent_id), may be cyclic.

    Folders with one parent point to it, and pointers are followed by doubling steps to the target, a root or a folder with
    several parents; those few are then gone through level by level.
    """
    shared_dir(folders.sparkSession)
    edges = folders.select("folder_id", "parent_id").where("folder_id is not null and parent_id is not null").distinct()
    per = edges.where(F.col("folder_id") != target).groupBy("folder_id").agg(F.min("parent_id").alias("up"), F.count("*").alias("n")).checkpoint()
    tops = _to_tops(per.where("n = 1").select("folder_id", "up")).where("not open").select("folder_id", F.col("up").alias("top"))
    found = folders.sparkSession.createDataFrame([(target,)], "folder_id string")
    below = tops.where(F.col("top") == target).select("folder_id")
    many = per.where("n > 1").select("folder_id")
    if many.isEmpty():
        return found.unionByName(below)
    ends = edges.join(many, "folder_id", "left_semi").join(tops.select(F.col("folder_id").alias("parent_id"), "top"), "parent_id", "left")
    ends = ends.select("folder_id", F.coalesce("top", "parent_id").alias("top")).distinct().checkpoint()
    frontier, reached = found, found
    while True:
        frontier = ends.join(frontier.select(F.col("folder_id").alias("top")), "top", "left_semi").select("folder_id").distinct().join(reached, "folder_id", "left_anti").checkpoint()
        if frontier.isEmpty():
            break
        reached = reached.unionByName(frontier)
    return reached.unionByName(tops.join(reached.select(F.col("folder_id").alias("top")), "top", "left_semi").select("folder_id"))


def folder_paths(folders: DataFrame) -> DataFrame:
    """(folder_id, root_id, path) of folders (folder_id, parent_id, name): the names from the topmost known folder down, joined by slashes.

    A folder without a known parent is a root, and of several parents the smallest id counts. Folders on a cycle, and below one, have
    a null path and root; repeated rows count once.
    """
    one = folders.where("folder_id is not null").groupBy("folder_id").agg(F.min("parent_id").alias("parent_id"), F.min_by(text("name"), F.struct("parent_id", "name")).alias("path"))
    known = one.select(F.col("folder_id").alias("parent_id"), F.lit(True).alias("__known"))
    one = one.join(known, "parent_id", "left").checkpoint()
    roots = one.where("__known is null").select("folder_id", F.col("folder_id").alias("root_id"), "path")
    led = _to_tops(one.where("__known").select("folder_id", F.col("parent_id").alias("up"), "path"), "path")
    led = led.join(roots.select(F.col("root_id").alias("up"), F.col("path").alias("__first")), "up", "left")
    return roots.unionByName(led.select("folder_id", F.when(~F.col("open"), F.col("up")).alias("root_id"), F.when(~F.col("open"), F.concat("__first", F.lit("/"), "path")).alias("path")))


def flag_scope(files: DataFrame, folders: DataFrame, target: str) -> DataFrame:
    """Add ``in_scope``: any parent is the target or below it. Without a target all are; without parents none is."""
    if not target:
        return files.withColumn("in_scope", F.lit(True))
    inside = in_scope(folders, target)
    hits = files.select("file_id", F.explode("parents").alias("folder_id")).join(inside, "folder_id").select("file_id").distinct()
    return files.join(hits.withColumn("in_scope", F.lit(True)), "file_id", "left").withColumn("in_scope", F.coalesce("in_scope", F.lit(False)))


def display_paths(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``path``: the registered path of the first parent and the name if all parents are registered,
    else the first parent and the name, else the name."""
    one = files.select("file_id", F.posexplode("parents").alias("pos", "folder_id")).join(registry.select("folder_id", "full_path"), "folder_id", "left")
    per = one.groupBy("file_id").agg(
        F.bool_and(F.col("full_path").isNotNull()).alias("all_known"), F.min_by("full_path", "pos").alias("full_path"), F.min_by("folder_id", "pos").alias("first_parent")
    )
    path = F.when(F.col("all_known"), F.concat("full_path", F.lit("/"), "name")).when(F.col("first_parent").isNotNull(), F.concat("first_parent", F.lit("/"), "name")).otherwise(F.col("name"))
    return files.join(per, "file_id", "left").withColumn("path", path).drop("all_known", "full_path", "first_parent")


def eligible_for_index(report: DataFrame, run_id: str) -> DataFrame:
    """Rows of a run whose status begins with one that the index admits (duplicates and failed hashes do not)."""
    prefixes = ("ORIGINAL", "ORIGINAL_RESUMED", "UNCHANGED_CONTENT", *REMOVALS)
    return report.where((F.col("run_id") == run_id) & F.col("status").rlike("^(" + "|".join(prefixes) + ")"))


def select_ocr_candidates(report: DataFrame, budget: int = 500) -> DataFrame:
    """The first ``budget`` original images, PDFs and native documents that are new or updated."""
    mime = text("mime_type")
    worthy = mime.startswith("image/") | (mime == "application/pdf") | (mime == NATIVE_PREFIX + "document")
    return report.where(worthy & (F.col("status") == "ORIGINAL") & F.col("change_type").isin("NEW", "UPDATED")).orderBy("seq", "file_id").limit(budget)


def attach_ocr(records: DataFrame, ocr: DataFrame) -> DataFrame:
    """Put each file's OCR row, if any, into a nullable struct ``ocr``."""
    fields = [c for c in ocr.columns if c != "file_id"]
    return records.join(ocr.select("file_id", F.struct(*fields).alias("ocr")), "file_id", "left")


def expired_files(files: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return files.where(F.col("modified_time").cast("timestamp") < F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def first_of_batch(files: DataFrame) -> DataFrame:
    """Add ``rank`` of each file among those with its content, for reports on small groups."""
    return files.withColumn("rank", F.row_number().over(Window.partitionBy("sha256").orderBy("seq", "file_id")))



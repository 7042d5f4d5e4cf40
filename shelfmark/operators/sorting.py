"""Where files should go: an ordered rule chain, folder targets, and plans against a live snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import first_set, is_set, text

# The words and extensions that the default rules look for.
FINANCIAL_TOPICS = ("invoice", "rechnung", "receipt", "quittung", "beleg", "contract", "vertrag", "bank_statement", "kontoauszug", "mahnung", "lieferschein", "delivery_note")
DECISION_MARKERS = ("decision", "entscheid", "adr", "architecture_decision")
SOFTWARE_EXTENSIONS = (".apk", ".exe", ".dmg", ".pkg", ".deb", ".rpm", ".zip", ".tar", ".7z")
SCRIPT_EXTENSIONS = (".py", ".js", ".ts", ".gs", ".ipynb", ".sh", ".yaml", ".yml", ".json", ".sql")
CODE_PATHS = ("script", "code", "project")


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def default_rules(project_markers: tuple[str, ...] = (), trash_folder: str = "") -> list[tuple[str, str, Column]]:
    """(folder key, reason, test) in order; the first test that holds decides."""
    name, mime, path, topic = (F.lower(text(c)) for c in ("name", "mime_type", "path", "topic_hint"))
    status = text("status")
    in_trash = text("lane") == "INBOX_TRASH"
    if trash_folder:
        in_trash = in_trash | (text("parent_id") == trash_folder)
    ends = lambda exts: _any(name.endswith(e) for e in exts)
    has = lambda where, words: _any(where.contains(w) for w in words)
    return [
        ("01_inbox_trash", "trash lane", in_trash),
        ("99_archive", "duplicate", status.contains("DUPLICATE")),
        ("99_quarantine", "error", status.isin("ERROR", "FATAL", "UNREADABLE")),
        ("40b_referenzen", "financial topic", topic.isin(*FINANCIAL_TOPICS)),
        ("50a_fotos", "image", mime.startswith("image/")),
        ("50b_videos", "video", mime.startswith("video/")),
        ("50c_audio", "audio", mime.startswith("audio/")),
        ("30_scripts", "script extension", ends(SCRIPT_EXTENSIONS)),
        ("30_scripts", "markdown beside code", name.endswith(".md") & has(path, CODE_PATHS)),
        ("40b_referenzen", "pdf", mime == "application/pdf"),
        ("40c_projekte", "project marker", has(name, project_markers) | has(path, project_markers)),
        ("10_decisions", "decision marker", has(name, DECISION_MARKERS)),
        ("60_software", "software extension", ends(SOFTWARE_EXTENSIONS)),
    ]


def assign_folder_rule(files: DataFrame, rules: list[tuple[str, str, Column]] | None = None, fallback: tuple[str, str] = ("00_inbox", "no rule")) -> DataFrame:
    """Add ``folder_rule`` and ``folder_rule_reason``."""
    choice = None
    for key, reason, test in rules if rules is not None else default_rules():
        pick = F.struct(F.lit(key).alias("key"), F.lit(reason).alias("reason"))
        choice = F.when(test, pick) if choice is None else choice.when(test, pick)
    last = F.struct(F.lit(fallback[0]).alias("key"), F.lit(fallback[1]).alias("reason"))
    rows = files.withColumn("__rule", last if choice is None else choice.otherwise(last))
    return rows.withColumns({"folder_rule": F.col("__rule.key"), "folder_rule_reason": F.col("__rule.reason")}).drop("__rule")


def with_targets(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Add the target folder's name, id and path, the action mode and, without an id, the reason for the error.

    ``registry``: (folder_key, folder_name, folder_id, full_path). An unregistered key names itself.
    """
    r = registry.select(F.col("folder_key").alias("folder_rule"), "folder_name", "folder_id", "full_path")
    rows = files.join(r, "folder_rule", "left")
    missing = ~is_set("folder_id")
    return rows.select(
        *files.columns,
        F.coalesce("folder_name", "folder_rule").alias("suggested_target_folder"),
        text("folder_id").alias("suggested_target_folder_id"),
        F.coalesce("full_path", F.concat(F.lit("/"), F.col("folder_rule"))).alias("target_path"),
        F.when(F.col("folder_rule") == "01_inbox_trash", "SWEEP_TRASH").otherwise("SAFE").alias("action_mode"),
        F.when(missing, "ERROR: no target folder").otherwise("").alias("target_error"),
    )


def sort_suggestions(report: DataFrame, known: DataFrame, hints: DataFrame, registry: DataFrame, done: DataFrame | None = None, rules=None) -> DataFrame:
    """Suggestions for a run's report rows that have none yet.

    ``known`` gives a file's first parent where the report has none, ``hints`` (file_id,
    topic_hint) its topic; ``done`` (run_id, file_id) are rows of an interrupted earlier attempt.
    """
    rows = report if done is None else report.join(done.select("run_id", "file_id").distinct(), ["run_id", "file_id"], "left_anti")
    parents = known.select("file_id", F.substring_index("parent_ids_sorted", ",", 1).alias("known_parent"))
    rows = rows.join(parents, "file_id", "left").join(hints.select("file_id", "topic_hint"), "file_id", "left")
    rows = rows.withColumn("parent_id", first_set(F.get("parents", F.lit(0)), "known_parent")).drop("known_parent")
    return with_targets(assign_folder_rule(rows, rules), registry)


def topic_hints(records: DataFrame, existing: DataFrame | None = None, purged: DataFrame | None = None) -> DataFrame:
    """(file_id, topic_hint): the first topic of each file's last record that has any, over older hints, without purged files."""
    new = records.where((F.size("topics") > 0) & is_set("file_id")).groupBy("file_id").agg(F.max_by(F.get("topics", F.lit(0)), F.struct("seq", "record_id")).alias("new_hint"))
    out = new.withColumnRenamed("new_hint", "topic_hint")
    if existing is not None:
        out = new.join(existing.select("file_id", "topic_hint"), "file_id", "full").select("file_id", F.coalesce("new_hint", "topic_hint").alias("topic_hint"))
    return out if purged is None else out.join(purged.select("file_id"), "file_id", "left_anti")


def plan_moves(suggestions: DataFrame, live: DataFrame) -> DataFrame:
    """Add ``plan`` to suggestions: FAILED, ALREADY_TRASHED, TRASH, ALREADY_IN_TARGET, STALE_PARENT or MOVE.

    ``live``: (file_id, parents, trashed). A file is stale if it no longer lies where it did.
    """
    rows = suggestions.join(live.select("file_id", F.struct("parents", "trashed").alias("live")), "file_id", "left")
    parents = F.coalesce(F.col("live.parents"), F.array().cast("array<string>"))
    sweep = F.col("action_mode") == "SWEEP_TRASH"
    plan = (
        F.when(F.col("live").isNull(), "FAILED")
        .when(F.col("live.trashed"), "ALREADY_TRASHED")
        .when(is_set("parent_id") & ~F.array_contains(parents, F.col("parent_id")) & ~F.array_contains(parents, F.col("suggested_target_folder_id")), "STALE_PARENT")
        .when(sweep, "TRASH")
        .when(F.col("target_error") != "", "FAILED")
        .when(F.array_contains(parents, F.col("suggested_target_folder_id")), "ALREADY_IN_TARGET")
        .otherwise("MOVE")
    )
    return rows.withColumn("plan", plan).drop("live")


def plan_renames(report: DataFrame, live: DataFrame) -> DataFrame:
    """Add ``plan`` to unsettled rows with another suggested name: FAILED, ALREADY_RENAMED, STALE_NAME or RENAME."""
    open_rows = report.where(is_set("suggested_name") & (F.col("suggested_name") != F.col("name")) & ~is_set("rename_result"))
    rows = open_rows.join(live.select("file_id", F.col("name").alias("live_name")), "file_id", "left")
    plan = F.when(F.col("live_name").isNull(), "FAILED").when(F.col("live_name") == F.col("suggested_name"), "ALREADY_RENAMED").when(F.col("live_name") != F.col("name"), "STALE_NAME").otherwise("RENAME")
    return rows.withColumn("plan", plan).drop("live_name")

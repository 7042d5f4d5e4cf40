"""Which job reads an export: an ordered rule table, as data."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import text
from shelfmark.functions.text import CHAT_EU, CHAT_US


class Rule(NamedTuple):
    name: str
    version: str
    system: str
    service: str
    app: str
    format: str
    record_type: str
    tokens: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()


# Fixed values, in the order in which they are tried. A rule holds if a token is in the path,
# the name or the text preview, or if all its keys are in the content; some have tests of their own.
RULES = [
    Rule("chatgpt_export", "2.0.0", "llm", "chatgpt", "chatgpt", "json", "llm_conversation", ("chatgpt", "openai")),
    Rule("claude_export", "2.0.0", "llm", "claude", "claude", "json", "llm_conversation", ("claude",)),
    Rule("gemini_chat_export", "2.0.0", "llm", "gemini", "gemini", "json", "llm_conversation", ("gemini chat", "gemini"), ("conversations",)),
    Rule("llm_json_transcript", "2.0.0", "llm", "json-transcript", "json", "json", "llm_turn", ("transcript", "conversation_log", "llm_json"), ("messages",)),
    Rule("perplexity_export", "1.0.0", "llm", "perplexity", "perplexity", "perplexity", "llm_conversation", ("perplexity",)),
    Rule("notebooklm_artifacts", "1.0.0", "llm", "notebooklm", "notebooklm", "notebooklm", "llm_artifact_reference", ("notebooklm",)),
    Rule("prompt_bundle", "1.0.0", "llm", "prompt-bundle", "prompt-bundle", "bundle", "llm_prompt", ("prompt bundle", "prompts")),
    Rule("llm_html_export", "1.0.0", "llm", "html-export", "html", "html", "llm_response", ("conversation", ".html")),
    Rule("llm_markdown_bundle", "1.0.0", "llm", "markdown-bundle", "markdown", "markdown", "llm_response", ("llm_markdown", "llm-markdown", "llm_bundle")),
    Rule("google_play_installs", "2.0.0", "google", "play", "google-play", "json", "app_install", ("play", "installs", "installed_apps"), ("installed_apps",)),
    Rule("google_play_subscriptions", "1.0.0", "google", "play", "google-play", "play", "subscription_event", ("play", "subscription")),
    Rule("google_play_purchases", "1.0.0", "google", "play", "google-play", "play", "purchase_event", ("play", "purchase")),
    Rule("google_play_orders", "1.0.0", "google", "play", "google-play", "play", "order_event", ("play", "order")),
    Rule("google_play_devices", "1.0.0", "google", "play", "google-play", "play", "device_event", ("play", "device")),
    Rule("google_play_library", "1.0.0", "google", "play", "google-play", "play", "library_event", ("play", "library")),
    Rule("google_my_activity", "2.0.0", "google", "my-activity", "google", "json", "activity_event", ("my activity", "my_activity", "google activity"), ("activity",)),
    Rule("google_maps_places", "1.0.0", "google", "maps", "google-maps", "maps", "place_visit", ("maps", "places")),
    Rule("google_timeline", "2.0.0", "google", "timeline", "google-maps", "json", "place_visit", ("timeline", "location history", "semantic location"), ("timeline_objects",)),
    Rule("google_calendar", "2.0.0", "google", "calendar", "google-calendar", "ics", "calendar_event", ("calendar", ".ics")),
    Rule("google_tasks", "2.0.0", "google", "tasks", "google-tasks", "json", "task", ("tasks", "google")),
    Rule("google_contacts", "2.0.0", "google", "contacts", "google-contacts", "json", "contacts_export", ("contacts", "google")),
    Rule("google_keep", "1.0.0", "google", "keep", "google-keep", "keep", "note_event", ("keep", "note")),
    Rule("gmail_export", "1.0.0", "google", "gmail", "gmail", "gmail", "message_event", ("gmail", ".mbox")),
    Rule("google_drive_export", "1.0.0", "google", "drive", "google-drive", "drive", "drive_export_event", ("drive export", "docs")),
    Rule("gemini_exports", "1.0.0", "google", "gemini", "gemini", "gemini", "llm_conversation", ("gemini export", "gemini_export")),
    Rule("instagram_export", "2.0.0", "meta", "instagram", "instagram", "json", "message_event", ("instagram", "messages")),
    Rule("facebook_export", "1.0.0", "meta", "facebook", "facebook", "facebook", "social_event", ("facebook",)),
    Rule("messenger_export", "1.0.0", "meta", "messenger", "messenger", "messenger", "message_event", ("messenger",)),
    Rule("threads_export", "1.0.0", "meta", "threads", "threads", "threads", "social_event", ("threads",)),
    Rule("whatsapp_export", "2.0.0", "messaging", "whatsapp", "whatsapp", "txt", "message_event", ("whatsapp",)),
    Rule("telegram_export", "2.0.0", "telegram", "telegram", "telegram", "json", "message_event", ("telegram", "result.json")),
    Rule("signal_export", "1.0.0", "messaging", "signal", "signal", "signal", "message_event", ("signal",)),
    Rule("generic_json_export", "2.0.0", "generic", "json", "json", "json", "generic_json_export", (".json", "export")),
    Rule("generic_csv_export", "1.0.0", "generic", "csv", "csv", "csv", "generic_csv_export", (".csv", "export")),
    Rule("generic_html_export", "1.0.0", "generic", "html", "html", "html", "generic_html_export", (".html", "export")),
    Rule("generic_txt_export", "1.0.0", "generic", "txt", "txt", "txt", "generic_txt_export", (".txt", "export")),
    Rule("generic_zip_bundle", "1.0.0", "generic", "zip", "zip", "zip", "generic_zip_bundle", (".zip", "takeout")),
]
FALLBACK = "generic_txt_export"


def _holds(rule: Rule) -> Column:
    path, name, seen, keys, first_keys = (F.col(f"__{c}") for c in ("path", "name", "seen", "keys", "first_keys"))
    has, first_has = (lambda k: F.array_contains(keys, k)), (lambda k: F.array_contains(first_keys, k))
    any_in = lambda where, words: reduce(lambda a, b: a | b, [where.contains(w) for w in words])
    place = F.concat_ws(" ", path, name)
    own = {
        "chatgpt_export": lambda: any_in(place, rule.tokens) | (first_has("turns") & ~first_has("chat_messages") & (first_has("model") | first_has("create_time"))),
        "claude_export": lambda: any_in(name, rule.tokens) | first_has("chat_messages") | has("chat_messages") | F.col("__listed"),
        "gemini_chat_export": lambda: seen.contains("gemini") & (first_has("turns") | first_has("createTime")),
        "perplexity_export": lambda: name.contains("perplexity"),
        "google_tasks": lambda: name.contains("tasks"),
        "google_contacts": lambda: name.contains("contacts"),
        "instagram_export": lambda: any_in(name, rule.tokens) & (has("messages") | has("participants")),
        "telegram_export": lambda: (name.contains("telegram") | path.contains("telegram")) & (has("chats") | has("about")),
        "whatsapp_export": lambda: any_in(place, rule.tokens) | F.col("__chat_lines"),
    }.get(rule.name)
    if own is not None:
        return own()
    test = any_in(seen, rule.tokens)
    return test | reduce(lambda a, b: a & b, [has(k) for k in rule.keys]) if rule.keys else test


def resolve_parser(sources: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Add the parser's name, version, system, service, app, format and default record type.

    ``sources``: source_path, original_filename, text_preview, content (JSON or null).
    """
    none = F.array().cast("array<string>")
    rows = sources.withColumns({"__path": F.lower(text("source_path")), "__name": F.lower(text("original_filename")), "__content": text("content")})
    rows = rows.withColumns(
        {
            "__seen": F.concat_ws(" ", "__path", "__name", F.lower(text("text_preview"))),
            "__keys": F.coalesce(F.json_object_keys("__content"), none),
            "__first_keys": F.coalesce(F.json_object_keys(F.get_json_object("__content", "$.conversations[0]")), none),
            "__listed": F.get_json_object("__content", "$[0].chat_messages").isNotNull(),
            "__chat_lines": text("text_preview").rlike("(?m)" + CHAT_EU) | text("text_preview").rlike("(?m)" + CHAT_US),
        }
    )
    pick = None
    for r in rules:
        pick = F.when(_holds(r), r.name) if pick is None else pick.when(_holds(r), r.name)
    rows = rows.withColumn("parser_name", pick.otherwise(FALLBACK))
    known = {r.name: r for r in [*RULES, *rules]}
    fields = {"parser_version": "version", "source_system": "system", "source_service": "service", "source_app": "app", "source_format": "format", "default_record_type": "record_type"}
    table = F.create_map(*[F.lit(x) if isinstance(x, str) else F.struct(*[F.lit(getattr(x, f)).alias(c) for c, f in fields.items()]) for name, r in known.items() for x in (name, r)])
    rows = rows.withColumn("__rule", F.element_at(table, F.col("parser_name")))
    return rows.select(*sources.columns, "parser_name", *[F.col(f"__rule.{c}").alias(c) for c in fields])

"""Text, path and date expressions; all built-in, all null-safe in the sense that null is empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import first_set, text

# Extensions whose text can be read, and their media types.
PARSEABLE = {
    ".json": "application/json",
    ".html": "text/html",
    ".htm": "text/html",
    ".txt": "text/plain",
    ".md": "text/markdown",
    ".csv": "text/csv",
    ".ics": "text/calendar",
}
REVIEW_DAYS = (1, 7, 30, 90)


def slug(value: Column) -> Column:
    """Lower-case letters and digits, other runs as one hyphen; ``unknown`` if nothing is left."""
    made = F.regexp_replace(F.lower(F.trim(text(value))), "[^a-z0-9]+", "-")
    return first_set(F.regexp_replace(made, "^-+|-+$", ""), F.lit("unknown"))


def extension(name: Column) -> Column:
    """The last dot and what follows, lower-cased; empty for names without one or that begin with their only dot."""
    return F.lower(F.regexp_extract(text(name), r"^.*[^/.][^/]*?(\.[^./]+)$|^[^/]*[^/.](\.[^./]+)$", 1))


def normalized_filename(name: Column) -> Column:
    ext = extension(name)
    base = F.regexp_extract(text(name), r"([^/]*)$", 1)
    return F.concat(slug(F.substring(base, F.lit(1), F.length(base) - F.length(ext))), ext)


def parseable_mime(ext: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in PARSEABLE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(ext)), F.lit(""))


def clean_path(path: Column) -> Column:
    """A relative path without ``.``, ``..``, backslashes or leading slashes: ``..`` takes back the part before it."""
    parts = F.filter(F.split(F.translate(text(path), "\\", "/"), "/"), lambda p: ~p.isin("", "."))
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p))),
    )
    return F.array_join(walked, "/")


def joined_parents(parents: Column) -> Column:
    return F.array_join(F.array_sort(F.coalesce(parents, F.array().cast("array<string>"))), ",")


def event_date(given: Column, start: Column) -> Column:
    return first_set(given, F.substring(text(start), 1, 10))


def is_day(day: Column) -> Column:
    return day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(day, "yyyy-MM-dd").isNotNull()


def review_due(day: Column, as_of: str) -> Column:
    """1, 7, 30 or 90 days before ``as_of``; false for what is no day."""
    age = F.datediff(F.lit(as_of).cast("date"), F.when(is_day(day), F.try_to_date(day, "yyyy-MM-dd")))
    return F.coalesce(age.isin(*REVIEW_DAYS), F.lit(False))


def iso_week(day: Column) -> Column:
    """``YYYY-Www`` of the ISO year and week; null for what is no day."""
    d = F.when(is_day(day), F.try_to_date(day, "yyyy-MM-dd"))
    return F.when(d.isNotNull(), F.concat(F.date_part(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")))


def ics_value(raw: Column) -> Column:
    """The time itself of a line's value, without parameters before it."""
    return F.trim(F.regexp_replace(text(raw), "^.*:", ""))


def shown_ics_time(v: Column) -> Column:
    day = F.concat_ws("-", F.substring(v, 1, 4), F.substring(v, 5, 2), F.substring(v, 7, 2))
    clock = F.concat_ws(":", F.substring(v, 10, 2), F.substring(v, 12, 2), F.substring(v, 14, 2))
    return F.when(v.rlike("^[0-9]{8}$"), day).when(v.rlike("^[0-9]{8}T[0-9]{6}Z?$"), F.concat(day, F.lit("T"), clock, F.when(v.endswith("Z"), "Z").otherwise(""))).otherwise(v)


def ics_time(raw: Column) -> Column:
    """``YYYYMMDD``, ``YYYYMMDDTHHMMSS`` and the latter with ``Z`` as ISO text; others unchanged."""
    return shown_ics_time(ics_value(raw))


def unfold_ics(block: Column) -> Column:
    return F.regexp_replace(block, "\r?\n[ \t]", "")


def ics_line(unfolded: Column, name: str) -> Column:
    """The value of the first line of that name, parameters allowed; empty if there is none."""
    return F.trim(F.regexp_extract(unfolded, rf"(?im)^{name}(?:;[^:\r\n]*)?:([^\r\n]*)", 1))


def ics_field(block: Column, name: str) -> Column:
    """``ics_line`` of a block that is still folded."""
    return ics_line(unfold_ics(block), name)


# A line of a chat: when, who, what. ``{stamp}`` is the part before the sender, with or without its brackets.
_LINE = "^{stamp} *([^:]+?): (.+)$"
#: Day first with a 24-hour clock in brackets, and month first with a 12-hour clock; groups: stamp, sender, message.
CHAT_EU = _LINE.format(stamp=r"\[([0-9]{2}[.][0-9]{2}[.][0-9]{4}, *[0-9]{2}(?::[0-9]{2}){2})\]")
CHAT_US = _LINE.format(stamp=r"([0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}, *[0-9]{1,2}:[0-9]{2} *[AP]M) *-")
CHAT_SENDER, CHAT_MESSAGE = 2, 3


def _stamp(line: Column, form: str, *patterns: str) -> Column:
    """The stamp of a chat line as ISO text, by the first of the date patterns that reads it; empty if none does."""
    told = F.regexp_replace(F.regexp_extract(line, form, 1), " +", "")
    times = [F.try_to_timestamp(told, F.lit(p)) for p in patterns]
    return F.coalesce(F.date_format(F.coalesce(*times), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def chat_time_eu(line: Column) -> Column:
    return _stamp(line, CHAT_EU, "dd.MM.yyyy,HH:mm:ss")


def chat_time_us(line: Column) -> Column:
    """12-hour clock, years of two digits in this century: 12 AM is hour 0, 12 PM hour 12."""
    return _stamp(line, CHAT_US, "M/d/yy,h:mma", "M/d/yyyy,h:mma")


def epoch_ms_iso(ms: Column) -> Column:
    """UTC text with ``Z``; microseconds only where there are any; empty for 0 and null. Session zone must be UTC."""
    t = F.timestamp_millis(ms)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.coalesce(ms, F.lit(0)) == 0, "").when(ms % 1000 == 0, F.concat(whole, F.lit("Z"))).otherwise(F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))


def e7_degrees(e7: Column) -> Column:
    return F.nullif(e7, F.lit(0)) / 1e7


def rich_text(raw: Column) -> Column:
    """A JSON string, or an array of strings and objects with ``text``, as plain text."""
    parts = F.from_json(raw, "array<string>")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(F.get_json_object(p, "$.text"), p)), "")
    return F.when(raw.startswith("["), joined).otherwise(text(raw))


def canonical_format(mime: Column, with_binary: bool) -> Column:
    known = F.when(mime.startswith("text/"), "text").when(mime.contains("json"), "json").otherwise("unknown")
    return F.when(mime == "application/octet-stream", "binary").otherwise(known) if with_binary else known



"""Exports to records: each job turns one source's content into an array of uniform records.

A job is an expression over ``content`` (JSON) or ``raw_text``; the right one is chosen per row,
so that all exports are read in one pass and exploded once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import ids
from shelfmark.functions.ids import first_set, text
from shelfmark.functions.text import CHAT_EU, CHAT_SENDER, CHAT_US, chat_time_eu, chat_time_us, e7_degrees, epoch_ms_iso, event_date, ics_line, ics_value, normalized_filename, rich_text, shown_ics_time, unfold_ics
from shelfmark.operators.inventory import latest_by_key

LISTS = ("people", "places", "apps", "devices", "accounts", "topics", "tags")
NUMBERS = {"amount": None, "quantity": None, "geo_lat": None, "geo_lon": None, "confidence": 0.8, "importance_score": 0.5}
TEXTS = {
    "record_type": "generic_record", "subtype": "default", "event_time_start": "", "event_time_end": "", "event_date": None, "title": "", "summary": "", "raw_text": "",
    "normalized_text": "", "url": "", "external_id": "", "conversation_id": "", "message_id": "", "thread_id": "", "place_name": "", "status": "active",
}
RECORD_FIELDS = [*TEXTS, *LISTS, *NUMBERS, "currency"]


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v)


def record(**given) -> Column:
    """A record struct with all fields; what is not given has its default, the date that of the start."""
    out = {}
    for k, default in TEXTS.items():
        out[k] = F.coalesce(_lit(given[k]).cast("string"), F.lit(default or "")) if k in given else F.lit(default)
    if "event_date" not in given:
        out["event_date"] = F.substring(out["event_time_start"], 1, 10)
    for k in LISTS:
        v = given.get(k)
        v = F.array(*map(_lit, v)) if isinstance(v, list) else v
        out[k] = F.array().cast("array<string>") if v is None else F.coalesce(v.cast("array<string>"), F.array().cast("array<string>"))
    for k, default in NUMBERS.items():
        out[k] = F.coalesce(_lit(given[k]).cast("double"), F.lit(default).cast("double")) if k in given else F.lit(default).cast("double")
    out["currency"] = _lit(given.get("currency")).cast("string")
    return F.struct(*[out[k].alias(k) for k in RECORD_FIELDS])


def _one_or_none(value: Column) -> Column:
    return F.when(text(value) != "", F.array(value)).otherwise(F.array().cast("array<string>"))


# The titles, record types, subtypes, apps, topics, confidences and scores that the jobs below give are those
# of the record format, and so are the names of the export's own fields.


def _chat(convs: Column, *, conv, turn, turns) -> Column:
    """Conversation records, each followed by its turns' records."""
    return F.flatten(F.transform(convs, lambda c: F.concat(F.array(conv(c, turns(c))), F.transform(turns(c), lambda t, i: turn(c, t, i)))))


def _joined(turns: Column, content, cut: int) -> tuple[Column, Column]:
    """Turn texts by line, each cut, and whole ones by space."""
    texts = F.transform(turns, content)
    return F.array_join(F.transform(texts, lambda x: F.substring(x, 1, cut)), "\n"), F.array_join(texts, " ")


def _turn_record(conv_id: Column, role: Column, body: Column, start: Column, created: Column, turn_id: Column, i: Column, **more) -> Column:
    own = F.coalesce(turn_id, F.concat(conv_id, F.lit(":"), i.cast("string")))
    day = first_set(F.substring(text(start), 1, 10), F.substring(text(created), 1, 10))
    title = F.concat(F.lit("Turn "), (i + 1).cast("string"), F.lit(" ("), role, F.lit(")"))
    return record(record_type="llm_turn", subtype=role, event_time_start=start, event_date=day, title=title, summary=F.substring(body, 1, 200), raw_text=body, normalized_text=body, conversation_id=conv_id, message_id=own, external_id=own, **more)


_GPT = "struct<conversations:array<struct<id:string,title:string,model:string,create_time:string,topics:array<string>,personal_relevance_score:double,turns:array<struct<id:string,role:string,timestamp:string,content:string>>>>>"


def chatgpt(content: Column) -> Column:
    empty = F.array().cast("array<struct<id:string,role:string,timestamp:string,content:string>>")

    def conv(c, turns):
        raw, norm = _joined(turns, lambda t: text(t["content"]), 500)
        model, cid = F.coalesce(c["model"], F.lit("unknown")), text(c["id"])
        return record(
            record_type="llm_conversation", subtype=model, event_time_start=c["create_time"], title=F.coalesce(c["title"], F.concat(F.lit("ChatGPT conversation "), cid)),
            summary=F.concat(F.size(turns).cast("string"), F.lit(" turns with model "), model), raw_text=raw, normalized_text=norm, apps=["chatgpt"], topics=c["topics"], conversation_id=cid, external_id=cid, confidence=0.95,
            importance_score=F.coalesce(c["personal_relevance_score"], F.lit(0.7)),
        )

    def turn(c, t, i):
        start = F.coalesce(t["timestamp"], text(c["create_time"]))
        return _turn_record(text(c["id"]), F.coalesce(t["role"], F.lit("unknown")), text(t["content"]), start, F.lit(""), t["id"], i, apps=["chatgpt"], topics=c["topics"], confidence=0.9, importance_score=0.45)

    return _chat(F.from_json(content, _GPT)["conversations"], conv=conv, turn=turn, turns=lambda c: F.coalesce(c["turns"], empty))


_MSG = "struct<uuid:string,id:string,sender:string,role:string,text:string,content:string,created_at:string,createTime:string,timestamp:string,topics:array<string>>"
_CONV = f"struct<uuid:string,id:string,name:string,title:string,created_at:string,create_time:string,createTime:string,updated_at:string,topics:array<string>,chat_messages:array<{_MSG}>,messages:array<{_MSG}>,turns:array<{_MSG}>>"


def _conversations(content: Column) -> Column:
    """A list, an object with ``conversations``, or one conversation by itself."""
    wrapped = F.when(content.startswith("["), F.concat(F.lit('{"conversations":'), content, F.lit("}"))).otherwise(content)
    listed = F.from_json(wrapped, f"struct<conversations:array<{_CONV}>>")["conversations"]
    single = F.from_json(content, _CONV)
    return F.when(F.size(listed) > 0, listed).when(single["chat_messages"].isNotNull(), F.array(single))


def claude(content: Column) -> Column:
    body = lambda m: F.coalesce(m["text"], m["content"], F.lit(""))
    cid = lambda c: F.coalesce(c["uuid"], c["id"], F.lit(""))
    created = lambda c: F.coalesce(c["created_at"], c["create_time"], F.lit(""))
    empty = F.array().cast(f"array<{_MSG}>")

    def conv(c, turns):
        raw, norm = _joined(turns, body, 300)
        return record(
            record_type="llm_conversation", subtype="claude", event_time_start=created(c), event_time_end=c["updated_at"], title=F.coalesce(c["name"], c["title"], F.concat(F.lit("Claude conversation "), cid(c))),
            summary=F.concat(F.size(turns).cast("string"), F.lit(" messages")), raw_text=raw, normalized_text=norm, apps=["claude"], topics=c["topics"], conversation_id=cid(c), external_id=cid(c), confidence=0.95, importance_score=0.75,
        )

    def turn(c, m, i):
        start = F.coalesce(m["created_at"], m["timestamp"], created(c))
        return _turn_record(cid(c), F.coalesce(m["sender"], m["role"], F.lit("unknown")), body(m), start, created(c), F.coalesce(m["uuid"], m["id"]), i, apps=["claude"], confidence=0.9, importance_score=0.45)

    return _chat(_conversations(content), conv=conv, turn=turn, turns=lambda c: F.coalesce(c["chat_messages"], c["messages"], empty))


def gemini(content: Column) -> Column:
    body = lambda m: F.coalesce(m["content"], m["text"], F.lit(""))
    created = lambda c: F.coalesce(c["createTime"], c["create_time"], F.lit(""))
    empty = F.array().cast(f"array<{_MSG}>")

    def conv(c, turns):
        raw, norm = _joined(turns, body, 300)
        cid = text(c["id"])
        return record(
            record_type="llm_conversation", subtype="gemini", event_time_start=created(c), title=F.coalesce(c["title"], F.concat(F.lit("Gemini conversation "), cid)), summary=F.concat(F.size(turns).cast("string"), F.lit(" turns")),
            raw_text=raw, normalized_text=norm, apps=["gemini"], topics=c["topics"], conversation_id=cid, external_id=cid, confidence=0.93, importance_score=0.7,
        )

    def turn(c, m, i):
        start = F.coalesce(m["timestamp"], m["createTime"], created(c))
        return _turn_record(text(c["id"]), F.coalesce(m["role"], F.lit("unknown")), body(m), start, created(c), m["id"], i, apps=["gemini"], confidence=0.9, importance_score=0.4)

    return _chat(_conversations(content), conv=conv, turn=turn, turns=lambda c: F.coalesce(c["turns"], c["messages"], empty))


_TRANSCRIPT = f"struct<id:string,model:string,created_at:string,title:string,topics:array<string>,metadata:struct<id:string,model:string,created_at:string,title:string>,messages:array<{_MSG}>,turns:array<{_MSG}>>"


def transcript(content: Column) -> Column:
    c = F.from_json(content, _TRANSCRIPT)
    meta = lambda f, d: F.coalesce(c["metadata"][f], c[f], F.lit(d))
    model, cid, created = meta("model", "unknown"), meta("id", ""), meta("created_at", "")
    body = lambda m: F.coalesce(m["content"], m["text"], F.lit(""))
    turns = F.coalesce(c["messages"], c["turns"])
    raw, norm = _joined(turns, body, 300)
    apps = F.when(model != "unknown", F.array(model)).otherwise(F.array().cast("array<string>"))
    head = record(
        record_type="llm_conversation", subtype=model, event_time_start=created, title=F.coalesce(c["metadata"]["title"], c["title"], F.concat(F.lit("LLM transcript ("), model, F.lit(")"))),
        summary=F.concat(F.size(turns).cast("string"), F.lit(" messages, model: "), model), raw_text=raw, normalized_text=norm, apps=apps, topics=c["topics"], conversation_id=cid, external_id=cid, confidence=0.85, importance_score=0.6,
    )

    def turn(m, i):
        own = F.coalesce(m["id"], F.when(cid == "", i.cast("string")))
        start = F.coalesce(m["timestamp"], m["created_at"], created)
        return _turn_record(cid, F.coalesce(m["role"], F.lit("unknown")), body(m), start, created, own, i, apps=apps, topics=m["topics"], confidence=0.8, importance_score=0.4)

    return F.when(F.size(turns) > 0, F.concat(F.array(head), F.transform(turns, turn)))


_THREADS = "struct<threads:array<struct<id:string,title:string,created_at:string,turns:array<struct<role:string,timestamp:string,content:string>>>>>"


def perplexity(content: Column) -> Column:
    title = lambda c: F.coalesce(c["title"], F.lit("Perplexity Thread"))
    empty = F.array().cast("array<struct<role:string,timestamp:string,content:string>>")

    def conv(c, _):
        return record(record_type="llm_conversation", subtype="perplexity_thread", event_time_start=c["created_at"], title=title(c), summary=title(c), external_id=c["id"], conversation_id=c["id"])

    def turn(c, t, _):
        role = F.coalesce(t["role"], F.lit("unknown"))
        return record(record_type="llm_turn", subtype=role, event_time_start=F.coalesce(t["timestamp"], c["created_at"]), title=F.concat(F.lit("Turn ("), role, F.lit(") in "), title(c)), summary=F.substring(text(t["content"]), 1, 200), raw_text=t["content"], conversation_id=c["id"])

    return _chat(F.from_json(content, _THREADS)["threads"], conv=conv, turn=turn, turns=lambda c: F.coalesce(c["turns"], empty))


def _items(content: Column, key: str, fields: str, make) -> Column:
    return F.transform(F.from_json(content, f"struct<{key}:array<struct<{fields}>>>")[key], make)


def play_installs(content: Column) -> Column:
    def make(r):
        app = lambda d: F.coalesce(r["app_name"], F.lit(d))
        return record(
            record_type="app_install", subtype=F.coalesce(r["install_source"], F.lit("google_play")), event_time_start=r["installed_at"], title=F.concat(F.lit("Install "), app("Unknown App")),
            summary=F.concat(app("Unknown"), F.lit(" on "), F.coalesce(r["device"], F.lit("unknown device"))), raw_text=r["raw"], apps=[app("")], devices=_one_or_none(r["device"]), accounts=_one_or_none(r["account"]),
            topics=["install", "google_play"], external_id=r["package_name"], confidence=0.95, importance_score=0.7,
        )

    return _items(content, "installed_apps", "app_name:string,package_name:string,installed_at:string,device:string,account:string,install_source:string,raw:string", make)


def my_activity(content: Column) -> Column:
    def make(r):
        return record(
            record_type="activity_event", subtype=F.coalesce(r["product"], F.lit("unknown")), event_time_start=r["time"], title=F.coalesce(r["title"], F.lit("Google activity")), summary=r["description"], raw_text=r["description"],
            apps=[text(r["product"])], topics=[F.coalesce(r["type"], F.lit("activity"))], url=r["url"], external_id=r["id"], confidence=0.9, importance_score=0.55,
        )

    return _items(content, "activity", "id:string,time:string,product:string,type:string,title:string,description:string,url:string", make)


def timeline(content: Column) -> Column:
    schema = "struct<timeline_objects:array<struct<placeVisit:struct<location:struct<name:string,address:string,latitudeE7:bigint,longitudeE7:bigint>,duration:struct<startTimestamp:string,endTimestamp:string>>>>>"
    visits = F.filter(F.from_json(content, schema)["timeline_objects"], lambda o: o["placeVisit"].isNotNull())

    def make(o):
        loc, dur = o["placeVisit"]["location"], o["placeVisit"]["duration"]
        return record(
            record_type="place_visit", subtype="timeline_place_visit", event_time_start=dur["startTimestamp"], event_time_end=dur["endTimestamp"], title=F.concat(F.lit("Visited "), F.coalesce(loc["name"], F.lit("Unknown Place"))),
            summary=loc["address"], places=[text(loc["name"])], place_name=loc["name"], geo_lat=e7_degrees(loc["latitudeE7"]), geo_lon=e7_degrees(loc["longitudeE7"]), topics=["visit", "timeline"], confidence=0.96, importance_score=0.8,
        )

    return F.transform(visits, make)


def _calendar_record(**given) -> Column:
    place = given.pop("place")
    return record(record_type="calendar_event", places=_one_or_none(place), place_name=place, apps=["google-calendar"], topics=["calendar", "event"], confidence=0.95, importance_score=0.7, **given)


def calendar(content: Column, raw_text: Column) -> Column:
    # each step's values are worked out once and named: an expression inside a lambda is evaluated wherever it stands
    def fields(u):
        lines = {"start": "DTSTART", "end": "DTEND", "title": "SUMMARY", "note": "DESCRIPTION", "place": "LOCATION", "uid": "UID"}
        of = lambda k, name: ics_value(ics_line(u, name)) if k in ("start", "end") else ics_line(u, name)
        return F.struct(*[of(k, name).alias(k) for k, name in lines.items()], F.trim(u).alias("whole"))

    def with_times(f):
        return F.struct(*[(shown_ics_time(f[k]) if k in ("start", "end") else f[k]).alias(k) for k in ("start", "end", "title", "note", "place", "uid", "whole")])

    def from_block(f):
        return _calendar_record(
            subtype="icalendar", event_time_start=f["start"], event_time_end=f["end"], title=first_set(f["title"], F.lit("Calendar event")), summary=F.substring(first_set(f["note"], f["title"]), 1, 200), raw_text=f["whole"],
            normalized_text=F.trim(F.concat_ws(" ", f["title"], f["note"], f["place"])), place=f["place"], external_id=f["uid"],
        )

    def from_event(e):
        start, end = (F.coalesce(e[k]["dateTime"], e[k]["date"], F.lit("")) for k in ("start", "end"))
        return _calendar_record(
            subtype="google_takeout", event_time_start=start, event_time_end=end, title=F.coalesce(e["summary"], F.lit("Calendar event")), summary=F.substring(text(e["description"]), 1, 200), raw_text=e["description"],
            normalized_text=F.trim(F.concat_ws(" ", text(e["summary"]), text(e["description"]), text(e["location"]))), place=text(e["location"]), external_id=F.coalesce(e["id"], e["iCalUID"]),
        )

    found = F.regexp_extract_all(text(raw_text), F.lit("(?is)BEGIN:VEVENT(.*?)END:VEVENT"), F.lit(1))
    blocks = F.transform(F.transform(F.transform(F.transform(found, unfold_ics), fields), with_times), from_block)
    when = "struct<dateTime:string,date:string>"
    events = _items(content, "events", f"id:string,iCalUID:string,summary:string,description:string,location:string,start:{when},end:{when}", from_event)
    return _or_else(blocks, lambda: events)


def tasks(content: Column) -> Column:
    def make(r):
        return record(record_type="task", subtype="todo", event_time_start=first_set(r["updated"], r["due"]), title=F.coalesce(r["title"], F.lit("Untitled Task")), summary=r["notes"], external_id=r["id"], status=F.coalesce(r["status"], F.lit("needsAction")))

    return _items(content, "items", "id:string,title:string,notes:string,updated:string,due:string,status:string", make)


def contacts(content: Column) -> Column:
    def make(r):
        name = F.coalesce(r["name"], F.lit("Unknown"))
        return record(record_type="contacts_export", subtype="contact", title=F.concat(F.lit("Contact: "), name), people=[name], summary=r["email"], external_id=r["id"])

    return _items(content, "contacts", "id:string,name:string,email:string", make)


def instagram(content: Column) -> Column:
    def make(r):
        sender, body = F.coalesce(r["sender_name"], F.lit("Unknown")), text(r["content"])
        return record(record_type="message_event", subtype="instagram_message", event_time_start=epoch_ms_iso(r["timestamp_ms"]), title=F.concat(F.lit("Instagram message from "), sender), summary=F.substring(body, 1, 200), raw_text=body, people=[sender])

    return _items(content, "messages", "sender_name:string,content:string,timestamp_ms:bigint", make)


def whatsapp(raw_text: Column) -> Column:
    """Chat lines of the European form, or of the American one where a source has none of those."""
    lines = F.split(text(raw_text), "\r?\n")

    def records(pattern: str, sender_at: int, start, confidence: float) -> Column:
        def make(x):
            sender, body = F.trim(F.regexp_extract(x, pattern, sender_at)), F.regexp_extract(x, pattern, sender_at + 1)
            return record(
                record_type="message_event", subtype="whatsapp_text", event_time_start=start(x), title=F.concat(sender, F.lit(": "), F.substring(body, 1, 60)), summary=F.substring(body, 1, 200), raw_text=body, normalized_text=F.lower(body),
                people=[sender], apps=["whatsapp"], topics=["messaging"], external_id=F.concat(start(x), F.lit(":"), sender), confidence=confidence, importance_score=0.5,
            )

        return F.transform(F.filter(lines, lambda x: x.rlike(pattern)), make)

    return _or_else(records(CHAT_EU, CHAT_SENDER, chat_time_eu, 0.92), lambda: records(CHAT_US, CHAT_SENDER, chat_time_us, 0.9))


def telegram(content: Column) -> Column:
    schema = "struct<chats:struct<list:array<struct<id:string,name:string,messages:array<struct<id:string,type:string,date:string,from:string,text:string>>>>>>"

    def messages(chat):
        name = F.coalesce(chat["name"], F.lit("Unknown Chat"))

        def make(m):
            sender, body = F.coalesce(m["from"], F.lit("Unknown")), rich_text(m["text"])
            return record(
                record_type="message_event", subtype="telegram_message", event_time_start=m["date"], title=F.concat(F.lit("Message from "), sender, F.lit(" in "), name), summary=F.substring(body, 1, 200), raw_text=body, people=[sender],
                external_id=m["id"], conversation_id=chat["id"],
            )

        return F.transform(F.filter(chat["messages"], lambda m: m["type"] == "message"), make)

    return F.flatten(F.transform(F.from_json(content, schema)["chats"]["list"], messages))


def generic_items(content: Column) -> Column:
    def make(r):
        return record(
            record_type=F.coalesce(r["record_type"], F.lit("generic_json_export")), subtype=F.coalesce(r["subtype"], F.lit("item")), event_time_start=r["timestamp"], title=F.coalesce(r["title"], F.lit("Generic JSON Item")), summary=r["summary"],
            raw_text=r["raw_text"], normalized_text=r["raw_text"], topics=r["topics"], apps=r["apps"], people=r["people"], url=r["url"], external_id=r["id"], confidence=F.coalesce(r["confidence"], F.lit(0.6)), importance_score=F.coalesce(r["importance_score"], F.lit(0.4)),
        )

    return _items(content, "items", "id:string,record_type:string,subtype:string,timestamp:string,title:string,summary:string,raw_text:string,topics:array<string>,apps:array<string>,people:array<string>,url:string,confidence:double,importance_score:double", make)


JOBS = {
    "chatgpt_export": lambda c, r: chatgpt(c),
    "claude_export": lambda c, r: claude(c),
    "gemini_chat_export": lambda c, r: gemini(c),
    "llm_json_transcript": lambda c, r: transcript(c),
    "perplexity_export": lambda c, r: perplexity(c),
    "google_play_installs": lambda c, r: play_installs(c),
    "google_my_activity": lambda c, r: my_activity(c),
    "google_timeline": lambda c, r: timeline(c),
    "google_calendar": calendar,
    "google_tasks": lambda c, r: tasks(c),
    "google_contacts": lambda c, r: contacts(c),
    "instagram_export": lambda c, r: instagram(c),
    "whatsapp_export": lambda c, r: whatsapp(r),
    "telegram_export": lambda c, r: telegram(c),
    "generic_json_export": lambda c, r: generic_items(c),
}

_DEFAULTS = "struct<title:string,summary:string,raw_text:string,normalized_text:string,subtype:string,event_time_start:string,event_time_end:string,event_date:string,people:array<string>,places:array<string>,apps:array<string>,devices:array<string>,accounts:array<string>,topics:array<string>,tags:array<string>,url:string,external_id:string,conversation_id:string,message_id:string,thread_id:string,amount:double,currency:string,quantity:double,geo_lat:double,geo_lon:double,place_name:string,confidence:double,importance_score:double,status:string>"


def default_record(content: Column) -> Column:
    """An array of one record from the content's own fields, for sources whose job finds nothing."""

    def make(c):
        fields = {f: c[f] for f in RECORD_FIELDS if f not in ("record_type", "title", "event_date", "normalized_text", "raw_text")}
        raw = F.coalesce(c["raw_text"], F.col("raw_text"))
        day = first_set(c["event_date"], F.substring(text(c["event_time_start"]), 1, 10), F.substring(text("coverage_start"), 1, 10))
        return record(record_type=F.col("default_record_type"), title=F.coalesce(c["title"], F.col("original_filename")), event_date=day, raw_text=raw, normalized_text=F.coalesce(c["normalized_text"], raw), **fields)

    return F.transform(F.array(F.from_json(content, _DEFAULTS)), make)  # the content is taken apart once, not for each field


def build_sources(resolved: DataFrame, project: str, scanned_at: str) -> DataFrame:
    """Registry rows of resolved sources, keyed by ``source_id``.

    A file keeps its identity when it is renamed or moved: the key is of its id, else of its checksum, else of its content.
    """
    content = F.coalesce("content", F.lit("{}"))
    whole = ids.content_hash(content)
    have = set(resolved.columns)
    given = lambda c, default="": text(c) if c in have else F.lit(default)
    flag = lambda c, default=False: F.coalesce(F.col(c), F.lit(default)) if c in have else F.lit(default)
    named = first_set(given("file_id"), given("checksum_sha256"))
    stable = first_set(named, ids.content_hash(F.when(named == "", content)))  # contents of named sources do not leave the JVM for their keys
    rows = resolved.withColumn("source_key", F.concat_ws(":", F.lit(project), stable, "parser_name", "parser_version"))
    return rows.select(
        F.lit(project).alias("project_id"), ids.source_id(F.lit(project), F.col("source_key")).alias("source_id"), "source_key", text("file_id").alias("file_id"),
        *[given(c).alias(c) for c in ("bundle_id", "parent_bundle_id")], "source_system", "source_service", F.lit("").alias("source_subservice"), "source_app", F.lit("export").alias("source_kind"), "source_format",
        "source_path", first_set(given("source_path_rel"), "source_path").alias("source_path_rel"), "original_filename", normalized_filename(F.col("original_filename")).alias("normalized_filename"),
        given("mime").alias("mime"), given("ext").alias("ext"), first_set(given("checksum_sha256"), whole).alias("checksum_sha256"), whole.alias("semantic_hash"), "parser_name", "parser_version", F.lit("success").alias("parser_status"),
        *[F.lit("").alias(c) for c in ("parse_error", "parse_warning")],
        first_set(F.get_json_object(content, "$.export_time"), given("created_at")).alias("export_time"),
        first_set(F.get_json_object(content, "$.coverage_start"), given("coverage_start"), given("created_at")).alias("coverage_start"), first_set(F.get_json_object(content, "$.coverage_end"), given("coverage_end"), given("modified_at")).alias("coverage_end"),
        given("created_at").alias("created_at"), given("modified_at").alias("modified_at"), F.lit(scanned_at).alias("scanned_at"), given("llm_readiness", "medium").alias("llm_readiness"), given("sensitivity", "unknown").alias("sensitivity"),
        given("status", "indexed").alias("status"), given("sot_status", "derived").alias("sot_status"), first_set(given("canonical_format"), "source_format").alias("canonical_format"), flag("is_export", True).alias("is_export"),
        *[flag(c).alias(c) for c in ("is_bundle", "is_archive", "is_incremental", "contains_pii", "contains_geo", "contains_financial", "contains_messages", "contains_media_refs")],
        given("source_url").alias("source_url"), first_set(given("raw_ref"), given("web_link"), "source_path").alias("raw_ref"), given("notes").alias("notes"),
        "default_record_type", "content", given("raw_text").alias("raw_text"), *(["seq"] if "seq" in have else []),
    )


def _or_else(found: Column, other) -> Column:
    """``found`` if it has elements, else ``other()``; ``found`` is worked out once."""
    return F.flatten(F.transform(F.array(found), lambda x: F.when(F.size(x) > 0, x).otherwise(other())))


def parse_sources(sources: DataFrame, ingested_at: str, jobs: list[str] | None = None) -> DataFrame:
    """The records of all sources of ``build_sources``, one row per ``record_id``, the last in order if several share one.

    ``jobs`` names those that can occur, if that is known, which makes for a smaller plan.
    """
    found = None
    for name in [j for j in jobs or JOBS if j in JOBS]:
        made = JOBS[name](F.col("content"), F.col("raw_text"))
        found = F.when(F.col("parser_name") == name, made) if found is None else found.when(F.col("parser_name") == name, made)
    plain = lambda: default_record(F.col("content"))
    records = plain() if found is None else _or_else(found, plain)
    rows = sources.withColumn("__records", records).select(*[c for c in sources.columns if c not in RECORD_FIELDS], F.posexplode("__records").alias("pos", "r"))
    return latest_by_key(build_records(rows, ingested_at), "record_id", "pos")


def build_records(rows: DataFrame, ingested_at: str) -> DataFrame:
    """Index rows from (source columns, pos, r: record struct)."""
    r = lambda c: F.col(f"r.{c}")
    title = F.coalesce(r("title"), F.col("original_filename"))
    return rows.select(
        ids.record_id(F.col("source_id"), r("record_type"), r("external_id"), r("event_time_start"), title).alias("record_id"), "source_id", "source_key", "file_id", "parser_name", r("record_type").alias("record_type"), r("subtype").alias("subtype"),
        "source_system", "source_service", "source_app", r("event_time_start").alias("event_time_start"), r("event_time_end").alias("event_time_end"), event_date(r("event_date"), r("event_time_start")).alias("event_date"),
        F.lit(ingested_at).alias("ingestion_time"), title.alias("title"), F.substring(title, 1, 120).alias("compact_title"), r("summary").alias("summary"), F.substring(r("summary"), 1, 240).alias("compact_summary"),
        *[r(c).alias(c) for c in ("raw_text", "normalized_text", "status", "confidence", "importance_score", *LISTS, "geo_lat", "geo_lon", "place_name", "amount", "currency", "quantity", "url", "external_id", "conversation_id", "message_id", "thread_id")],
        F.array().cast("array<string>").alias("related_entity_ids"), F.array().cast("array<string>").alias("related_record_ids"), "raw_ref", F.sha2(F.to_json("r"), 256).alias("checksum_sha256"), "pos",
    )

import io
import json
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import graph, rollups, stats, views
from shelfmark.plans import bindings, feeds, registry
from shelfmark.sources import archives, exports, files, rules, tables

SOURCE = "file_id string, source_path string, original_filename string, content string, raw_text string, text_preview string"


def parse(spark, name, content=None, raw=""):
    rows = spark.createDataFrame([("f1", "in/" + name, name, json.dumps(content or {}), raw, raw[:1000])], SOURCE)
    return exports.parse_sources(exports.build_sources(rules.resolve_parser(rows), "p", "now"), "now").orderBy("pos").collect()


def test_claude_forms(spark):
    conv = {"uuid": "u", "name": "N", "created_at": "2025-03-15T10:00:00Z", "chat_messages": [{"uuid": "m", "sender": "human", "text": "hi"}, {"sender": "assistant", "content": "yo"}]}
    for content in (conv, [conv], {"conversations": [conv]}):
        got = parse(spark, "x.json", content)
        assert [r["record_type"] for r in got] == ["llm_conversation", "llm_turn", "llm_turn"] and got[0]["parser_name"] == "claude_export" and got[0]["raw_text"] == "hi\nyo"
        assert got[2]["external_id"] == "u:1" and got[2]["event_date"] == "2025-03-15" and got[2]["title"] == "Turn 2 (assistant)"


def test_chat_lines_of_both_forms(spark):
    eu = "[05.03.2024, 10:11:12] Ann: hello: there\r\ncontinued\n[05.03.2024, 10:12:12] Bob: ok"
    got = parse(spark, "whatsapp.txt", raw=eu)
    assert [(r["people"], r["raw_text"]) for r in got] == [(["Ann"], "hello: there"), (["Bob"], "ok")]
    us = parse(spark, "chat.bin", raw="3/5/24, 12:11 AM - Ann: hi\n")
    assert us[0]["parser_name"] == "whatsapp_export" and us[0]["event_time_start"] == "2024-03-05T00:11:00Z" and us[0]["confidence"] == 0.9


def test_calendar_and_default(spark):
    ics = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nDTSTART;TZID=X:20240305T101112\r\nSUMMARY:Long\r\n  title\r\nUID:1\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART;VALUE=DATE:20240306\r\nUID:2\r\nEND:VEVENT\r\nEND:VCALENDAR"
    got = parse(spark, "a.ics", raw=ics)
    assert [(r["event_time_start"], r["title"], r["external_id"]) for r in got] == [("2024-03-05T10:11:12", "Long title", "1"), ("2024-03-06", "Calendar event", "2")]
    (only,) = parse(spark, "keep note.bin", {"summary": "s", "event_time_start": "2024-01-02T3", "people": ["A"]})
    assert (only["record_type"], only["title"], only["event_date"], only["people"], only["confidence"]) == ("note_event", "keep note.bin", "2024-01-02", ["A"], 0.8)


def test_rule_order_is_data(spark):
    rows = spark.createDataFrame([(n, "p/" + n, n, json.dumps(c), "", "") for n, c in [("display.bin", {}), ("x.html", {}), ("messages.json", {"messages": []}), ("gemini.json", {"conversations": [{"turns": []}]}), ("c.json", {"conversations": [{"turns": [], "model": "m"}]}), ("takeout.zip", {}), ("plain", {})]], SOURCE)
    got = {r["file_id"]: r["parser_name"] for r in rules.resolve_parser(rows).collect()}
    assert got == {"display.bin": "google_play_installs", "x.html": "llm_html_export", "messages.json": "llm_json_transcript", "gemini.json": "gemini_chat_export", "c.json": "chatgpt_export", "takeout.zip": "generic_zip_bundle", "plain": rules.FALLBACK}
    own = rules.resolve_parser(rows.where("file_id = 'messages.json'"), [r for r in rules.RULES if r.name == "instagram_export"])
    assert own.first()["parser_name"] == "instagram_export"


def test_graph_of_two_sources(spark):
    make = lambda f: spark.createDataFrame([(f, f"in/{f}.json", f"{f}.json", json.dumps({"items": [{"id": "1", "title": "T", "people": ["Ann", "Bob", "Cyd"], "apps": ["App"], "topics": ["Top"], "timestamp": day} for day in days]}), "", "") for f, days in [(f, ["2024-01-02", "2024-01-01"])]], SOURCE)
    rows = make("export1").unionByName(make("export2"))
    records = exports.parse_sources(exports.build_sources(rules.resolve_parser(rows), "p", "now"), "now").cache()
    child = graph.entity_sources(records).cache()
    merged = {r["canonical_name"]: r for r in graph.merge_entities(child).collect()}
    assert len(merged["ann"]["source_ids"]) == 2 and merged["ann"]["mentions"] == 4 and (merged["ann"]["first_seen"], merged["ann"]["last_seen"]) == ("2024-01-01", "2024-01-02")
    again = {r["canonical_name"]: r["mentions"] for r in graph.merge_entities(child, child).collect()}
    assert again["ann"] == 4  # running twice changes nothing
    rel = graph.source_relations(records).cache()
    assert rel.groupBy("source_id", "predicate").count().where("predicate = 'communicated_with'").first()["count"] == 3
    ends = graph.merge_entities(child).select(F.col("entity_id").alias("subject_entity_id"))
    assert rel.join(ends, "subject_entity_id", "left_anti").count() == 0
    linked = graph.link_entities(records, child).first()
    assert len(linked["related_entity_ids"]) == 5
    assert {r["relation_count"] for r in stats.source_summary(records, child, rel).collect()} == {rel.count() // 2}


def test_zip_members(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, data in (("../up/a.json", b"{}"), ("d/", b""), ("b.exe", b"x"), ("big.txt", b"x" * 100), ("c.txt", b"hello")):
            z.writestr(name, data)
    broken = bytearray(buffer.getvalue())
    broken[broken.find(b"hello")] ^= 1
    rows = spark.createDataFrame([("z", "sha", bytes(buffer.getvalue()), "ORIGINAL"), ("y", None, bytes(broken), "ORIGINAL"), ("n", None, b"no zip", "ORIGINAL")], "file_id string, checksum_sha256 string, content binary, status string")
    got = files.expand_archives(rows, member_limit=50).collect()
    assert sorted((r["bundle_id"], r["source_path"], r["problem"] is None) for r in got) == [("n", "", False), ("y", "c.txt", False), ("y", "up/a.json", True), ("z", "c.txt", True), ("z", "up/a.json", True)]
    assert all(r["file_id"].startswith(r["bundle_id"]) for r in got)


def test_files_to_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1}')
    (tmp_path / "in" / "b.json").write_text("{broken")
    (tmp_path / "in" / "c.txt").write_text("x" * 300)
    (tmp_path / "in" / "d.zip").write_bytes(b"PK")
    got = {r["original_filename"]: r for r in files.ingest_exports(files.scan_files(spark, f"{tmp_path}/in", 1000)).collect()}
    assert got["a.json"]["content"] == '{"k": 1}' and list(got["a.json"]["preview_keys"]) == ["k"] and json.loads(got["b.json"]["content"])["raw_text"] == "{broken"
    assert len(json.loads(got["c.txt"]["content"])["summary"]) == 200 and got["d.zip"]["is_archive"] and got["d.zip"]["mime"] == "application/octet-stream"
    assert files.scan_files(spark, f"{tmp_path}/in", 10).count() == 3


def test_tables(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "x.jsonl").write_text('{"id":"a","v":1}\n\n{broken\n{"v":9}\n{"id":"a","v":2}\n{"id":"b","v":3}\n')
    schema = spark.createDataFrame([], "id string, v int").schema
    assert {r["id"]: r["v"] for r in tables.read_index(spark, root + "/x.jsonl", schema, "id").collect()} == {"a": 2, "b": 3}
    one, two = spark.createDataFrame([("a", 1)], schema), spark.createDataFrame([("b", 2)], schema)
    assert tables.read_published(spark, root, "t", schema).count() == 0
    tables.publish(one, root, "t", "1")
    tables.publish_all({"t": two, "u": one}, root, "2")
    assert tables.read_published(spark, root, "t", schema).collect() == two.collect() and tables.current_version(spark, root, "u") == "2"
    tables.publish(one, root, "t", "2")
    assert tables.read_published(spark, root, "t", schema).collect() == one.collect()
    log = spark.createDataFrame([("r1", "x" * 600)], "run_id string, error_message string")
    tables.append_log(log, root + "/log")
    tables.append_log(log, root + "/log")
    assert [len(r["error_message"]) for r in spark.read.parquet(root + "/log").collect()] == [500, 500]


def test_rollup_ties_and_limits(spark):
    rows = [(k, f"r{k}", "2024-12-30", "note", f"t{k % 16}", 0.5 if k % 16 else None, ["B", "A"], [], ["x"], "s", "") for k in range(32)] + [(99, "r99", "bad day", "llm_turn", "", 1.0, [], [], [], "s", "u"), (98, "r98", "", "task", "t", 1.0, [], [], [], "s", "")]
    df = spark.createDataFrame(rows, "seq long, record_id string, event_date string, record_type string, title string, importance_score double, people array<string>, places array<string>, apps array<string>, source_id string, url string").withColumn("compact_title", F.col("title"))
    daily = rollups.daily_memory(df.orderBy(F.desc("seq")), "2024-12-31")
    got = {r["date"]: r for r in daily.collect()}
    assert set(got) == {"2024-12-30", "bad day"} and got["2024-12-30"]["key_events"] == [f"t{k}" for k in range(15)] and got["2024-12-30"]["importance_score"] == 15.0 and got["2024-12-30"]["review_due"]
    assert got["bad day"]["llm_activity"] == ["r99"] and not got["bad day"]["review_due"] and got["2024-12-30"]["people"] == ["A", "B"]
    (week,) = rollups.weekly_memory(daily).collect()
    assert week["week"] == "2025-W01" and week["top_people"] == ["A", "B"] and len(week["weekly_highlights"]) == 10


def test_views(spark):
    r = bindings.event_records(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    assert set(views.search_views(r)) == {"all", "fulltext", "by_date", "by_entity", "by_service", "by_topic", "llm_conversations"}
    keys = [x["sort_key"] for x in views.sorted_view(views.base_view(r), "by_topic").select("sort_key").collect()]
    assert keys == sorted(keys)
    texts = spark.createDataFrame([("a", "x" * 19), ("b", "y" * 20), ("c", "Z" * 2001)], "record_id string, raw_text string").withColumns({c: F.lit("") for c in ("normalized_text", "source_id", "event_date", "record_type", "title", "source_app")})
    assert {x["record_id"]: len(x["searchable_text"]) for x in views.fulltext_view(texts).collect()} == {"b": 20, "c": 2000}


def test_every_query_has_sql_and_the_flagship_runs(spark, sf):
    assert set(registry.SQL) == set(registry.QUERIES)
    assert registry.QUERIES[registry.FLAGSHIP](spark, sf).count() > 0


def test_publishing_leaves_no_gap(spark, tmp_path, monkeypatch):
    root, rows = f"file://{tmp_path}", spark.range(3)
    read = lambda: tables.read_published(spark, root, "t", rows.schema).count()
    assert read() == 0 and tables.current_version(spark, root, "t") is None
    tables.publish(rows, root, "t", "1")
    for version, at in (("2", "write"), ("3", "pointer")):  # a run that stops before, or while, it points to its version
        def stop(*_):
            raise RuntimeError("stopped")

        with monkeypatch.context() as m:
            if at == "write":
                m.setattr(tables, "point_to", stop)
            else:
                m.setattr(tables.uuid, "uuid4", stop)
            with pytest.raises(RuntimeError, match="stopped"):
                tables.publish(spark.range(7), root, "t", version)
        assert read() == 3 and tables.current_version(spark, root, "t") == "1"
    (tmp_path / "t" / "_pointer-half").write_text("9")  # what such a run may leave is no pointer
    for k in range(4):
        tables.publish(spark.range(k + 4), root, "t", f"v{k}")
        assert read() == k + 4
    assert len(list((tmp_path / "t").glob("CURRENT-*.txt"))) == 2


def test_topics_and_senders_must_be_known(spark):
    edges = spark.createDataFrame([("s", "a", "mentions"), ("s", "b", "mentions"), ("s", "c", "sent_message"), ("s", "d", "visited")], "source_id string, subject string, predicate string")
    child = spark.createDataFrame([("s", "a"), ("s", "a"), ("t", "b"), ("s", "c")], "source_id string, canonical_name string")
    assert sorted(r["subject"] for r in graph.known_edges(edges, child).collect()) == ["a", "c", "d"]


def test_a_calendar_block_is_taken_apart_once(spark):
    raw = "BEGIN:VEVENT\r\nDTSTART;TZID=X:20240305T101112\r\nSUMMARY:A\r\n B\r\nUID:u\r\nEND:VEVENT"
    row = spark.createDataFrame([("{}", raw)], "content string, raw_text string").select(F.explode(exports.calendar(F.col("content"), F.col("raw_text"))).alias("r"))
    assert row.select("r.title", "r.event_time_start", "r.external_id").collect() == [("AB", "2024-03-05T10:11:12", "u")]
    plan = row._jdf.queryExecution().analyzed().toString()
    assert [plan.count(f"^{name}(") for name in ("DTSTART", "DTEND", "SUMMARY", "DESCRIPTION", "LOCATION", "UID")] == [1] * 6


def test_a_default_record_takes_its_content_apart_once(spark):
    row = spark.createDataFrame([('{"title": "A", "summary": "S", "people": ["P"], "url": "u", "amount": 2}', "x", "n", "2024-03-05", "kind")], "content string, raw_text string, original_filename string, coverage_start string, default_record_type string").select(F.explode(exports.default_record(F.col("content"))).alias("r"))
    assert row.select("r.title", "r.summary", "r.people", "r.url", "r.amount", "r.event_date", "r.record_type", "r.raw_text").collect() == [("A", "S", ["P"], "u", 2.0, "2024-03-05", "kind", "x")]
    assert row._jdf.queryExecution().analyzed().toString().count("from_json(") == 1


def test_archives_are_made_and_read_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(archives, "BATCH_BYTES", 5000)
    kind = pa.schema([("conv_id", pa.int64()), ("turns", pa.list_(pa.struct([("turn", pa.int64()), ("text", pa.string())])))])
    made = list(feeds._zip(iter([pa.RecordBatch.from_pylist([{"conv_id": k, "turns": [{"turn": 1, "text": "x" * 1000}, {"turn": 2, "text": None}]} for k in range(40)], kind)])))
    assert sum(map(len, made)) == 40 and len(made) > 5 and all(b.nbytes < 9000 for b in made)
    whole = pa.Table.from_batches(made).combine_chunks().to_batches()[0]
    read = list(files._members(1 << 20)(iter([whole])))
    assert sum(map(len, read)) == 2 * 35 + 5 and 5 < len(read) < 40  # members of small archives share a batch

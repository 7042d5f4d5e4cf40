import hashlib
import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import ids
from shelfmark.functions import text as T
from shelfmark.sources.exports import build_sources


def _key(prefix, **fields):
    return f"{prefix}::" + hashlib.sha256(json.dumps(fields, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:20]


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_ids_follow_the_recipe(spark):
    lit = F.lit
    assert one(spark, ids.source_id(lit("p"), lit("p:f:x:1"))) == _key("src", project_id="p", source_key="p:f:x:1")
    assert one(spark, ids.record_id(lit("s"), lit("t"), lit('q"ö\\'), lit(""), lit("title"))) == _key("rec", source_id="s", record_type="t", external_id='q"ö\\', event_time_start="", title="title")
    assert one(spark, ids.entity_id(lit("app"), lit("ChatGPT"))) == _key("ent", entity_type="app", canonical_name="chatgpt")
    assert one(spark, ids.relation_id(lit("a"), lit("p"), lit("b"), F.array(lit("z"), lit("y")))) == _key("rel", subject="a", predicate="p", object="b", evidence=["y", "z"])
    assert one(spark, ids.content_hash(lit('{"b": 1.50, "a": [1, {"d": null, "c": "ü"}]}'))) == hashlib.sha256('{"a":[1,{"c":"ü","d":null}],"b":1.5}'.encode()).hexdigest()
    assert one(spark, ids.content_hash(F.lit(None).cast("string"))) == hashlib.sha256(b"{}").hexdigest()
    assert one(spark, ids.first_set(F.lit(None), lit(""), lit("x"), lit("y"))) == "x"
    assert one(spark, ids.member_file_id(lit("p"), lit(""), lit("a/b"))) == "p_" + hashlib.sha256(b"pa/b").hexdigest()


@pytest.mark.parametrize(("raw", "want"), [("/a/../b", "b"), ("..\\..\\x\\y", "x/y"), ("a/./b//c", "a/b/c"), ("", ""), (None, ""), ("../..", ""), ("a/b/../../c.txt", "c.txt")])
def test_clean_path(spark, raw, want):
    assert one(spark, T.clean_path(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("raw", "want"), [("My File (1).PDF", "my-file-1.pdf"), ("a.b.txt", "a-b.txt"), ("noext", "noext"), (".hidden", "hidden"), ("...", "unknown"), ("Ü.md", "unknown.md")])
def test_normalized_filename(spark, raw, want):
    assert one(spark, T.normalized_filename(F.lit(raw))) == want


def test_times(spark):
    assert one(spark, T.ics_time(F.lit("20240305"))) == "2024-03-05"
    assert one(spark, T.ics_time(F.lit("TZID=X:20240305T101112"))) == "2024-03-05T10:11:12"
    assert one(spark, T.ics_time(F.lit("20240305T101112Z"))) == "2024-03-05T10:11:12Z"
    assert one(spark, T.chat_time_eu(F.lit("[05.03.2024, 10:11:12] A: b"))) == "2024-03-05T10:11:12Z"
    for clock, want in (("12:05 AM", "00:05"), ("12:05 PM", "12:05"), ("1:05 PM", "13:05"), ("11:05 AM", "11:05")):
        assert one(spark, T.chat_time_us(F.lit(f"3/5/24, {clock} - A: b"))) == f"2024-03-05T{want}:00Z"
    assert one(spark, T.epoch_ms_iso(F.lit(0))) == "" and one(spark, T.epoch_ms_iso(F.lit(1709633472000))) == "2024-03-05T10:11:12Z"
    assert one(spark, T.epoch_ms_iso(F.lit(1709633472250))) == "2024-03-05T10:11:12.250000Z"
    for day, week in (("2024-12-30", "2025-W01"), ("2021-01-03", "2020-W53"), ("2024-02-30", None), ("20240305", None)):
        assert one(spark, T.iso_week(F.lit(day))) == week
    due = [one(spark, T.review_due(F.lit(d), "2024-03-31")) for d in ("2024-03-30", "2024-03-24", "2024-03-01", "2024-01-01", "2024-03-29", "no day", "")]
    assert due == [True, True, True, True, False, False, False]


def test_rich_text_and_formats(spark):
    assert one(spark, T.rich_text(F.lit('["a ",{"type":"bold","text":"b"}]'))) == "a b" and one(spark, T.rich_text(F.lit("plain"))) == "plain"
    assert one(spark, T.canonical_format(F.lit("application/octet-stream"), True)) == "binary" and one(spark, T.canonical_format(F.lit("application/octet-stream"), False)) == "unknown"
    assert one(spark, T.e7_degrees(F.lit(0))) is None and one(spark, T.e7_degrees(F.lit(525000000))) == 52.5


def test_content_hashes_come_from_the_contents_that_need_them(spark):
    deep = "[" * 100_000 + "]" * 100_000  # too deep to be read, which counts as no JSON
    nothing = hashlib.sha256(b"{}").hexdigest()
    rows = spark.createDataFrame([(deep,), (None,), ("{} x",), ('{"b":1,"a":2}',)], "c string")
    assert [r[0] for r in rows.select(ids.content_hash(F.col("c"))).collect()] == [nothing, nothing, nothing, hashlib.sha256(b'{"a":2,"b":1}').hexdigest()]
    columns = ("parser_name", "parser_version", "source_system", "source_service", "source_app", "source_format", "source_path", "original_filename", "default_record_type")
    files = spark.createDataFrame([("f1", '{"b":1,"a":2}'), ("", '{"b":1,"a":2}'), ("", '{"a":2,"b":1}')], "file_id string, content string").select("*", *[F.lit("x").alias(c) for c in columns])
    keys = build_sources(files, "p", "now").select("source_key", "semantic_hash")
    want = hashlib.sha256(b'{"a":2,"b":1}').hexdigest()
    assert sorted(map(tuple, keys.collect())) == sorted([("p:f1:x:x", want), (f"p:{want}:x:x", want), (f"p:{want}:x:x", want)])
    plan = keys.select("source_key")._jdf.queryExecution().optimizedPlan().toString()
    assert "canonical_hash(CASE WHEN" in plan and "canonical_hash(coalesce" not in plan  # contents of named files stay

"""Snapshots, deltas, feeds, archives by ranges, the stored text index and folder trees."""

import hashlib
import io
import json
import re
import zipfile
from math import log

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import inventory, rollups, segments, textindex
from shelfmark.plans import bindings, stores
from shelfmark.sources import archives, exports, feeds, files, rules
from shelfmark.sources.snapshots import Change, Conflict, SnapshotStore
from shelfmark.streaming import inventory as stream


def _store(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/store")
    first = store.begin()
    first.put("a", spark.range(4000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")), "k", buckets=8)
    first.put("b", spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v")), "k", buckets=2)
    first.commit()
    return store


def _pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v long")


def test_readers_see_all_sections_of_one_version(spark, tmp_path):
    store = _store(spark, tmp_path)
    change = store.begin()
    change.upsert("a", _pairs(spark, ("5", 50), ("new", 1)), spark.createDataFrame([("7",)], "k string"))
    seen = store.snapshot()  # the writer has stopped between its sections
    assert seen.number == 1 and seen.read("a").count() == 4000 and seen.read("a").where("k = '5'").first()["v"] == 5
    change.upsert("b", spark.createDataFrame([(3, "y")], "k long, v string"))
    assert change.commit() == 2
    now = store.snapshot()
    assert {r["k"]: r["v"] for r in now.read("a").where("k in ('5', '7', 'new')").collect()} == {"5": 50, "new": 1} and now.read("a").count() == 4000
    assert now.read("b").where("v = 'y'").count() == 1 and seen.read("a").where("k = 'new'").isEmpty()
    assert store.snapshot(1).read("b").where("v = 'y'").isEmpty() and now.read("none", "k long").count() == 0


def test_one_of_two_writers_gets_a_conflict(spark, tmp_path):
    store = _store(spark, tmp_path)
    one, two = store.begin(), store.begin()
    one.upsert("a", _pairs(spark, ("1", 100)))
    two.upsert("a", _pairs(spark, ("1", 200), ("2", 200)))
    one.commit()
    with pytest.raises(Conflict):
        two.commit()
    again = store.begin()
    again.upsert("a", _pairs(spark, ("2", 200)))
    again.commit()
    assert {r["k"]: r["v"] for r in store.snapshot().read("a").where("k in ('1', '2')").collect()} == {"1": 100, "2": 200}
    left = {f for f, *_ in store._files("data")}
    assert store.vacuum(keep=1, min_age_seconds=3600) == 0 and {f for f, *_ in store._files("data")} == left
    assert store.vacuum(keep=1, min_age_seconds=0) > 0 and store.versions() == [3]
    assert store.snapshot().read("a").count() == 4000 and store.vacuum(keep=1, min_age_seconds=0) == 0


def test_rewriting_touches_the_buckets_of_the_keys_only(spark, tmp_path):
    store = _store(spark, tmp_path)
    before = store.snapshot().files("a")
    change = store.begin()
    touched = change.rewrite("a", _pairs(spark, ("11", 0)), spark.createDataFrame([("12",)], "k string"))
    change.commit()
    after = store.snapshot()
    assert 0 < len(touched) <= 2 and all((after.files("a")[b] == before[b]) == (b not in touched) for b in before)
    assert after.read("a").count() == 3999 and after.read("a").where("k = '11'").first()["v"] == 0
    some = after.buckets_of("a", spark.createDataFrame([("11",)], "k string"))
    plan = after.read("a", buckets=some)._jdf.queryExecution().optimizedPlan().toString()
    assert after.read("a", buckets=some).where("k = '11'").count() == 1 and after.read("a", buckets=some).count() < 1000 and "Join" not in plan


def test_deltas_are_merged_and_written_anew_by_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfmark.sources.snapshots.COMPACT_FILES", 4)
    store, want = _store(spark, tmp_path), {str(i): i for i in range(4000)}
    for k in range(9):
        change = store.begin()
        fresh, gone = [(str(i), 1000 * k + i) for i in range(k, 40, 3)], [str(100 + i) for i in range(k, 9)]
        change.upsert("a", _pairs(spark, *fresh), spark.createDataFrame([(g,) for g in gone], "k string"))
        change.commit()
        want.update(fresh)
        for g in gone:
            want.pop(g, None)
    now = store.snapshot()
    assert {r["k"]: r["v"] for r in now.read("a").collect()} == want
    assert max(len(f) for f in now.files("a").values()) <= 4
    monkeypatch.setattr("shelfmark.sources.snapshots.BROADCAST_KEYS", 0)
    assert now.read("a").count() == len(want)


def test_bytes_of_a_batch_follow_the_batch(spark, tmp_path, monkeypatch):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("text"), F.lit(70).alias("n_chars"))
    plain = lambda df: bindings.files_of(df).withColumns({c: F.lit(False) for c in ("removed", "explicitly_deleted", "trashed", "scope_exit")})
    sizes, upsert, put = [], Change.upsert, Change.put
    monkeypatch.setattr(Change, "upsert", lambda self, *a: (upsert(self, *a), sizes.append(self.written))[0])
    monkeypatch.setattr(Change, "put", lambda self, *a: (put(self, *a), sizes.append(self.written))[0])
    docs.where("doc_id >= 100").coalesce(1).write.parquet(f"{tmp_path}/in")
    docs.where("doc_id < 100").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream.stream_inventory(spark, f"{tmp_path}/in", docs.schema, f"{tmp_path}/out", f"{tmp_path}/ck", prepare=plain, buckets=4)
    first, second = max(sizes), min(sizes)
    assert len(sizes) == 2 and stream.read_known(spark, f"{tmp_path}/out").count() == 20_000 and second < first / 20


def test_a_stop_between_report_and_commit_and_one_after_it(spark, sf, tmp_path, monkeypatch):
    docs = bindings.files_of(spark.read.parquet(sf + "/documents.parquet")).where("not removed and not trashed")
    for k in range(3):
        docs.where(F.col("seq") % 3 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    go = lambda: stream.stream_inventory(spark, f"{tmp_path}/in", docs.schema, f"{tmp_path}/out", f"{tmp_path}/ck", buckets=2)
    commit, calls = Change.commit, []

    def stopped(self):
        calls.append(1)
        if len(calls) == 2:
            raise InterruptedError("before the commit")
        number = commit(self)
        if len(calls) == 4:
            raise InterruptedError("after the commit")
        return number

    monkeypatch.setattr(Change, "commit", stopped)
    for _ in range(2):
        with pytest.raises(Exception, match="the commit"):
            go()
    go()
    assert len(calls) == 4  # what was committed before the stop is not done again
    got = {r["file_id"]: (r["status"], r["duplicate_of"]) for r in stream.read_reports(spark, f"{tmp_path}/out").collect()}
    known = {r["file_id"] for r in stream.read_known(spark, f"{tmp_path}/out").collect()}
    assert len(got) == docs.count() and known == {f for f, (s, _) in got.items() if s in inventory.KEPT}


def test_untouched_days_and_weeks_keep_their_files(spark, sf, tmp_path):
    rows = bindings.event_records(spark.read.parquet(sf + "/events.parquet"))
    last = rows.agg(F.max("event_date")).first()[0]
    rows.where(F.col("event_date") < last).coalesce(1).write.parquet(f"{tmp_path}/in")
    go = lambda: stream.stream_daily(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/out", f"{tmp_path}/ck", "2024-01-31", buckets=16)
    go()
    store = SnapshotStore(spark, f"{tmp_path}/out/rollups")
    before, records = store.snapshot(), {str(p) for p in (tmp_path / "out/records").rglob("part-*")}
    rows.where(F.col("event_date") == last).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    go()
    after = store.snapshot()
    for section in (stream.DAYS, stream.WEEKS):
        kept = {f for fs in before.files(section).values() for f in fs}
        new = {f for fs in after.files(section).values() for f in fs} - kept
        assert len(new) == 1 and kept <= {f for fs in after.files(section).values() for f in fs}
    new = {str(p) for p in (tmp_path / "out/records").rglob("part-*")} - records
    assert new and all(f"__day={last}" in p for p in new)
    daily = rollups.daily_memory(rows, "2024-01-31")
    assert stream.read_daily(spark, f"{tmp_path}/out").exceptAll(daily).isEmpty() and stream.read_daily(spark, f"{tmp_path}/out").count() == daily.count()
    weekly = rollups.weekly_memory(daily)
    assert stream.read_weekly(spark, f"{tmp_path}/out").exceptAll(weekly).isEmpty() and stream.read_weekly(spark, f"{tmp_path}/out").count() == weekly.count()


def _day_records(spark):
    """Records of three days that come in mixed order, some without names, links, ids or a day."""
    e = F.col("id")
    events = spark.range(900).select(e.alias("event_id"), F.timestamp_seconds(1_704_500_000 + e * 7919 % 900 * 288).alias("ts"), (e % 50).alias("user_id"), F.concat(F.lit("kind"), e % 3).alias("event_type"), (e % 13 / 8).alias("value"))
    odd = {"record_id": F.when(e % 97 > 0, F.col("record_id")), "url": F.when(e % 5 > 0, F.col("url")), "people": F.when(e % 11 > 0, F.array(F.col("people")[0], F.when(e % 3 > 0, F.lit("B")))), "source_id": F.when(e % 7 > 0, F.col("source_id")), "event_date": F.when(e % 83 > 0, F.col("event_date")).otherwise("")}
    return bindings.event_records(events).withColumn("id", F.col("seq")).withColumns(odd).drop("id")


def test_a_day_in_the_store_does_not_grow_with_its_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "RUN", 7, raising=False)
    rows = _day_records(spark)
    for k in range(3):
        rows.where(F.col("seq") % 3 == k).write.mode("append").parquet(f"{tmp_path}/in")
        stream.stream_daily(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/out", f"{tmp_path}/ck", "2024-01-31", max_files=1000, buckets=2)
    # a batch that has written its records and then stopped
    rows.withColumns({"__day": F.col("event_date"), "__batch": F.lit(3)}).where("event_date <> ''").write.mode("append").partitionBy("__day", "__batch").parquet(f"{tmp_path}/out/records")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["date"]: r for r in stream.read_daily(spark, f"{tmp_path}/out").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    daily = rollups.daily_memory(rows, "2024-01-31")
    want = {r["date"]: r for r in daily.collect()}
    assert len(want) >= 3 and all(r["record_ids"] for r in want.values()) and got == want
    kept = SnapshotStore(spark, f"{tmp_path}/out/rollups").snapshot().read(stream.DAYS)
    assert max(len(r["record_ids"]) for r in want.values()) > 200 and kept.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 1000


def test_weeks_come_from_totals_and_names_without_the_days_lists(spark, tmp_path, monkeypatch):
    rows, plans, upsert = _day_records(spark), {}, stream._upsert
    monkeypatch.setattr(stream, "_upsert", lambda change, section, df, *a: (plans.setdefault(section, []).append(df._jdf.queryExecution().executedPlan().toString()), upsert(change, section, df, *a))[1])
    for k in range(2):
        part = rows.where(F.col("seq") % 2 == k)
        (part if k else part.unionByName(part.limit(1).withColumn("event_date", F.lit("some day")))).write.mode("append").parquet(f"{tmp_path}/in")
        stream.stream_daily(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/out", f"{tmp_path}/ck", "2024-01-31", max_files=1000, buckets=2)
    want = {r["week"]: r for r in rollups.weekly_memory(rollups.daily_memory(rows, "2024-01-31")).collect()}
    assert len(want) == 2 and all(len(r["top_people"]) == 5 and len(r["top_apps"]) == 3 for r in want.values())
    assert {r["week"]: r for r in stream.read_weekly(spark, f"{tmp_path}/out").collect()} == want
    assert len(plans[stream.WEEKS]) == 2 and not any("record_id" in p for p in plans[stream.WEEKS] + plans[stream.DAYS])


def _page(folder, phase, cursor, ids, following):
    (folder / f"{phase}-{cursor}.json").write_text(json.dumps({"rows": [{"id": i} for i in ids], "next": following}))


def test_a_feed_goes_on_from_its_cursor(spark, tmp_path):
    feeds.register(spark)
    pages = tmp_path / "pages"
    pages.mkdir()
    for args in (("listing", "0", [1, 2], "q"), ("listing", "q", [3], None), ("changes", "0", [4], "t1"), ("changes", "t1", [5, 6], "t2")):
        _page(pages, *args)
    batches, stop = [], [1]

    def one(batch, number):
        rows = [r["id"] for r in batch.orderBy("id").collect()]
        if number in stop:
            stop.remove(number)
            raise InterruptedError("stopped inside a batch")
        batches.append((number, rows))

    def go():
        rows = spark.readStream.format("change_feed").schema("id long, page int, phase string, place int").option("path", f"file://{pages}").option("pagesPerTrigger", 1).load()
        query = rows.writeStream.foreachBatch(one).option("checkpointLocation", f"{tmp_path}/ck").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="stopped inside"):
        go()
    go()
    _page(pages, "changes", "t2", [], "t3")
    _page(pages, "changes", "t3", [7], "t4")
    go()
    assert batches == [(0, [1, 2]), (1, [3]), (2, [4]), (3, [5, 6]), (4, []), (5, [7])]
    offsets = {p.name: json.loads(p.read_text().splitlines()[-1]) for p in (tmp_path / "ck/offsets").iterdir() if not p.name.startswith(".")}
    assert offsets["1"] == {"phase": "changes", "cursor": "0", "pages": 2} and offsets["5"]["cursor"] == "t4"


def test_a_large_archive_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    body = lambda k: (f"member {k} " * 20).encode()
    with zipfile.ZipFile(tmp_path / "in/deep/big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("dir/", "")
        z.writestr("dir/skip.exe", "x")
        z.writestr("../up/messages.json", '{"a": 1}')
        for k in range(20_000):
            z.writestr(f"dir/m{k}.txt", body(k))
        z.writestr("long.txt", "x" * 5000)
    data = bytearray((tmp_path / "in/deep/big.zip").read_bytes())
    with zipfile.ZipFile(tmp_path / "in/deep/big.zip") as z:
        at = z.getinfo("dir/m77.txt").header_offset
    data[at + 42 : at + 50] = bytes(8)
    (tmp_path / "in/deep/big.zip").write_bytes(data)
    with zipfile.ZipFile(tmp_path / "in/small.zip", "w") as z:
        z.writestr("a.txt", "small")
    (tmp_path / "in/none.zip").write_bytes(b"no archive")
    (tmp_path / "in/empty.zip").write_bytes(b"")
    (tmp_path / "in/other.txt").write_text("no archive either")
    archives.register(spark)
    rows = spark.read.format("zip_members").option("splitBytes", 200_000).option("memberLimit", 4000).load(f"file://{tmp_path}/in")
    assert rows.rdd.getNumPartitions() >= 15
    got = {(r["bundle_id"].rpartition("/")[2], r["source_path"]): r for r in rows.collect()}
    assert len(got) == 20_000 + 1 + 1 + 2 and got["small.zip", "a.txt"]["content"] == b"small"
    assert got["none.zip", ""]["problem"] and got["empty.zip", ""]["problem"] and got["big.zip", "dir/m77.txt"]["problem"] and got["big.zip", "dir/m77.txt"]["content"] is None
    one = got["big.zip", "dir/m19999.txt"]
    assert one["content"] == body(19_999) and one["checksum_sha256"] == hashlib.sha256(body(19_999)).hexdigest() and one["original_filename"] == "m19999.txt"
    assert sum(r["problem"] is not None for r in got.values()) == 3
    told = {r["bundle_id"].rpartition("/")[2]: r for r in spark.read.format("zip_archives").load(f"file://{tmp_path}/in").collect()}
    big = told["big.zip"]
    assert big["n_members"] == 20_004 and big["archive_files"][:4] == ["dir", "dir/skip.exe", "up/messages.json", "dir/m0.txt"] and len(big["archive_files"]) == 100
    assert big["telling_member"] == "../up/messages.json" and big["raw_text"] == '{"a": 1}' and told["small.zip"]["telling_member"] is None and told["none.zip"]["problem"]
    # the same archive as a row
    whole = files.expand_archives(spark.createDataFrame([("z", None, bytes(data), "ORIGINAL"), ("n", None, None, None)], "file_id string, checksum_sha256 string, content binary, status string"), 4000)
    assert whole.count() == 20_002 and whole.where("problem is not null").count() == 2 and whole.where("status = 'ORIGINAL'").count() == 20_001


def test_a_task_reads_its_part_of_an_archive_directory(spark, tmp_path, monkeypatch):
    raw = io.BytesIO(b"something before")
    with zipfile.ZipFile(raw, "a", zipfile.ZIP_DEFLATED) as z:
        for k in range(500):
            z.writestr(f"d/\u00e4 {k}.txt" if k % 3 else f"d/{k}.txt", f"text {k} " * 50)
        z.writestr("skip.exe", "x")
    (tmp_path / "a.zip").write_bytes(raw.getvalue())
    reader = archives._Reader({"path": f"file://{tmp_path}", "splitBytes": "10000"}, summary=False)
    parts, known = reader.partitions(), []
    monkeypatch.setattr(archives, "member_rows", lambda archive, *a, own=archives.member_rows: (known.append(len(archive.infolist())), own(archive, *a))[1])
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert len(parts) > 10 and sum(known) == 501 and len(rows) == 500 and not any(r["problem"] for r in rows)
    assert {r["source_path"]: r["content"] for r in rows} == {(f"d/\u00e4 {k}.txt" if k % 3 else f"d/{k}.txt"): (f"text {k} " * 50).encode() for k in range(500)}


def test_members_are_deflated_before_they_come_to_their_archive(spark, sf, tmp_path, monkeypatch):
    frame, plans = type(spark.range(0)), []
    repartition = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: (plans.append(self._jdf.queryExecution().executedPlan().toString()), repartition(self, *a))[1])
    stores._write_archives(spark, sf, f"file://{tmp_path}/z")
    assert "MapInArrow" in plans[0]
    want = {f"in/../p/{r['page_id']:09d}.html": (r["html"] or "").encode() for r in spark.read.parquet(sf + "/pages.parquet").collect()}
    got = {}
    for k in range(5):
        with zipfile.ZipFile(tmp_path / f"z/a{k}.zip") as z:
            assert z.testzip() is None and z.namelist()[:2] == ["in/", "in/skip.exe"] and z.namelist()[2:] == sorted(z.namelist()[2:])
            got |= {n: z.read(n) for n in z.namelist()[2:]}
    assert got == want


def test_flags_and_own_values_of_contents(spark):
    rows = spark.createDataFrame([("a/Takeout/x.txt", b""), ("My Exports/x.7z", b""), ("x.zip", b""), ("x.tar", b""), ("x.txt", b"")], "path string, content binary")
    got = {r["source_path"]: (r["is_archive"], r["is_bundle"], r["is_export"]) for r in files.ingest_exports(rows).collect()}
    assert got == {"a/Takeout/x.txt": (False, True, True), "My Exports/x.7z": (False, True, True), "x.zip": (True, True, True), "x.tar": (True, True, True), "x.txt": (False, False, False)}
    schema = f"name string, notes string, run_utc string, folder_rule string, starred boolean, web_link string, mime_type string, ocr struct<date:string,summary:string,doc_type:string,people:array<string>,organizations:array<string>>, content struct<{', '.join(f'{a}:{b}' for a, b in (c.split() for c in files.CONTENT_DEFAULTS.split(', ')))}>"
    ocr = ("2024-02-03T1", "seen", " letter ", ["A", "B", "A"], ["Org"])
    own = ("", None, "2020", "2019-01-01", ["app"], [], ["C", "A"], 0.9, "own")
    none = (None,) * 9
    df = spark.createDataFrame([("n", "note", "2024-01-01T0", "rule", True, "link", "text/plain", ocr, own), ("n", "note", "2024-01-01T0", "rule", True, "link", "text/plain", None, none), ("n", None, None, None, False, None, None, ocr, None)], schema)
    shown = [tuple(r[c] for c in ("title", "summary", "event_time_start", "event_date", "people", "apps", "topics", "importance_score", "url")) for r in files.enrich_sources(df).collect()]
    assert shown[0] == ("", "seen", "2020", "2019-01-01", ["C", "A", "B"], ["app", "Org"], [], 1.0, "own")
    assert shown[1] == ("n", "note", "2024-01-01T0", "2024-01-01", [], ["rule"], [], 0.75, "link")
    assert shown[2] == ("n", "seen", "2024-02-03T1", "2024-02-03", ["A", "B"], ["Org"], ["letter"], 0.5, "")


def test_text_index_against_a_scan(spark, tmp_path):
    index = textindex.TextIndex(spark, f"file://{tmp_path}/index", buckets=4)
    texts = {f"r{k}": " ".join(["Alpha", "beta"] * (k % 4) + ["the", "of", "the"] * (k % 3) + [f"w{k}"]) for k in range(300)} | {"none": None, "long": "the " * 30_000 + "alpha"}
    view = lambda t: spark.createDataFrame([*t.items(), (None, "the of")], "record_id string, searchable_text string")
    assert index.search(["the"]).isEmpty() and index.phrase("the").isEmpty()
    index.add(view({k: v for k, v in texts.items() if k != "r5"}))
    changed = {"r5": "of the alpha", "r7": "now the of alpha the of", "none": "alpha the"}
    assert index.add(view(changed)) == 1
    texts |= changed
    held = {k: re.findall("[a-z0-9]+", (v or "").lower()) for k, v in texts.items()}
    n, mean = len(held), sum(map(len, held.values())) / len(held)

    def score(w, terms):
        s = 0.0
        for t in terms:
            df, tf = sum(t in x for x in held.values()), w.count(t)
            s += log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        return s

    for terms in (["the"], ["THE", "alpha"], ["w7"], ["w8", "alpha"], ["missing", "the"], []):
        low = [t.lower() for t in terms]
        want = {k: score(w, low) for k, w in held.items() if low and all(t in w for t in low)}
        got = {r["record_id"]: r["score"] for r in index.search(terms).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in want)
    for phrase in ("the of", "of the alpha", "Alpha beta, alpha", "the the", "beta", "no such"):
        words = phrase.lower().replace(",", "").split()
        want = {k: c for k, w in held.items() if (c := sum(w[i : i + len(words)] == words for i in range(len(w))))}
        assert {r["record_id"]: r["n"] for r in index.phrase(phrase).collect()} == want
    best = textindex.best(index.search(["the"]), 3).collect()
    assert [r["rank"] for r in best] == [1, 2, 3] and best[0]["score"] >= best[1]["score"]


def test_a_lookup_reads_the_buckets_of_its_terms(spark, tmp_path):
    index = textindex.TextIndex(spark, f"file://{tmp_path}/index", buckets=16)
    index.add(spark.range(2000).select(F.concat(F.lit("r"), "id").alias("record_id"), F.concat(F.lit("common word"), F.col("id")).alias("searchable_text")))
    plan = index.postings(["word7"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (IN|=)", plan) and re.search(r"PushedFilters: \[[^\]]*term", plan)
    some = next((tmp_path / "index/segments/s=0/kind=postings").rglob("part-*.parquet"))
    group = pq.ParquetFile(some).metadata.row_group(0)
    coded = {group.column(i).path_in_schema.split(".")[0]: group.column(i).encodings for i in range(group.num_columns)}
    assert any("DELTA" in e for e in coded["at"]) and any("DELTA" in e for e in coded["places"]) and any("DELTA" in e for e in coded["term"])


def test_a_bucket_has_more_files_as_records_grow_and_each_word_moves_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "FILE_RECORDS", 1000, raising=False)
    moved, frame = [], type(spark.range(0))
    repartition = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: (moved.append(self._jdf.queryExecution().executedPlan().toString().count("Exchange")), repartition(self, *a))[1])
    index = textindex.TextIndex(spark, f"file://{tmp_path}/index", buckets=1)
    texts = spark.range(8000).repartition(4).select(F.concat(F.lit("r"), "id").alias("record_id"), F.concat(F.lit(" -Common, W"), F.col("id") % 50, F.lit(" common ")).alias("searchable_text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    moved.clear()
    try:
        index.add(texts.unionByName(spark.createDataFrame([("none", None), ("blank", " - ")], "record_id string, searchable_text string")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "index/segments/s=0/kind=postings").rglob("part-*.parquet"))) > 1
    assert moved == [0]  # no exchange between the texts as they are numbered and the lists' way to their buckets
    lists = spark.read.parquet(f"file://{tmp_path}/index/segments/s=0/kind=postings")
    assert lists.where("term = 'common'").agg(F.sum("n_records")).first()[0] == 8000
    assert {tuple(r[0]) for r in index.postings(["common"]).select("places").distinct().collect()} == {(0, 2)} and index.postings(["w7"]).count() == 160
    assert {r["record_id"]: r["length"] for r in index._records(1).collect()} == {f"r{k}": 3 for k in range(8000)} | {"none": 0, "blank": 0}
    # cuts of a few bytes say the same
    monkeypatch.setattr(textindex, "CUT_BYTES", 9)
    batch = pa.RecordBatch.from_pydict({"number": [4094, 4095, 4096, 4097, 4098], "record_id": list("abcde"), "t": [" a b a", "b", " ", "", "a b b "]}, pa.schema([("number", pa.int64()), ("record_id", pa.string()), ("t", pa.string())]))
    rows = [r for b in textindex._invert(iter([batch])) for r in b.to_pylist()]
    assert [(r["number"], r["record_id"], r["length"]) for r in rows if r["record_id"]] == [(4094, "a", 3), (4095, "b", 1), (4096, "c", 0), (4097, "d", 0), (4098, "e", 3)]
    assert [(r["term"], r["block"], r["at"], r["ends"], r["places"]) for r in rows if r["term"]] == [("a", 0, [4094], [2], [0, 2]), ("b", 0, [4094, 4095], [1, 2], [1, 0]), ("a", 1, [2], [1], [0]), ("b", 1, [2], [2], [1, 2])]


def test_a_chain_of_5000_folders_in_few_rounds(spark, monkeypatch):
    edges = spark.range(1, 5001).select(F.concat(F.lit("f"), "id").alias("folder_id"), F.concat(F.lit("f"), F.col("id") - 1).alias("parent_id"), F.concat(F.lit("n"), "id").alias("name"))
    rounds, checkpoint = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a: (rounds.append(1), checkpoint(self, *a))[1])
    assert inventory.in_scope(edges, "f0").count() == 5001 and len(rounds) <= 14 + 2
    assert inventory.in_scope(edges, "f2500").count() == 2501
    paths = {r["folder_id"]: (r["root_id"], r["path"]) for r in inventory.folder_paths(edges).where("folder_id in ('f1', 'f3', 'f5000')").collect()}
    assert paths["f1"] == ("f1", "n1") and paths["f3"] == ("f1", "n1/n2/n3") and paths["f5000"][1].count("/") == 4999


def test_scope_of_graphs_against_a_search(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("a", "d"), ("e", "a"), ("m", "x"), ("m", "e"), ("n", "m"), ("o", "n"), ("o", "y"), ("p", "p"), ("q", "p"), ("r", None), ("s", "o"), ("s", "q"), ("x", "y"), ("n", "m")]
    df = spark.createDataFrame(edges, "folder_id string, parent_id string")
    for target in "abmnoypqxz":
        want, grew = {target}, True
        while grew:
            grew = False
            for f, p in edges:
                if p in want and f not in want:
                    want.add(f)
                    grew = True
        got = [r[0] for r in inventory.in_scope(df, target).collect()]
        assert sorted(got) == sorted(want), target
    named = df.withColumn("name", F.upper("folder_id"))
    paths = {r["folder_id"]: (r["root_id"], r["path"]) for r in inventory.folder_paths(named).collect()}
    assert paths["r"] == ("r", "R") and paths["x"] == ("x", "X") and paths["p"] == (None, None) == paths["q"] == paths["a"] == paths["m"]


def test_segments_of_a_hot_list(spark, monkeypatch):
    rows = spark.range(30_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 30_000).alias("o"), F.concat(F.lit("v"), F.col("id") * 7919 % 30_000).alias("v")).repartition(5)
    rows = rows.unionByName(spark.createDataFrame([("b", 2, "y"), ("b", 1, "x"), (None, 1, "n"), ("c", None, None)], "k string, o long, v string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = segments.list_segments(rows, ["k"], ["o"], "v", size=1000).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = sorted((r for r in got if r["k"] == "hot"), key=lambda r: r["segment"])
    assert [r["segment"] for r in hot] == list(range(30)) and all(r["first"] == 1000 * r["segment"] for r in hot)
    assert [v for r in hot for v in r["values"]] == [f"v{k}" for k in range(30_000)]
    assert sorted([(r["k"], r["segment"], r["values"]) for r in got if r["k"] != "hot"], key=repr) == sorted([("b", 0, ["x", "y"]), (None, 0, ["n"]), ("c", 0, [None])], key=repr)
    assert segments.list_segments(rows.limit(0), ["k"], ["o"], "v").count() == 0


def test_segments_say_what_the_daily_lists_say(spark, sf):
    rows = bindings.event_records(spark.read.parquet(sf + "/events.parquet"))
    daily = rollups.daily_memory(rows, "2024-01-31")
    want = {(r["date"], name): r[name] for r in daily.collect() for name in ("people", "places", "apps", *rollups.FAMILIES, "llm_activity", "media_refs", "source_ids", "record_ids") if r[name]}
    got = {}
    for r in sorted(segments.daily_segments(rows, size=7).collect(), key=lambda r: r["segment"]):
        assert len(r["values"]) <= 7
        got.setdefault((r["date"], r["list"]), []).extend(r["values"])
    assert got == want


def test_days_come_out_once_and_state_goes(spark, tmp_path):
    schema = "event_id long, ts timestamp, event_type string, value decimal(18,6)"
    batches = [[(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00"), (1, "2024-01-01 10:00:00")], [(3, "2024-01-04 01:00:00"), (2, "2024-01-01 11:00:00")], [(4, "2024-01-01 12:00:00"), (5, "2024-01-05 00:00:00")], [(6, "2024-01-01 12:00:00"), (7, "2024-01-09 00:00:00")]]
    for rows in batches:
        df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "event_id long, ts string, event_type string, value int")
        df.select("event_id", F.to_timestamp("ts").alias("ts"), "event_type", F.col("value").cast("decimal(18,6)").alias("value")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    counts = stream.stream_expiring_counts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))
    query = counts.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r["window"]["start"].day, r["n"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, 3), (4, 1), (5, 1)]  # event 4 met the mark of the batch before, event 6 was too late
    assert stream.late_rows(query) == 1
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 1


def test_a_job_without_logic_gives_the_default_record(spark):
    sources = spark.createDataFrame([("a", "in/facebook-a.json", "facebook-a.json", '{"title": "T", "people": ["P"], "event_time_start": "2024-02-03T10:00:00Z"}', "raw"), ("b", "in/facebook-b.json", "facebook-b.json", None, "only text")], "file_id string, source_path string, original_filename string, content string, raw_text string").withColumn("text_preview", F.lit(""))
    built = exports.build_sources(rules.resolve_parser(sources), "p", "2024")
    got = {r["file_id"]: r for r in exports.parse_sources(built, "2024", ["facebook_export"]).collect()}
    assert (got["a"]["record_type"], got["a"]["title"], got["a"]["event_date"], got["a"]["people"]) == ("social_event", "T", "2024-02-03", ["P"])
    assert (got["b"]["title"], got["b"]["raw_text"], got["b"]["normalized_text"]) == ("facebook-b.json", "only text", "only text")
    assert {r["file_id"] for r in exports.parse_sources(built, "2024").collect()} == {"a", "b"}


def test_an_inventory_of_a_feed(spark, tmp_path):
    feeds.register(spark)
    pages = tmp_path / "pages"
    pages.mkdir()

    def page(phase, cursor, ids, following):
        (pages / f"{phase}-{cursor}.json").write_text(json.dumps({"rows": [{"doc_id": i, "text": f"text {i % 4}", "n_chars": 6} for i in ids], "next": following}))

    plain = lambda df: bindings.files_of(df).withColumns({c: F.lit(False) for c in ("removed", "explicitly_deleted", "trashed", "scope_exit")})

    def go():
        rows = spark.readStream.format("change_feed").schema("doc_id long, text string, n_chars long").option("path", f"file://{pages}").option("pagesPerTrigger", 1).load()
        stream.run_inventory(rows, f"{tmp_path}/out", f"{tmp_path}/ck", prepare=plain, buckets=2, available_now=False)

    page("listing", "0", [1, 2], "1")
    page("listing", "1", [3, 5], None)
    go()
    page("changes", "0", [4, 6], "1")
    go()
    got = {r["file_id"]: (r["batch"], r["status"], r["duplicate_of"]) for r in stream.read_reports(spark, f"{tmp_path}/out").collect()}
    assert got == {"f1": (0, "ORIGINAL", ""), "f2": (0, "ORIGINAL", ""), "f3": (1, "ORIGINAL", ""), "f5": (1, "DUPLICATE", "f1"), "f4": (2, "ORIGINAL", ""), "f6": (2, "DUPLICATE", "f2")}
    assert {r["file_id"] for r in stream.read_known(spark, f"{tmp_path}/out").collect()} == {"f1", "f2", "f3", "f4"}


def test_steps_of_a_stream_are_written_by_many_tasks(spark, sf, tmp_path):
    from shelfmark.plans import feeds, stores

    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    for name, steps, rows in (("grow", feeds._grow(docs, f"{tmp_path}/grow", "doc_id"), lambda k: docs.where(F.col("doc_id") % 4 == k)), ("steps", stores._steps(docs, f"{tmp_path}/steps"), lambda k: docs.where(F.col("doc_id") % 4 == k % 4).where(f"{k} < 4 or doc_id % 3 = 0"))):
        seen = set()
        for k, folder in enumerate(steps):
            new = {str(f) for f in (tmp_path / name / "changes").glob("part-*")} - seen
            seen |= new
            assert folder == f"{tmp_path}/{name}/changes" and len(new) == 3  # one for each task that has rows
            assert sorted(r[0] for r in spark.read.parquet(*new).select("doc_id").collect()) == sorted(r[0] for r in rows(k).select("doc_id").collect())
        assert k == (3 if name == "grow" else 7)


def test_a_long_feed_takes_few_batches_and_is_followed_by_the_ends_of_its_pages(tmp_path, monkeypatch):
    for k in range(200):
        (tmp_path / f"listing-{k}.json").write_text(json.dumps({"rows": [{"x": '"next": "9"}'}], "next": str(k + 1) if k < 199 else None}))
    (tmp_path / "changes-0.json").write_text(json.dumps({"next": "a\"}b", "rows": [{"next": "7"}]}))
    pages = feeds.PagesInFolder(str(tmp_path))
    assert pages.following("changes", "0") == (True, 'a"}b') and pages.following("listing", "199") == (True, None) and pages.following("listing", "200") == (False, None)
    monkeypatch.setattr(feeds.PagesInFolder, "_page", lambda self, *a: 1 / 0 if a[0] == "listing" else {"next": None, "rows": []})
    counts = []
    for growth in ("0", "0.5"):
        reader = feeds._Reader({"path": str(tmp_path), "pagesPerTrigger": "2", "growth": growth}, type("S", (), {"fieldNames": lambda self: ["x"]})())
        start, seen, batches = reader.initialOffset(), [], 0
        while (end := reader.latestOffset()) != start:
            seen += [p.cursor for p in reader.partitions(start, end) if p.phase == "listing"]
            start, batches = end, batches + 1
        assert seen == [str(k) for k in range(200)]
        counts.append(batches)
    assert counts[0] >= 100 and counts[1] <= 12

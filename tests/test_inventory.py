import pytest
from pyspark.sql import functions as F

from shelfmark.operators import inventory, lifecycle, sorting
from shelfmark.plans import bindings
from shelfmark.streaming import inventory as stream

FILE = "seq long, file_id string, name string, mime_type string, size long, md5 string, parents array<string>, modified_time string, created_time string, removed boolean, explicitly_deleted boolean, trashed boolean, scope_exit boolean, sha256 string"
KNOWN = "seq long, file_id string, name string, parent_ids_sorted string, md5 string, size long, modified_time string, sha256 string"


def files(spark, **changes):
    base = dict(seq=1, file_id="f", name="n", mime_type="text/plain", size=10, md5="m", parents=["b", "a"], modified_time="t", created_time="2024-03-05T1", removed=False, explicitly_deleted=False, trashed=False, scope_exit=False, sha256=None)
    return spark.createDataFrame([tuple((base | changes).values())], FILE)


def known(spark, **changes):
    base = dict(seq=1, file_id="f", name="n", parent_ids_sorted="a,b", md5="m", size=10, modified_time="t", sha256="s")
    return spark.createDataFrame([tuple((base | changes).values())], KNOWN)


def test_order_of_change_types(spark):
    def kind(file, row=None):
        return inventory.classify_changes(files(spark, **file), known(spark, **(row or {}))).first()["change_type"]

    assert kind({}) == "UNCHANGED_CONTENT_METADATA_ONLY" and kind({"file_id": "new"}) == "NEW"
    assert kind({"removed": True, "explicitly_deleted": True, "trashed": True}) == "DELETED" and kind({"trashed": True, "removed": True}) == "TRASHED"
    assert kind({"removed": True, "scope_exit": True}) == "MOVED_OUT_OF_SCOPE" and kind({"removed": True}) == "REMOVED_OR_NO_ACCESS"
    assert kind({"parents": ["c"], "name": "x"}) == "MOVED" and kind({"name": "x", "md5": "y"}) == "RENAMED" and kind({"name": "x"}, {"name": ""}) == "UNCHANGED_CONTENT_METADATA_ONLY"
    assert kind({"md5": "y"}) == "UPDATED" and kind({"md5": None}) == "UNCHANGED_CONTENT_METADATA_ONLY" and kind({"size": 11, "md5": None}) == "UPDATED" and kind({"modified_time": "u"}) == "UPDATED"
    assert inventory.classify_changes(files(spark), known(spark), is_initial=True).first()["change_type"] == "NEW"
    twice = files(spark, md5="y").unionByName(files(spark, seq=2))
    assert [r["change_type"] for r in inventory.classify_changes(twice, known(spark)).collect()] == ["UNCHANGED_CONTENT_METADATA_ONLY"]


def test_size_guard_and_unchanged_content(spark):
    limit = 1024 * 1024
    route = lambda **c: inventory.route_for_hashing(inventory.classify_changes(files(spark, **c), known(spark)), 1).first()
    assert route(file_id="g", size=limit)["status"] is None and route(file_id="g", size=limit + 1)["sha256"] == "HASH_SKIPPED_SIZE"
    assert route(parents=["z"])["status"] == "UNCHANGED_CONTENT" and route(parents=["z"])["sha256"] == "s"
    assert route(parents=["z"], mime_type="application/vnd.google-apps.document")["status"] is None


@pytest.mark.parametrize("hot", [1_000_000, 1])
def test_three_files_of_one_hash_one_known(spark, monkeypatch, hot):
    monkeypatch.setattr(inventory, "HOT_COPIES", hot)
    rows = files(spark, file_id="a", seq=5, sha256="h").unionByName(files(spark, file_id="b", seq=3, sha256="h")).unionByName(files(spark, file_id="c", seq=4, sha256="")).unionByName(files(spark, file_id="k", seq=9, sha256="h"))
    got = {r["file_id"]: (r["status"], r["duplicate_of"]) for r in inventory.dedupe_by_hash(rows, known(spark, file_id="k", seq=9, sha256="h")).collect()}
    assert got == {"a": ("DUPLICATE", "k"), "b": ("DUPLICATE", "k"), "c": ("HASH_ERROR", ""), "k": ("ORIGINAL_RESUMED", "")}
    got = {r["file_id"]: r["status"] for r in inventory.dedupe_by_hash(rows, known(spark, file_id="k", seq=1, sha256="old")).collect()}
    assert got["b"] == "ORIGINAL" and got["a"] == got["k"] == "DUPLICATE"
    alone = {r["file_id"]: r["status"] for r in inventory.dedupe_by_hash(rows.orderBy(F.desc("seq"))).collect()}
    assert alone["b"] == "ORIGINAL"
    old = spark.createDataFrame([("h", "first", ["x"], 1)], "sha256 string, original_file_id string, duplicate_file_ids array<string>, count long")
    group = inventory.duplicate_groups(inventory.dedupe_by_hash(rows), old).first()
    assert group["original_file_id"] == "first" and group["duplicate_file_ids"] == ["a", "k", "x"] and group["count"] == 3


def test_folder_cycles_and_paths(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("z", "y")], "folder_id string, parent_id string")
    assert sorted(r[0] for r in inventory.in_scope(edges, "a").collect()) == ["a", "b", "c"]
    rows = files(spark, parents=["c", "q"]).unionByName(files(spark, file_id="g", parents=[])).unionByName(files(spark, file_id="h", parents=["z"]))
    assert {r["file_id"]: r["in_scope"] for r in inventory.flag_scope(rows, edges, "a").collect()} == {"f": True, "g": False, "h": False}
    assert all(r["in_scope"] for r in inventory.flag_scope(rows, edges, "").collect())
    registry = spark.createDataFrame([("z", "/z")], "folder_id string, full_path string")
    assert {r["file_id"]: r["path"] for r in inventory.display_paths(rows, registry).collect()} == {"f": "c/n", "g": "n", "h": "/z/n"}


def test_change_feed(spark):
    schema = "removed boolean, file struct<id:string,trashed:boolean>, inside boolean"
    rows = spark.createDataFrame([(True, None, False), (False, ("a", False), True), (False, ("b", False), False), (False, ("c", True), False), (False, ("d", True), True)], schema)
    got = [(r["file"]["id"] if r["file"] else None, r["removed"], r["explicitly_deleted"], r["scope_exit"], r["trashed"]) for r in inventory.normalize_changes(rows, F.col("inside")).collect()]
    assert got == [(None, True, True, False, False), ("a", False, False, False, False), ("b", True, False, True, False), ("d", False, False, False, True)]


def test_batches_in_order_equal_one_batch(spark, sf, tmp_path):
    docs = bindings.files_of(spark.read.parquet(sf + "/documents.parquet")).where("not removed and not trashed")
    for k, (a, b) in enumerate(((0, 60), (60, 140), (140, 10**9))):
        docs.where(F.col("seq").between(a, b - 1)).coalesce(1).write.parquet(f"{tmp_path}/in/b={k}")
    path = f"{tmp_path}/in"
    stream.stream_inventory(spark, path + "/*", docs.schema, str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1)
    got = {r["file_id"]: (r["status"], r["duplicate_of"]) for r in stream.read_reports(spark, str(tmp_path / "out")).collect()}
    none = spark.createDataFrame([], stream.KNOWN_SCHEMA)
    want = {r["file_id"]: (r["status"], r["duplicate_of"]) for r in stream.process_batch(docs, none).collect()}
    assert got == want
    stream.stream_inventory(spark, path + "/*", docs.schema, str(tmp_path / "out"), str(tmp_path / "ck"), max_files=1)
    assert stream.read_reports(spark, str(tmp_path / "out")).count() == len(want)


def test_all_rules_in_order(spark):
    rows = [
        ("INBOX_TRASH", "DUPLICATE", "a.png", "image/png", "", "", "01_inbox_trash"), ("", "DUPLICATE_OF:x|ARCHIVED", "a.png", "image/png", "", "", "99_archive"), ("", "ERROR", "a", "", "", "", "99_quarantine"), ("", "", "a.png", "image/png", "", "Rechnung", "40b_referenzen"),
        ("", "", "a", "IMAGE/png", "", "", "50a_fotos"), ("", "", "a", "video/x", "", "", "50b_videos"), ("", "", "a", "audio/x", "", "", "50c_audio"), ("", "", "A.PY", "", "", "", "30_scripts"), ("", "", "a.md", "", "/My Code/", "", "30_scripts"), ("", "", "a", "application/pdf", "", "", "40b_referenzen"),
        ("", "", "Moon plan", "", "", "", "40c_projekte"), ("", "", "my decision", "", "", "", "10_decisions"), ("", "", "a.deb", "", "", "", "60_software"), ("", "", "a.md", "", "", "", "00_inbox"), (None, None, None, None, None, None, "00_inbox"),
    ]
    df = spark.createDataFrame(rows, "lane string, status string, name string, mime_type string, path string, topic_hint string, want string")
    got = sorting.assign_folder_rule(df, sorting.default_rules(("moon",))).collect()
    assert [r["folder_rule"] for r in got] == [r["want"] for r in got]


def test_purge_and_exclusions(spark):
    sources = spark.createDataFrame([("s1", "f1", "", "", ""), ("s2", "f2", "f1", "", ""), ("s3", "f3", "", "DELETED", ""), ("s4", "f4", "f3", "", "DELETED"), ("s5", "f5", "f3", "DELETED", "")], "source_id string, file_id string, bundle_id string, change_type string, bundle_change_type string")
    rules = spark.createDataFrame([("f1", "PURGED"), ("f5", "ACTIVE")], "file_id string, status string")
    got = {r["file_id"]: r["knowledge_status"] for r in lifecycle.apply_exclusions(sources, rules).collect()}
    assert got == {"f1": "PURGED", "f2": "PURGED", "f3": "EXCLUDED", "f4": "EXCLUDED", "f5": "ACTIVE"}
    records = sources.select(F.concat(F.lit("r"), "source_id").alias("record_id"), "source_id", "file_id")
    many = lambda key: spark.createDataFrame([("all", ["s1", "s2"]), ("some", ["s1", "s3"]), ("none", [])], f"{key} string, source_ids array<string>")
    indices = {"sources": sources, "records": records, "entities": many("entity_id"), "relations": many("relation_id")}
    out = lifecycle.purge(indices, rules)
    assert sorted(r["source_id"] for r in out["sources"].collect()) == ["s3", "s4", "s5"] and out["records"].count() == 3
    assert sorted(r["entity_id"] for r in out["entities"].collect()) == ["none", "some"] == sorted(r["relation_id"] for r in out["relations"].collect())
    assert sorted(r["entity_id"] for r in lifecycle.purge(indices, rules, cascade_bundles=False)["entities"].collect()) == ["all", "none", "some"]

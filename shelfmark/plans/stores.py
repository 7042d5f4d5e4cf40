"""Queries of what is kept and read in parts: snapshots of all sections, deltas, feeds, archives, stored indices, folder trees."""

from __future__ import annotations

import json
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.session import shared_dir
from shelfmark.operators import graph, inventory, rollups, segments, textindex, views
from shelfmark.plans.bindings import AS_OF, FILES, event_records, files_of, read
from shelfmark.plans.catalog import _DAILY, _DEDUPED, _MENTIONS, _RECORDS, _RELATIONS, SQL, _deduped, query
from shelfmark.plans.feeds import ALL_FILES, _grow
from shelfmark.sources import archives, feeds
from shelfmark.sources.snapshots import SnapshotStore
from shelfmark.streaming import inventory as stream


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- all sections under one version


def _sections(records: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """The index's sections and their keys."""
    child = graph.entity_sources(records)
    return {
        "sources": (records.groupBy("source_id").agg(F.count("*").alias("n"), F.max("event_date").alias("last")), "source_id"),
        "records": (records.select("record_id", "source_id", "event_date", "title"), "record_id"),
        "entities": (graph.merge_entities(child).select("entity_id", "canonical_name", F.col("mentions").cast("long").alias("mentions")), "entity_id"),
        "relations": (graph.source_relations(records).select(F.concat("source_id", F.lit("/"), "relation_id").alias("key"), "predicate"), "key"),
        "days": (rollups.daily_memory(records, AS_OF).select("date", F.size("record_ids").cast("long").alias("n")), "date"),
        "views": (views.base_view(records).select("search_id", "primary_date"), "search_id"),
    }


@query(f"""WITH {_DAILY}, {_MENTIONS.split(', mentions AS', 1)[1].join(['mentions AS', ''])}, {_RELATIONS.split(', edges AS', 1)[1].join(['edges AS', ''])}, kept AS (SELECT * FROM records WHERE source_id NOT LIKE '%7')
  SELECT 'sources' AS section, source_id AS key, CAST(count(*) AS VARCHAR) AS told FROM kept GROUP BY source_id
  UNION ALL SELECT 'records', record_id, CASE WHEN source_id LIKE '%3' THEN 'new ' || title ELSE title END FROM kept
  UNION ALL SELECT 'entities', entity_id, CAST(sum(mentions) AS VARCHAR) FROM child GROUP BY entity_id
  UNION ALL SELECT 'relations', source_id || '/' || relation_id, predicate FROM rel
  UNION ALL SELECT 'days', event_date, CAST(count(*) AS VARCHAR) FROM records GROUP BY event_date
  UNION ALL SELECT 'views', 'search::' || record_id, event_date FROM kept""")
def snapshot_sections(spark, sf_dir):
    """Six sections of one version; then some sources go and others change in one more, by deltas and by buckets written anew; a third that loses the race is not there."""
    store = SnapshotStore(spark, _folder(spark, "snapshots"))
    records = event_records(read(spark, sf_dir, "events"))
    first = store.begin()
    for name, (rows, key) in _sections(records).items():
        first.put(name, rows, key, buckets=8)
    first.commit()
    second, late = store.begin(), store.begin()
    gone, changed = records.where("source_id like '%7'"), records.where("source_id like '%3'")
    second.upsert("records", changed.select("record_id", "source_id", "event_date", F.concat(F.lit("new "), "title").alias("title")), gone.select("record_id"))
    second.rewrite("sources", gone=gone.select("source_id").distinct())
    second.rewrite("views", gone=gone.select(F.concat(F.lit("search::"), "record_id").alias("search_id")))
    second.commit()
    late.put("records", records.select("record_id").limit(0), "record_id", buckets=1)
    try:
        late.commit()
        raise AssertionError("two writers committed one version")
    except RuntimeError:
        store.vacuum(keep=1, min_age_seconds=0)
    now = store.snapshot()
    shown = {"sources": "n", "records": "title", "entities": "mentions", "relations": "predicate", "days": "n", "views": "primary_date"}
    parts = [now.read(s).select(F.lit(s).alias("section"), F.col(now.state["sections"][s]["key"]).alias("key"), F.col(c).cast("string").alias("told")) for s, c in shown.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- the stream's known files


def _steps(docs: DataFrame, root: str) -> Iterator[str]:
    """A folder of changes that grows in eight steps: all documents in four, then a third of them once more, some of these removed and the others renamed."""
    d = F.col("doc_id")
    for k in range(8):
        part = docs.where(F.pmod(d, F.lit(4)) == k % 4)
        part = part if k < 4 else part.where(d % 3 == 0)
        part.withColumn("again", F.lit(k >= 4)).write.mode("append").parquet(f"{root}/changes")
        yield f"{root}/changes"


def _as_files(rows: DataFrame) -> DataFrame:
    gone = F.col("again") & (F.col("seq") % 9 == 0)
    files = files_of(rows).join(rows.select(F.col("doc_id").alias("seq"), "again"), "seq")
    files = files.withColumn("name", F.when(F.col("again"), F.concat("name", F.lit(" again"))).otherwise(F.col("name")))
    return files.withColumns({"removed": gone, "explicitly_deleted": gone, **{c: F.lit(False) for c in ("trashed", "scope_exit")}}).drop("again")


_KNOWN_AFTER = f"""f AS (SELECT * EXCLUDE (text), sha256(text) AS sha, seq % 4 AS b FROM ({FILES})),
  p AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY sha ORDER BY b, seq) = 1),
  c AS (SELECT f.* FROM f JOIN p USING (sha) WHERE f.seq <> p.seq AND p.seq % 9 = 0 AND p.seq % 3 = 0 AND f.seq % 3 = 0 AND f.seq % 9 <> 0 AND f.b > p.b QUALIFY row_number() OVER (PARTITION BY sha ORDER BY f.b, f.seq) = 1),
  after AS (SELECT file_id, CASE WHEN seq % 3 = 0 THEN name || ' again' ELSE name END AS name, sha FROM p WHERE seq % 9 <> 0 UNION ALL SELECT file_id, name || ' again', sha FROM c)"""


@query(f"WITH {_KNOWN_AFTER} SELECT file_id, name, sha AS sha256 FROM after")
def stream_known_deltas(spark, sf_dir):
    """The known files after eight micro-batches that each write a delta, with a stop inside the sixth and a restart."""
    root, docs = _folder(spark, "stream-deltas"), read(spark, sf_dir, "documents")
    schema, batches = docs.withColumn("again", F.lit(False)).schema, []

    def prepare(batch: DataFrame) -> DataFrame:
        batches.append(1)
        if len(batches) == 6:
            raise InterruptedError("stopped inside a batch")
        return _as_files(batch)

    for source in _steps(docs, root):
        for _ in range(2):  # the second start goes on after a stop, or finds nothing new
            try:
                stream.stream_inventory(spark, source, schema, root, f"{root}/checkpoint", max_files=ALL_FILES, limit_mb=1 << 20, prepare=prepare, buckets=4)
            except Exception as e:
                if len(batches) != 6:
                    raise e
    return stream.read_known(spark, root).select("file_id", "name", "sha256")


# --- a feed with cursors

PAGE_ROWS, LISTED_PAGES = 500, 3


def _write_pages(docs: DataFrame, root: str) -> None:
    """Documents as a feed: pages of a listing, then of changes, each with the cursor of the next one."""
    d = F.col("doc_id")
    fields = F.to_json(F.struct(d.alias("doc_id"), "text", "n_chars", F.col("again").alias("again")))
    rows = docs.withColumn("again", F.lit(False)).unionByName(docs.where(d % 3 == 0).withColumn("again", F.lit(True)))
    last = docs.agg(F.max(d)).first()[0] or 0
    pages = last // PAGE_ROWS + 1
    page = F.when(F.col("again"), F.lit(pages)).otherwise(F.lit(0)) + F.floor(d / PAGE_ROWS)
    parts = rows.withColumn("page", page.cast("int")).select("page", fields.alias("row"))

    def write(table: pa.Table) -> pa.Table:
        k = table.column("page")[0].as_py()
        phase, place = ("listing", k) if k < LISTED_PAGES else ("changes", k - LISTED_PAGES)
        next_ = None if k == LISTED_PAGES - 1 else str(place + 1)
        fs, folder = pafs.FileSystem.from_uri(root)
        with fs.open_output_stream(f"{folder}/{phase}-{place}.json") as f:
            f.write(json.dumps({"rows": [json.loads(r) for r in table.column("row").to_pylist()], "next": next_}).encode())
        return pa.table({"page": pa.array([k], pa.int32())})

    fs, folder = pafs.FileSystem.from_uri(root)
    fs.create_dir(folder, recursive=True)
    written = {r[0] for r in parts.groupBy("page").applyInArrow(write, "page int").collect()}
    for k in sorted(set(range(max(2 * pages, LISTED_PAGES))) - written):  # pages without rows
        phase, place = ("listing", k) if k < LISTED_PAGES else ("changes", k - LISTED_PAGES)
        with fs.open_output_stream(f"{folder}/{phase}-{place}.json") as f:
            f.write(json.dumps({"rows": [], "next": None if k == LISTED_PAGES - 1 else str(place + 1)}).encode())





@query(f"""WITH f AS (SELECT doc_id, 0 AS round FROM documents UNION ALL SELECT doc_id, 1 FROM documents WHERE doc_id % 3 = 0), m AS (SELECT max(doc_id) // {PAGE_ROWS} + 1 AS pages FROM documents)
  SELECT doc_id, CAST(round * pages + doc_id // {PAGE_ROWS} AS INTEGER) AS page, CASE WHEN round * pages + doc_id // {PAGE_ROWS} < {LISTED_PAGES} THEN 'listing' ELSE 'changes' END AS phase, round = 1 AS again, md5(text) AS text_md5
  FROM f JOIN documents USING (doc_id), m""")
def change_feed_stream(spark, sf_dir):
    """A feed of pages read as a stream, two pages a batch and more as it goes on, stopped inside a batch and begun again from the cursors of its checkpoint."""
    root = _folder(spark, "feed")
    _write_pages(read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), f"{root}/pages")
    feeds.register(spark)
    seen = []

    def keep(batch: DataFrame, number: int) -> None:
        seen.append(number)
        if len(seen) == 2:
            raise InterruptedError("stopped inside a batch")
        batch.write.mode("overwrite").parquet(f"{root}/seen/batch={number}")

    for _ in range(2):
        feed = spark.readStream.format("change_feed").schema("doc_id long, text string, n_chars long, again boolean, page int, phase string").option("path", f"{root}/pages").option("pagesPerTrigger", 2).option("growth", 0.5).load()
        running = feed.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").start()
        try:
            running.processAllAvailable()
        except Exception as e:
            if len(seen) != 2:
                raise e
        finally:
            running.stop()
    return spark.read.parquet(f"{root}/seen").select("doc_id", "page", "phase", "again", F.md5("text").alias("text_md5"))


# --- archives by ranges


#: Pages that are deflated as one batch.
PACK_ROWS = 256


def _deflated(data: bytes) -> bytes:
    made = zlib.compressobj(wbits=-15)
    return made.compress(data) + made.flush()


def _append(z: zipfile.ZipFile, name: str, crc: int, size: int, body: bytes) -> None:
    """A member whose bytes come deflated, as ``writestr`` would have written it."""
    info = zipfile.ZipInfo(name)
    info.compress_type, info.external_attr, info.CRC, info.file_size, info.compress_size, info.header_offset = zipfile.ZIP_DEFLATED, 0o600 << 16, crc, size, len(body), z.fp.tell()
    z.fp.write(info.FileHeader())
    z.fp.write(body)
    z.filelist.append(info)
    z.NameToInfo[info.filename] = info
    z.start_dir, z._didModify = z.fp.tell(), True


def _write_archives(spark, sf_dir, root: str) -> None:
    """A few archives of pages: a folder, kinds that are not read, an archive that is none, and a member whose bytes are damaged."""
    pages = read(spark, sf_dir, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"), (F.col("page_id") % 5).alias("part"))
    fs, folder = pafs.FileSystem.from_uri(root)
    fs.create_dir(folder, recursive=True)

    def pack(batches):
        """Members are deflated by as many tasks as the pages call for; what joins them to one archive copies bytes."""
        for b in batches:
            for at in range(0, len(b), PACK_ROWS):
                some = b.slice(at, PACK_ROWS)
                html = [x.encode() for x in some.column("html").to_pylist()]
                columns = [some.column("part"), some.column("page_id"), pa.array([zlib.crc32(x) for x in html], pa.int64()), pa.array([len(x) for x in html], pa.int64()), pa.array(map(_deflated, html), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "page_id", "crc", "size", "body"])

    def write(key: tuple, batches):
        part = key[0].as_py()
        own, where = pafs.FileSystem.from_uri(root)
        with own.open_output_stream(f"{where}/a{part}.zip", buffer_size=1 << 20) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("in/", "")
            z.writestr("in/skip.exe", "x")
            n = 0
            for b in batches:
                for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "crc", "size", "body")), strict=True):
                    _append(z, f"in/../p/{row[0]:09d}.html", *row[1:])
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([n], pa.int64())], ["part", "n"])

    write.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    packed = pages.mapInArrow(pack, "part long, page_id long, crc long, size long, body binary")
    packed.repartition("part").sortWithinPartitions("part", "page_id").groupBy("part").applyInArrow(write, "part long, n long").collect()
    with fs.open_output_stream(f"{folder}/broken.zip") as f:
        f.write(b"no archive")


@query("""SELECT 'a' || page_id % 5 || '.zip' AS archive, 'p/' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '.html' AS source_path, sha256(coalesce(html, '')) AS checksum_sha256, false AS broken FROM pages
  UNION ALL SELECT 'broken.zip', '', NULL, true""")
def zip_members(spark, sf_dir):
    """Members of archives in a folder, each archive read by several tasks."""
    root = _folder(spark, "zips")
    _write_archives(spark, sf_dir, root)
    archives.register(spark)
    out = spark.read.format("zip_members").option("splitBytes", 1 << 18).load(root)
    return out.select(F.regexp_extract("bundle_id", "[^/]*$", 0).alias("archive"), "source_path", "checksum_sha256", F.col("problem").isNotNull().alias("broken"))


@query("""WITH p AS (SELECT page_id % 5 AS part, page_id, html, row_number() OVER (PARTITION BY page_id % 5 ORDER BY page_id) AS k FROM pages)
  SELECT 'a' || part || '.zip' AS archive, count(*) + 2 AS n_members, 'in,in/skip.exe,' || string_agg('p/' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '.html', ',' ORDER BY page_id) FILTER (k <= 98) AS first_names,
    md5(coalesce(arg_min(html, k), '')) AS text_md5, false AS broken FROM p GROUP BY part
  UNION ALL SELECT 'broken.zip', NULL, NULL, NULL, true""")
def zip_archives(spark, sf_dir):
    """What each archive holds: its names, the first hundred of them, and the text that tells most."""
    root = _folder(spark, "zips")
    _write_archives(spark, sf_dir, root)
    archives.register(spark)
    out = spark.read.format("zip_archives").load(root)
    return out.select(F.regexp_extract("bundle_id", "[^/]*$", 0).alias("archive"), "n_members", F.array_join("archive_files", ",").alias("first_names"), F.md5("raw_text").alias("text_md5"), F.col("problem").isNotNull().alias("broken"))


# --- a stored text index

_INDEXED = """t AS (SELECT 'd' || doc_id AS record_id, CASE WHEN doc_id % 10 = 0 THEN 'the of replaced ' || coalesce(text, '') ELSE coalesce(text, '') END AS t FROM documents),
  w AS (SELECT record_id, regexp_extract_all(lower(t), '[\\p{L}\\p{N}]+') AS w FROM t)"""


def _text_index(spark, sf_dir) -> textindex.TextIndex:
    """Documents in three segments; the last brings every tenth one once more, with another text."""
    d = F.col("doc_id")
    docs = read(spark, sf_dir, "documents").select(d, F.concat(F.lit("d"), d).alias("record_id"), F.col("text").alias("searchable_text"))
    index = textindex.TextIndex(spark, _folder(spark, "textindex"), buckets=8)
    for part in (docs.where(d % 2 == 0), docs.where(d % 2 == 1), docs.where(d % 10 == 0).withColumn("searchable_text", F.concat(F.lit("the of replaced "), F.coalesce("searchable_text", F.lit(""))))):
        index.add(part.select("record_id", "searchable_text"))
    return index


@query(f"""WITH {_INDEXED}, n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM w), h AS (SELECT record_id, len(w) AS length, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'of')) AS b FROM w),
  f AS (SELECT count(*) FILTER (a > 0) AS fa, count(*) FILTER (b > 0) AS fb FROM h)
  SELECT record_id, round(ln(1 + (n - fb + 0.5) / (fb + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * length / mean)) + ln(1 + (n - fa + 0.5) / (fa + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * length / mean)), 6) AS score FROM h, f, n WHERE a > 0 AND b > 0""")
def text_index_search(spark, sf_dir):
    """Records that hold both words, scored, from an index of three segments."""
    return _text_index(spark, sf_dir).search(["The", "of"])


@query(f"""WITH {_INDEXED}, p AS (SELECT record_id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS n FROM w) SELECT record_id, n FROM p WHERE n > 0""")
def text_index_phrase(spark, sf_dir):
    return _text_index(spark, sf_dir).phrase("of the")


# --- folder trees


@query(f"""WITH RECURSIVE f AS (SELECT 'd' || p_partkey AS folder_id, 'd' || CASE WHEN p_partkey % 400 = 0 THEN p_partkey ELSE p_partkey - 1 END AS parent_id, p_partkey AS k FROM part),
  r AS (SELECT folder_id, k, folder_id AS root_id, p_path AS path FROM (SELECT f.*, 'n' || f.k AS p_path FROM f LEFT JOIN f u ON u.folder_id = f.parent_id WHERE u.folder_id IS NULL)
    UNION ALL SELECT f.folder_id, f.k, r.root_id, r.path || '/n' || f.k FROM f JOIN r ON f.parent_id = r.folder_id WHERE f.parent_id <> f.folder_id)
  SELECT f.folder_id, r.root_id, md5(r.path) AS path_md5 FROM f LEFT JOIN r USING (folder_id)""")
def folder_paths(spark, sf_dir):
    """Chains of 400 folders: one has a root, the others begin at a folder that is its own parent, which is a cycle."""
    p = F.col("p_partkey")
    rows = read(spark, sf_dir, "part").select(F.concat(F.lit("d"), p).alias("folder_id"), F.concat(F.lit("d"), F.when(p % 400 == 0, p).otherwise(p - 1)).alias("parent_id"), F.concat(F.lit("n"), p).alias("name"))
    return inventory.folder_paths(rows).select("folder_id", "root_id", F.md5("path").alias("path_md5"))


# --- weeks kept up to date


@query(SQL["weekly_memory"])
def stream_weekly(spark, sf_dir):
    """Weekly rollups kept up to date by micro-batches of records; equal to one rollup of all."""
    root = _folder(spark, "stream-weekly")
    rows = event_records(read(spark, sf_dir, "events"))
    for source in _grow(rows, root, "seq", 3):
        stream.stream_daily(spark, source, rows.schema, root, f"{root}/checkpoint", AS_OF, max_files=ALL_FILES, buckets=4)
    w = stream.read_weekly(spark, root)
    return w.select("week", *[F.array_join(c, ",").alias(c) for c in ("days_covered",)], "day_count", "total_records", "total_importance", *[F.array_join(c, ",").alias(c) for c in ("top_people", "top_apps", "weekly_highlights")])


# --- long lists as segments

_CUT = "SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1) AS r FROM {rows}"
_FAMILY = " UNION ALL ".join(f"SELECT event_date AS date, '{name}' AS list, seq, record_id AS value FROM records WHERE contains(record_type, '{word}')" for name, word in rollups.FAMILIES.items())
_NAMED = " UNION ".join(f"SELECT event_date AS date, '{c}' AS list, 0 AS seq, unnest({c}) AS value FROM records" for c in ("people", "places", "apps"))


@query(f"""WITH {_RECORDS}, l AS ({_FAMILY} UNION ALL SELECT event_date, 'llm_activity', seq, record_id FROM records WHERE starts_with(record_type, 'llm_') UNION ALL SELECT event_date, 'record_ids', seq, record_id FROM records
    UNION ALL SELECT event_date, 'media_refs', seq, url FROM records WHERE url <> '' UNION ALL ({_NAMED} UNION SELECT event_date, 'source_ids', 0, source_id FROM records)),
  c AS ({_CUT.format(keys='date, list', order='seq, value', rows='l')})
  SELECT date, list, r // 25 AS segment, min(r) AS first, count(*) AS n, md5(string_agg(value, ',' ORDER BY r)) AS values_md5 FROM c GROUP BY ALL""")
def daily_segments(spark, sf_dir):
    out = segments.daily_segments(event_records(read(spark, sf_dir, "events")), size=25)
    return out.select("date", "list", "segment", "first", F.size("values").cast("long").alias("n"), F.md5(F.array_join("values", ",")).alias("values_md5"))


@query(f"""WITH {_MENTIONS}, c AS ({_CUT.format(keys='entity_id', order='source_id', rows='(SELECT DISTINCT entity_id, source_id FROM child)')})
  SELECT entity_id, r // 10 AS segment, min(r) AS first, string_agg(source_id, ',' ORDER BY r) AS source_ids FROM c GROUP BY ALL""")
def entity_segments(spark, sf_dir):
    out = segments.entity_segments(graph.entity_sources(event_records(read(spark, sf_dir, "events"))), size=10)
    return out.select("entity_id", "segment", "first", F.array_join("values", ",").alias("source_ids"))


@query(f"""WITH {_DEDUPED}, c AS ({_CUT.format(keys='sha', order='file_id', rows="(SELECT * FROM deduped WHERE status = 'DUPLICATE')")})
  SELECT sha AS sha256, primary_id AS original_file_id, r // 3 AS segment, min(r) AS first, string_agg(file_id, ',' ORDER BY r) AS file_ids FROM c GROUP BY ALL""")
def duplicate_segments(spark, sf_dir):
    out = segments.duplicate_segments(_deduped(spark, sf_dir), size=3)
    return out.select("sha256", "original_file_id", "segment", "first", F.array_join("values", ",").alias("file_ids"))


# --- a stream whose state goes


@query("""WITH e AS (SELECT *, event_id % 5 > 0 AS early FROM events), w AS (SELECT max(ts) FILTER (early AND day(ts) <= 20) - INTERVAL 1 DAY AS first_mark, max(ts) - INTERVAL 1 DAY AS last_mark FROM e),
  k AS (SELECT e.*, early OR ts > first_mark AS taken, ts <= first_mark AS old, last_mark FROM e, w)
  SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, sum(value) AS total FROM k WHERE taken AND date_trunc('day', ts) + INTERVAL 1 DAY <= last_mark GROUP BY ALL
  UNION ALL SELECT 'late', '', count(*) FILTER (old AND NOT early) + count(*) FILTER (old AND early AND day(ts) % 7 = 0), 0 FROM k""")
def stream_expiring_counts(spark, sf_dir):
    """Events in order of time; then, all at once, a fifth of them that comes late, and repetitions of some that have come before.

    A batch's rows are held against the watermark that the batch before it was run with.
    """
    root = _folder(spark, "stream-expiring")
    events = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(18,6)").alias("value"))
    early = events.where("event_id % 5 > 0")
    for part in (early.where("day(ts) <= 10"), early.where("day(ts) between 11 and 20"), early.where("day(ts) > 20"), events.where("event_id % 5 = 0").unionByName(early.where("day(ts) % 7 = 0"))):
        part.coalesce(1).write.mode("append").parquet(f"{root}/events")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
    counts = stream.stream_expiring_counts(rows).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.col("total").cast("double").alias("total"))
    running = counts.writeStream.format("parquet").option("path", f"{root}/counts").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    late = spark.range(1).select(F.lit("late").alias("day"), F.lit("").alias("event_type"), F.lit(stream.late_rows(running)).cast("long").alias("n"), F.lit(0.0).alias("total"))
    return spark.read.schema("day string, event_type string, n long, total double").parquet(f"{root}/counts").unionByName(late)

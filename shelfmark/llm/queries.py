"""The registered queries of this package, one thin query per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, divergence, embedding_dedup, ngram_join, packing, quality, secrets, sharding, topk, url_filter, warc, whitening

from .common import LOWER, UPPER


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Weak labels for URLs: a host with one of these words as a part of a label is bad.
BAD_HOST_WORDS = ["spam", "casino", "pills", "bets", "ads", "adult"]


def labelled_urls(pages: DataFrame) -> DataFrame:
    words = F.split(url_filter.host_of(F.col("url")), r"[.\-]")
    return pages.select("url", F.arrays_overlap(words, F.array(*map(F.lit, BAD_HOST_WORDS))).cast("double").alias("label"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train_url_model(labelled_urls(pages))
    out = url_filter.filter_urls(pages, model, URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DECONTAM_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
s AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)),
m AS (SELECT doc_id, i, k, item_id FROM s JOIN p USING (k, phrase)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", "kept")


_EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
c AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT c.node, l.b FROM c JOIN l ON l.a = c.seen),
m AS (SELECT node, min(seen) AS component_id FROM c GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN m ON m.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id"""


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_read(spark, sf_dir, "documents"))


_JOIN_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(g) AS g FROM (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
t AS (SELECT sum(g) AS sig, n, doc_id FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
r AS (SELECT min(doc_id) AS rep, sig, n FROM t GROUP BY sig, n),
u AS (SELECT s.* FROM s JOIN r ON r.rep = s.doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
c AS (SELECT rep AS node, rep AS seen FROM r UNION SELECT c.node, l.b FROM c JOIN l ON l.a = c.seen),
m AS (SELECT node, min(seen) AS component_id FROM c GROUP BY node),
q AS (SELECT sig, n, min(doc_id) AS rep, count(*) AS n_equal FROM t GROUP BY sig, n),
o AS (SELECT l.a AS rep, sum(q.n_equal) AS n_other FROM l JOIN q ON q.rep = l.b GROUP BY l.a)
SELECT w.doc_id, coalesce(t.n, 0) AS n_shingles, coalesce(m.component_id, w.doc_id) AS component_id,
  CAST(coalesce(q.n_equal, 1) AS BIGINT) AS n_equal, CAST(coalesce(o.n_other, 0) + coalesce(q.n_equal, 1) - 1 AS BIGINT) AS n_links
FROM w LEFT JOIN t ON t.doc_id = w.doc_id LEFT JOIN r ON r.sig = t.sig AND r.n = t.n LEFT JOIN m ON m.node = r.rep LEFT JOIN q ON q.rep = r.rep LEFT JOIN o ON o.rep = r.rep"""


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(_read(spark, sf_dir, "documents"), quality.trusted_ids(_read(spark, sf_dir, "labels")))
    return out.select("doc_id", "lang", "n_symbols", "perplexity", "accepted")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, warc.archive_folder(pages))
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(manifest).select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


_WARC_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM d"""


CHAT_PROBE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHAT_PROBE).alias("text")
    )
    out = chat.format_conversations(rows.unionByName(probe))
    out = out.select("conv_id", "formatted", "valid", chat.parse_formatted(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def _chat_sql() -> str:
    t = chat.TEMPLATE
    q = lambda s: "'" + s.replace("'", "''") + "'"
    esc = f"replace(text, {q(t['escape'])}, {q(t['escape'] * 2)})"
    for c in t["controls"]:
        esc = f"replace({esc}, {q(c)}, {q(c[0] + t['escape'] + c[1:])})"
    marks = " ".join(f"WHEN role = {q(r)} THEN {len(x['open'] + x['close'])}" for r, x in t["roles"].items())
    o = t["other"]
    other = len(o["open"] + o["name_end"] + o["close"])
    state = "'start'"
    return f"""
    WITH RECURSIVE c AS (
      SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', {q(CHAT_PROBE)} UNION ALL SELECT -1, 1, 'assistant', {q(CHAT_PROBE)}),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS m FROM c),
    w AS (SELECT conv_id, CAST(0 AS BIGINT) AS k, {state} AS s FROM (SELECT DISTINCT conv_id FROM n)
      UNION ALL SELECT n.conv_id, n.k, CASE {' '.join(f"WHEN w.s = {q(s)} AND n.role = {q(r)} THEN {q(to)}" for (s, r), to in t['moves'].items())} ELSE 'error' END
      FROM w JOIN n ON n.conv_id = w.conv_id AND n.k = w.k + 1)
    SELECT n.conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(length({esc}) + CASE {marks} ELSE {other} + length({esc.replace('text', 'role', 1)}) END) AS BIGINT) AS formatted_chars,
      (SELECT w.s IN ({', '.join(map(q, t['accept']))}) FROM w WHERE w.conv_id = n.conv_id AND w.k = max(n.m)) AS valid
    FROM n GROUP BY n.conv_id"""


#: Bytes of text that a shard may hold.
SHARD_BYTES = 1 << 20


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = sharding.shard(rows, "doc_id", F.col("n_bytes"), SHARD_BYTES)
    return out.select("doc_id", "n_bytes", "shard", F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_rows")


_SHARD_SQL = f"""
WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
x AS (SELECT d.*, k, h >> CAST(60 - k AS INTEGER) AS node FROM d, range(0, 61) AS t(k)),
n AS (SELECT k, node, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows FROM x GROUP BY k, node HAVING sum(n_bytes) <= {SHARD_BYTES} OR min(h) = max(h)),
f AS (SELECT x.doc_id, x.n_bytes, x.h, min(k) AS depth FROM x JOIN n USING (k, node) GROUP BY x.doc_id, x.n_bytes, x.h)
SELECT f.doc_id, f.n_bytes, substr(lpad(bin(f.h), 60, '0'), 1, CAST(f.depth AS INTEGER)) AS shard, f.depth, n.shard_bytes, n.shard_rows
FROM f JOIN n ON n.k = f.depth AND n.node = f.h >> CAST(60 - f.depth AS INTEGER)"""


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train_on(docs))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


_DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
c AS (SELECT lang, source, item, count(*) AS n, count(DISTINCT r) AS docs FROM (SELECT r, lang, source, unnest(w) AS item FROM d) GROUP BY ALL),
k AS (SELECT lang, item, sum(n) AS total FROM c GROUP BY lang, item HAVING sum(docs) >= 30),
f AS (SELECT lang, source, item, n FROM c SEMI JOIN k USING (lang, item)),
v AS (SELECT lang, count(*) AS terms, sum(total) AS lang_size FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS size FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN f USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, item, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)::HUGEINT) // (size + 5 * terms)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (total + 5)::HUGEINT) // (lang_size + 5 * terms)::HUGEINT AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN f USING (lang, source, item)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.item = b.item AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', item, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
x AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT * FROM x WHERE part = 'pair' OR rank <= 50"""


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = topk.build_index(_read(spark, sf_dir, "embeddings"))
    return topk.search(index, lambda i: i % 20 == 0)


_TOPK_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS BIGINT) AS score FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 20"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES = {"op1_url_filter": op1_url_filter, "op2_decontaminate": op2_decontaminate, "op3_quality": op3_quality, "op4_warc": op4_warc, "op5_chat_format": op5_chat_format, "op6_embedding_dedup": op6_embedding_dedup, "op7_ngram_join": op7_ngram_join, "op8_pack": op8_pack, "op9_shard": op9_shard, "op10_secrets": op10_secrets, "op11_divergence": op11_divergence, "op12_topk": op12_topk, "op13_whitening": op13_whitening}
SQL = {"op2_decontaminate": _DECONTAM_SQL, "op4_warc": _WARC_SQL, "op5_chat_format": _chat_sql(), "op6_embedding_dedup": _EMBEDDING_SQL, "op7_ngram_join": _JOIN_SQL, "op9_shard": _SHARD_SQL, "op11_divergence": _DIVERGENCE_SQL, "op12_topk": _TOPK_SQL}

"""URL filter, chat formatting and sharding."""

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat, queries, sharding, url_filter

from .docs import awkward, empty


def test_url_rules_and_edges(spark):
    urls = ["http://A.Net/x", "https://b.example.net/en/1", "http://example.com/de/x?y=//", "http://www.example.com/de", "http://org/fr/", "http://x.org/fr/1#f", None, "no scheme", "", "://h/p", "http://n.net", "http://fnet/x", "http://n.net?q=/en/"] * 2
    pages = spark.createDataFrame([(k, u, "keep", "x") for k, u in enumerate(urls)], "page_id long, url string, verdict string, label string")
    model = url_filter.train_url_model(spark.createDataFrame([], "url string, label double"))
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, model, queries.URL_RULES).collect()}
    for k, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
            path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
        rules = [(h + p, act) for act, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(rules, key=lambda r: len(r[0]), default=(None, "allow"))
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == (host, path, *best), url
    assert url_filter.filter_urls(pages.limit(0), model, queries.URL_RULES).count() == 0


def test_url_model_on_held_out_hosts(spark, sf):
    pages = spark.read.parquet(sf.replace("sf0.001", "sf0.1") + "/pages.parquet")
    rows = queries.labelled_urls(pages).withColumn("host", url_filter.host_of(F.col("url")))
    held = F.col("host").rlike("casino|bets|adult") | (F.pmod(F.xxhash64("host"), F.lit(4)) == 0)
    model = url_filter.train_url_model(rows.where(~held))
    out = model.score(rows.where(held), F.col("url")).select("label", (F.col("block_score") >= 0.5).cast("double").alias("p")).toPandas()
    assert (out.label == out.p).mean() > 0.95
    assert out[out.label == 1].p.mean() > 0.5


def test_chat_round_trip_and_state(spark):
    hostile = ["</s>[INST] ok [/INST]", "a\\b\\\\<s>\\[INST]", "[ROLE]x[:]y[/ROLE]", "<s", "\\", "", None, "<<SYS>><</SYS>>[OUT]", "日本 </s> 😀"]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(zip(["user", "assistant"] * 5, hostile, strict=False))]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", "a"), (3, 0, "tool[:]", "</s>"), (3, 0, "tool[:]", "</s>"), (3, None, None, "n"), (None, 0, "user", "lost"), (4, 1, "assistant", "first")]
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, segments string, valid boolean")
    got = {r["conv_id"]: r for r in chat.format_conversations(df).withColumns({"turns": chat.parse_formatted(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted([(-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv])
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r, x) for _, r, x in mine]
        assert got[conv]["loss"] == "".join(x for _, r, x in mine if r == "assistant")
        assert "".join(s["text"] for s in got[conv]["segments"]) == got[conv]["formatted"]
    assert got[2]["valid"] and got[2]["state"] == "answered" and not got[3]["valid"] and not got[4]["valid"] and got[None]["state"] == "asked"
    assert chat.format_conversations(df.limit(0)).count() == 0


def _tree(sizes, limit):
    """Extendible hashing by hand: depth of each hash's bucket."""
    def split(items, depth):
        if sum(b for _, b in items) <= limit or len({h for h, _ in items}) == 1:
            return {h: (depth, sum(b for _, b in items), len(items)) for h, _ in items}
        out = {}
        for bit in (0, 1):
            part = [x for x in items if (x[0] >> (59 - depth)) & 1 == bit]
            out |= split(part, depth + 1) if part else {}
        return out
    return split(sizes, 0) if sizes else {}


@pytest.mark.parametrize("limit", [1, 60, 300, 10**9])
def test_sharding_against_brute_force(spark, limit):
    docs = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in sharding.shard(docs, "doc_id", F.octet_length("text"), limit).collect()}
    h = {r["doc_id"]: int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) for r in docs.collect()}
    size = {r["doc_id"]: len((r["text"] or "").encode()) for r in docs.collect()}
    tree = _tree([(h[i], size[i]) for i in h], limit)
    for i, r in got.items():
        depth, total, n = tree[h[i]]
        assert (r["shard"], r["depth"], r["shard_bytes"], r["shard_rows"]) == (format(h[i], "060b")[:depth], depth, total, n)
        assert r["oversize"] == (total > limit) and r["source"] == "s"
    assert len(got) == len(h)


def test_sharding_of_a_hot_key_and_nulls(spark):
    rows = spark.range(900).selectExpr("case when id < 600 then 5 when id < 620 then null else id end as k", "10L as b", "id as payload")
    out = sharding.shard(rows, "k", F.col("b"), 100).collect()
    per = defaultdict(int)
    for r in out:
        per[r["shard"]] += r["b"]
    assert len(out) == 900 and {r["payload"] for r in out} == set(range(900))
    assert max(per.values()) <= 100 and all(per[r["shard"]] == r["shard_bytes"] for r in out)
    assert sharding.shard(empty(spark), "doc_id", F.octet_length("text"), 10).count() == 0
    assert math.isclose(sum(per.values()), 9000)


WORK = [*url_filter.LEXICAL, *url_filter.SUFFIX, "suffix1", "suffix2", "f_url", "f_host", "f_path", "f_vector", "probability", "rawPrediction", "prediction", "prefix", "leaf", "hist", "node", "b", "c", "lo", "hi", "shard_bytes", "label"]


def test_work_columns_meet_no_column_of_the_caller(spark):
    urls = [(k, f"http://{'bad-' * (k % 2)}h{k % 7}.example.com/p{k}?x={k}", float(k % 2)) for k in range(60)]
    train = spark.createDataFrame(urls, "k long, url string, label double")
    model = url_filter.train_url_model(train)
    assert model.trees is not None
    clash = train.select("k", "url", *[F.concat(F.lit(c), "k").alias(c) for c in WORK])
    plain = {r["k"]: (r["verdict"], r["block_score"]) for r in url_filter.filter_urls(train.select("k", "url"), model, queries.URL_RULES).collect()}
    got = url_filter.filter_urls(clash, model, queries.URL_RULES).collect()
    assert len(got) == 60 and all((r["verdict"], r["block_score"]) == plain[r["k"]] and all(r[c] == f"{c}{r['k']}" for c in WORK) for r in got)
    own = [c for c in WORK if c not in sharding.ADDED]
    for key, limit in (("k", 100), ("same", 300)):  # split by bits of keys, and by rows of one key
        rows = clash.withColumn("same", F.lit(1))
        told = sharding.shard(rows, key, F.lit(20), limit).collect()
        assert len(told) == 60 and all(r[c] == f"{c}{r['k']}" for r in told for c in own) and max(r["shard_bytes"] for r in told) <= limit

"""The source audit, exact search and whitening against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import divergence, eigen, embedding_dedup, topk, whitening

from .docs import SCHEMA, awkward, empty

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, near string, shard int"


def _vectors(spark, rows):
    return spark.createDataFrame([(k, v, 1, "i", "v", "n", 2) for k, v in rows], VECTORS)


def _odd_vectors():
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(scale=0.3, size=12).tolist()) for k in range(400)]
    rows += [(400 + k, rows[7][1]) for k in range(90)]  # copies: ties beyond the ranks
    return rows + [(20, rows[20][1]), (20, rows[20][1]), (None, rows[3][1]), (500, None), (501, [0.1] * 11 + [None]), (502, [float("nan")] * 12), (503, [float("inf")] + [0.0] * 11), (504, []), (505, [0.5, -0.5]), (506, [0.0] * 12), (540, [0.7] * 12)]


def _ints(rows, dims=12):
    return [(k, np.floor(64 * np.array([*np.array(v, np.float32), *[0.0] * (dims - len(v))], float)).astype(int)) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]


def _audit(docs, least, ranks):
    """The contract, one document after the other."""
    by, seen, groups = defaultdict(Counter), Counter(), set()
    for lang, source, text in docs:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups.add((lang or "", source or ""))
        by[lang or "", source or ""].update(words)
        seen.update((lang or "", w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (x, w), n in seen.items() if x == lang and n >= least]
        own = {s: {w: by[lang, s][w] for w in kept} for x, s in groups if x == lang}
        share = lambda c: {w: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for w, n in c.items()}
        p, q = {s: share(c) for s, c in own.items()}, share({w: sum(c[w] for c in own.values()) for w in kept})
        for s in own:
            pairs = sorted(((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in own if o != s))
            terms = sorted((q[w] - p[s][w], w.encode()) for w in kept if own[s][w] and p[s][w] > q[w])[:ranks]
            out += [(lang, s, part, i.decode(), -v, k + 1) for part, rows in (("pair", pairs), ("term", terms)) for k, (v, i) in enumerate(rows)]
    return sorted(out)


def _corpus():
    rng = np.random.default_rng(9)
    words = [f"{'é' if k % 5 == 0 else ''}w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    docs = []
    for k in range(300):
        source = f"s{k % 7}" if k % 3 else "hot"
        at = (rng.zipf(1.5, size=rng.integers(0, 60)) + 10 * (k % 4)) % len(words)
        docs.append((["en", "de", None][k % 3 if k % 5 else 0], source, " ".join(words[i].upper() if i % 2 else words[i] + "9 " for i in at)))
    docs += [("en", "hot", "Über [x] " * 40_000), ("en", "none", None), (None, None, ""), ("lone", "only", "a b"), ("en", "no\nwords\x01", "1 2 3"), docs[4], docs[4]]
    return docs


def _documents(spark, docs):
    return spark.createDataFrame([(k, t, lang, s, 1, "x", 3, "r", 7, None, "h") for k, (lang, s, t) in enumerate(docs)], SCHEMA).withColumns({c: F.lit("z") for c in ("term", "groups", "block", "p", "rank")})


@pytest.mark.parametrize("held", [40, 400_000])
def test_audit_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    monkeypatch.setattr(divergence, "SLICE", 64)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", 16)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2 if held == 40 else 128)
    docs = _corpus()
    got = divergence.audit(_documents(spark, docs).repartition(5), least=4, ranks=6, shards=3)
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == _audit(docs, 4, 6)


def test_audit_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, divergence.audit(docs, least=1).collect())) == _audit(rows, 1, 50)
    assert {r["value"] for r in divergence.audit(_documents(spark, [("x", "a", "one"), ("x", "b", None)])).collect()} == {0}
    assert divergence.audit(empty(spark)).count() == 0


def test_probabilities_of_huge_counts_are_exact(spark):
    n, size, terms = 3 * 10**15 + 7, 10**16 + 9, 12345
    got = spark.range(1).select(divergence._probability(F.lit(n), F.lit(size), F.lit(terms)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 5) // (size + 5 * terms)


@pytest.mark.parametrize("rows_of_shard", [64, 8192])
def test_search_against_brute_force(spark, monkeypatch, rows_of_shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", rows_of_shard)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 8)
    monkeypatch.setattr(topk, "BOUND_ROWS", 16)
    monkeypatch.setattr(topk, "BATCH", 3)
    rows = _odd_vectors()
    x = _ints(rows)
    want = []
    for i, (k, q) in enumerate(x):
        if k is not None and k % 20 == 0:
            others = sorted((-int(q @ v), 10**9 if o is None else o) for j, (o, v) in enumerate(x) if j != i)[:20]
            want += [(k, r + 1, None if o == 10**9 else o, -s) for r, (s, o) in enumerate(others)]
    got = topk.search(topk.build_index(_vectors(spark, rows)), lambda i: i % 20 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_search_of_few_and_of_none(spark):
    ask = lambda rows: sorted(map(tuple, topk.search(topk.build_index(_vectors(spark, rows)), lambda i: i % 20 == 0).collect()))
    assert ask([]) == [] and ask([(20, [1.0])]) == [] and ask([(1, [1.0]), (2, [0.0])]) == []
    assert ask([(20, [1.0]), (1, [-1.0]), (40, [])]) == [(20, 1, 40, 0), (20, 2, 1, -4096), (40, 1, 1, 0), (40, 2, 20, 0)]
    got = ask([(0, [2.0**24, 1.0]), (1, [2.0**24, 0.5]), (3, [2.0**24, 0.75])])
    assert got == [(0, 1, 3, 2**60 + 64 * 48), (0, 2, 1, 2**60 + 64 * 32)]


def test_eigenpairs_of_clustered_values():
    h = np.ones((1, 1))
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    values = np.array([1 + i * 2.0**-30 for i in range(8)] + [3, 3, 5, 7, 7 + 2.0**-20, 9, 11, 13])
    a = (h * values) @ h.T / 16  # exact in double precision
    got, x = eigen.eigenpairs(a)
    assert np.abs(got - np.sort(values)).max() < 1e-17
    true = (h / 4)[:, np.argsort(values, kind="stable")]
    same = np.abs((true.T @ x.astype(float)).diagonal())
    alone = [k for k in range(16) if k not in (8, 9)]  # the value 3 has a plane
    assert (1 - same[alone]).max() < 1e-15
    assert float(np.abs(a @ x - x * got).max()) < 1e-17 and float(np.abs(eigen.product(x.T, x) - np.eye(16)).max()) < 1e-17
    wide = np.random.default_rng(1).normal(size=(64, 200))
    v = wide @ wide.T / 200
    values, x = eigen.eigenpairs(v)
    assert np.allclose(values.astype(float), np.linalg.eigvalsh(v), rtol=0, atol=1e-13)
    assert float(np.abs(eigen.product(v, x) - x * values).max()) < 1e-17
    for m in (np.eye(5), np.zeros((4, 4)), np.diag([1.0, 1, 1, 2]), np.ones((6, 6)), np.array([[2.0]]), np.zeros((0, 0))):
        values, x = eigen.eigenpairs(m)
        assert np.abs(m @ x - x * values).max(initial=0) < 1e-17 and np.abs(x.T @ x - np.eye(len(m))).max(initial=0) < 1e-17


def test_whitening_against_double_precision(spark):
    rows = _odd_vectors()
    x = _ints(rows)
    m = np.stack([v for _, v in x]) + 1_000_000
    n, s = len(m), m.sum(axis=0)
    rises = n * m - s
    values, vectors = np.linalg.eigh((rises / n).T @ (rises / n) / n)
    order = np.argsort(-values)[:5]
    want = (rises / n) @ vectors[:, order] / np.sqrt(values[order])
    got = whitening.whiten(_vectors(spark, rows).repartition(3), components=5).toPandas()
    assert len(got) == 5 * n and set(got["n"]) == {n} and got["identity_error"].max() < 1e-12 and set(got["component"]) == {1, 2, 3, 4, 5}
    whole = whitening.whiten(_vectors(spark, rows), components=99).toPandas()
    assert len(whole) == 12 * n and abs(whole.groupby("component")["explained"].first().sum() - 1) < 1e-12
    for c in range(5):
        one = got[got["component"] == c + 1]
        assert abs(one["explained"].iloc[0] - values[order[c]] / values.sum()) < 1e-12
        assert sorted(one["deviation"]) == sorted((rises**2).sum(axis=1))
        sign = np.sign(one[one["vec_id"] == 540]["whitened"].iloc[0] * want[[k == 540 for k, _ in x], c][0])
        assert np.allclose(np.sort(one["whitened"] * sign), np.sort(want[:, c]), rtol=0, atol=1e-9)


def test_whitening_without_variance_and_without_rows(spark):
    assert whitening.whiten(_vectors(spark, [])).count() == 0 and whitening.whiten(_vectors(spark, [(1, None), (2, [])])).count() == 0
    flat = whitening.whiten(_vectors(spark, [(1, [0.5, 0.5, 0.0]), (None, [0.25, 0.25, 0.0]), (3, [0.5, 0.5, 0.0])])).toPandas()
    assert len(flat) == 9 and flat["whitened"].isna().sum() == 6 and flat["identity_error"].max() < 1e-12
    alone = whitening.whiten(_vectors(spark, [(1, [0.5, 0.5])])).toPandas()
    assert alone["whitened"].isna().all() and set(alone["explained"]) == {0.0} and set(alone["deviation"]) == {0}


def test_vectors_of_each_length_are_compared(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 5)).tolist()
    rows = [(k, rng.normal(size=8).tolist()) for k in range(20)] + [(20, None), (21, [1.0]), (22, [-2.0]), (23, [3.0])]
    rows += [(30, base[0]), (31, base[0]), (32, [2 * c for c in base[0]]), (33, [c + 0.01 for c in base[1]]), (34, base[1]), (35, base[2]), (40, rows[3][1]), (41, [c * 0.5 for c in rows[4][1]])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(_vectors(spark, rows)).collect()}
    vectors = {k: np.array(v) for k, v in rows if v is not None}
    near = lambda a, b: len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95
    for k, v in vectors.items():
        linked = [o for o, w in vectors.items() if o != k and near(v, w)]
        assert got[k] == (len(linked), min([k, *linked])), k
    assert got[20] == (0, 20) and got[30] == (2, 30) and got[21] == (1, 21)

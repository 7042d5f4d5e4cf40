"""Sharding by extendible hashing, with DataFrame functions only.

The key's hash is a string of ``HASH_BITS`` bits. A bucket is a prefix of it; a bucket
that is over the byte limit splits on its next bit, all others stay. The directory holds
one row per bucket. Only sums per prefix are shuffled, never documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

HASH_BITS = 60
ADDED = ("shard", "depth", "shard_bytes", "shard_rows", "oversize")
#: A directory of at most so many prefixes is joined by broadcast (about 32 bytes a row).
BROADCAST_PREFIXES = 200_000


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a long; a null key counts as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _levels(hashed: DataFrame, limit: int, bits: int, first: int) -> DataFrame:
    """Depth of the bucket of each prefix of ``bits`` bits, null where it must split further.

    A bucket needs no split if it is within the limit or holds one hash only.
    ``first``: the depth at which this level's search begins (its parents are all too large).
    """
    hist = hashed.groupBy(F.shiftright("__h", HASH_BITS - bits).alias("prefix")).agg(
        F.sum("__bytes").alias("b"), F.count("*").alias("c"), F.min("__h").alias("lo"), F.max("__h").alias("hi")
    )
    hist = checkpoint(hist)
    fits = (F.col("b") <= limit) | (F.col("lo") == F.col("hi"))
    node = F.expr(f"shiftrightunsigned(prefix, {bits} - depth)")
    nodes = (
        hist.withColumn("depth", F.explode(F.sequence(F.lit(first), F.lit(bits))))
        .groupBy("depth", node.alias("node"))
        .agg(F.sum("b").alias("b"), F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where(fits)
    )
    found = (
        hist.select("prefix", F.explode(F.sequence(F.lit(first), F.lit(bits))).alias("depth"))
        .withColumn("node", node)
        .join(nodes, ["depth", "node"])
        .groupBy("prefix")
        .agg(
            F.min(F.struct("depth", F.col("b").alias("shard_bytes"), F.col("c").alias("shard_rows"), F.expr("lo = hi").alias("one_hash"))).alias("leaf")
        )
    )
    return hist.select("prefix").join(found, "prefix", "left")


def shard(docs: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """Add ``shard`` (the bucket's bits), ``depth``, ``shard_bytes``, ``shard_rows`` and ``oversize``. Assigns shards; writing
    them is ``partitionBy`` or ``repartition`` by ``shard``.

    * A null key is the empty key; a null ``size`` counts as 0; an empty table stays empty.
    * Rows with one key share all bits. If such a bucket is over the limit, its rows are
      split once more by the bits of a number given to each row: ``shard`` is then
      ``bits+bits``, and ``depth`` counts both.
    * A single row over the limit is a shard of its own, flagged by ``oversize``.
    * Columns of ``docs`` that have the names added here are replaced, all others stay.
    """
    own = [f"`{c}`" for c in docs.columns if c not in ADDED]
    # the caller's columns go through as one, so that none of them meets a work column
    rows = docs.select(F.struct(*own).alias("__own"), hash_bits(docs[f"`{key}`"]).alias("__h"), F.coalesce(size.cast("long"), F.lit(0)).alias("__bytes"))
    return _split(rows, limit).select("__own.*", *ADDED)


def _split(rows: DataFrame, limit: int, salted: bool = False) -> DataFrame:
    """``shard`` of rows (__own, __h, __bytes)."""
    hashed = rows.select("__h", "__bytes")
    total = hashed.agg(F.sum("__bytes").alias("b")).first()["b"] or 0
    bits = min(HASH_BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + 3))
    first, open_rows, out = 0, rows, None
    while True:
        level = checkpoint(_levels(open_rows.select("__h", "__bytes"), limit, bits, first))
        n, n_open = level.agg(F.count("*"), F.count(F.when(F.col("leaf").isNull(), 1))).first()
        level = F.broadcast(level) if n <= BROADCAST_PREFIXES else level
        joined = open_rows.withColumn("prefix", F.shiftright("__h", HASH_BITS - bits)).join(level, "prefix").drop("prefix")
        done = joined.where(F.col("leaf").isNotNull())
        out = done if out is None else out.unionByName(done)
        if not n_open or bits == HASH_BITS:
            break
        # all prefixes left hold more than the limit, so there are fewer of them than shards
        open_rows = joined.where(F.col("leaf").isNull()).drop("leaf")
        first, bits = bits + 1, min(HASH_BITS, bits + 8)
    text = F.expr(f"substring(lpad(bin(__h), {HASH_BITS}, '0'), 1, leaf.depth)")
    over = F.expr(f"leaf.one_hash and leaf.shard_bytes > {int(limit)} and leaf.shard_rows > 1")
    kept = out.withColumns(
        {"shard": text, "depth": F.col("leaf.depth"), "shard_bytes": F.col("leaf.shard_bytes"), "shard_rows": F.col("leaf.shard_rows"), "oversize": F.expr(f"leaf.shard_bytes > {int(limit)}"), "__over": over}
    ).drop("leaf")
    plain = kept.where(~F.col("__over")).drop("__h", "__bytes", "__over")
    if salted or kept.where("__over").limit(1).isEmpty():
        return kept.drop("__over") if salted else plain
    many = checkpoint(kept.where("__over").select("__own", "__h", "__bytes", F.col("shard").alias("__shard"), F.monotonically_increasing_id().alias("__k")))
    outer = many.select(F.struct("__own", "__shard").alias("__own"), hash_bits(F.concat_ws(":", "__h", "__k")).alias("__h"), "__bytes")
    again = _split(outer, limit, salted=True)
    again = again.select("__own.*", F.col("shard").alias("__more"), "depth", "__bytes")
    again = again.select("__own", F.concat_ws("+", "__shard", "__more").alias("shard"), (F.length("__shard") + F.col("depth")).alias("depth"), "__bytes")
    # the salted bits are shared by all crowded keys, so a shard's sums are taken anew
    sums = again.groupBy("shard").agg(F.sum("__bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    again = again.join(sums, "shard").withColumn("oversize", F.col("shard_bytes") > limit)
    return plain.unionByName(again.select(plain.columns))

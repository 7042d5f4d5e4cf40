"""A corpus pipeline: quality, near duplicates, contamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and returns the
documents that it keeps, with the same columns; the last one returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontam, ngram_join, packing, quality, secrets
from shelfmark.llm.common import checkpoint, row_key, table


#: Up to so many keys (64 bytes each) go to every task; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__key", row_key(docs, "doc_id", "lang", "text"))


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _without(docs: DataFrame, keys: DataFrame, drop: bool = True) -> DataFrame:
    left = docs.join(_small(checkpoint(keys.distinct())), "__key", "left_anti")
    return left.drop("__key") if drop else left


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is unusual in their language go.

    So do null and empty texts, which have none. Repeated rows are judged alike; very long texts
    are read whole; an empty table stays empty; columns of any other name pass through.
    """
    trusted = quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    others = tuple(c for c in docs.columns if c != "text")
    judged = quality.classify(docs, trusted, keep=others, with_text=True).where("accepted")
    return judged.select(*[F.col("text").cast(docs.schema["text"].dataType) if c == "text" else F.col("kept")[c].alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links connect, the document with the smallest id stays; of equal rows, one.

    A null id counts as larger than any other. Texts without words (null, empty) link with nothing, so
    only equal rows of them go. Very long texts are compared whole; an empty table stays empty.
    """
    keyed = _keyed(docs)
    named = keyed.select("text", F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "__key").alias("id"))
    groups = checkpoint(ngram_join.jaccard_components(named, doc_id="id").select(F.col("doc_id.__key").alias("__key"), (F.col("doc_id") == F.col("component_id")).alias("first")))
    kept = _without(keyed, groups.where("not first").select("__key"), drop=False)
    again = checkpoint(groups.where("first").groupBy("__key").count().where("count > 1").select("__key"))
    if again.isEmpty():
        return kept.drop("__key")
    once = keyed.join(_small(again), "__key", "left_semi").dropDuplicates(["__key"])
    return _without(kept, again).unionByName(once.drop("__key"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    Null and empty texts hold none and stay; repeated rows share one fate; very long texts are
    searched whole; an empty table stays empty; columns of any other name pass through.
    """
    keyed = _keyed(docs)
    found = decontam.find_contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id="__key")
    return _without(keyed, found.where("contaminated").select(F.col("doc_id").alias("__key")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to a mark; ``n_chars``, if there is one, follows.

    No document goes; null and empty texts stay as they are; repeated rows change alike; very long
    texts are searched whole; an empty table stays empty; columns of any name pass through.
    """
    clean = secrets.redact(docs, secrets.train_on(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*[f"`{c}`" for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences.

    A null or empty text is the end mark alone; repeated rows each have their pieces; only texts of
    more than a sequence are cut; no documents give no pieces. Only ``doc_id`` and ``text`` are read.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: The n-gram model, the trained field and the packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

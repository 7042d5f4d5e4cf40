"""Upserts, exclusions and purges over the indices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.ids import is_set
from shelfmark.functions.session import shared_dir

from .inventory import REMOVALS


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace those of their key; all others stay."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def apply_exclusions(sources: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Add ``knowledge_status`` to sources (file_id, bundle_id, change_type, bundle_change_type).

    The first that applies: the file's explicit status, EXCLUDED if the file was removed, the
    same two for its bundle, else ACTIVE. An explicit ACTIVE thus outweighs a removal.
    """
    told = exclusions.select("file_id", "status").dropDuplicates(["file_id"])
    rows = sources.join(told.withColumnRenamed("status", "__own"), "file_id", "left")
    rows = rows.join(told.select(F.col("file_id").alias("bundle_id"), F.col("status").alias("__bundle")), "bundle_id", "left")
    status = F.coalesce(
        "__own", F.when(F.col("change_type").isin(*REMOVALS), "EXCLUDED"), "__bundle", F.when(F.col("bundle_change_type").isin(*REMOVALS), "EXCLUDED"), F.lit("ACTIVE")
    )
    return rows.withColumn("knowledge_status", status).select(*sources.columns, "knowledge_status")


def purged_files(sources: DataFrame, exclusions: DataFrame, cascade_bundles: bool = True) -> DataFrame:
    """(file_id) of purged files and, unless told otherwise, of the members of purged bundles."""
    direct = exclusions.where("status = 'PURGED'").select("file_id").distinct()
    if not cascade_bundles:
        return direct
    members = sources.join(direct.withColumnRenamed("file_id", "bundle_id"), "bundle_id", "left_semi").select("file_id")
    return direct.unionByName(members).distinct()


def purge(indices: dict[str, DataFrame], exclusions: DataFrame, cascade_bundles: bool = True) -> dict[str, DataFrame]:
    """The four indices without purged files' rows.

    Sources and records go by file; an entity or relation goes when it had sources and all of
    them are purged. The test explodes the source lists, so that no list of purged sources has
    to fit anywhere. Entities and relations are stored first, as they are read twice.
    """
    shared_dir(exclusions.sparkSession)
    files = purged_files(indices["sources"], exclusions, cascade_bundles)
    gone = indices["sources"].join(files, "file_id", "left_semi").select("source_id").distinct()
    out = {k: indices[k].join(files, "file_id", "left_anti") for k in ("sources", "records")}
    for name, key in (("entities", "entity_id"), ("relations", "relation_id")):
        held = indices[name].checkpoint()
        per = held.select(key, F.explode("source_ids").alias("source_id")).join(gone.withColumn("__gone", F.lit(True)), "source_id", "left")
        dead = per.groupBy(key).agg(F.count(F.when(F.col("__gone").isNull(), 1)).alias("alive")).where("alive = 0").select(key)
        out[name] = held.join(dead, key, "left_anti")
    return out


def stale_partitions(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys that were published and no longer exist."""
    return old.select(key).distinct().join(new.select(key), key, "left_anti")


def active_only(sources: DataFrame) -> DataFrame:
    return sources.where((F.col("knowledge_status") == "ACTIVE") & is_set("source_id"))

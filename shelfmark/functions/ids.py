"""Deterministic keys: a prefix and 20 hex digits of the SHA-256 of sorted JSON.

Python writes control characters above U+000F with lower-case hex digits in JSON escapes and
Spark with upper-case ones, so ids of names that hold such characters differ from those of
other writers; all other ids agree.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def text(col: Column | str) -> Column:
    """A string in which null is empty, as all keys and flags take it."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def is_set(col: Column | str) -> Column:
    return text(col) != ""


def first_set(*cols: Column | str) -> Column:
    """The first value that is neither null nor empty; empty if there is none."""
    return F.coalesce(*[F.nullif(text(c), F.lit("")) for c in cols], F.lit(""))


def stable_hash(**fields: Column) -> Column:
    """SHA-256 of the JSON object of ``fields``, keys sorted, no spaces."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), 256)


def _key(prefix: str, **fields: Column) -> Column:
    return F.concat(F.lit(prefix + "::"), F.substring(stable_hash(**fields), 1, 20))


def source_id(project_id: Column, source_key: Column) -> Column:
    return _key("src", project_id=project_id, source_key=source_key)


def record_id(source: Column, record_type: Column, external_id: Column, start: Column, title: Column) -> Column:
    return _key("rec", source_id=source, record_type=record_type, external_id=external_id, event_time_start=start, title=title)


def entity_id(entity_type: Column, name: Column) -> Column:
    return _key("ent", entity_type=entity_type, canonical_name=F.lower(name))


def relation_id(subject: Column, predicate: Column, obj: Column, evidence: Column) -> Column:
    return _key("rel", subject=subject, predicate=predicate, object=obj, evidence=F.sort_array(evidence))


def member_file_id(parent_id: Column, parent_sha: Column, path: Column) -> Column:
    """Identity of an archive's member: its parent's and a hash of the parent's content and the clean path."""
    return F.concat(parent_id, F.lit("_"), F.sha2(F.concat(first_set(parent_sha, parent_id), path), 256))


def flat_hash(fields: Column) -> Column:
    """SHA-256 of the ``k=v`` pairs of a string map, joined by bars in key order; a null value is empty."""
    pairs = F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.sha2(F.array_join(pairs, "|"), 256)


@F.arrow_udf(StringType())
def canonical_hash(raw: pa.Array) -> pa.Array:
    """SHA-256 of nested JSON with sorted keys and no spaces; text that is no JSON, and null, count as an empty object.

    One text is taken apart at a time, and only its hash goes back.
    """

    def one(value: str) -> str:
        try:
            parsed = json.loads(value)
        except (ValueError, RecursionError):
            parsed = {}
        return hashlib.sha256(json.dumps(parsed, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode(errors="surrogatepass")).hexdigest()

    empty = one("{}")
    if raw.null_count == len(raw):
        return pa.repeat(pa.scalar(empty, pa.string()), len(raw))
    return pa.array((one(x.as_py()) if x.is_valid else empty for x in raw), pa.string())


def content_hash(raw: Column) -> Column:
    """Hash of free JSON content that does not depend on key order."""
    return canonical_hash(raw)
